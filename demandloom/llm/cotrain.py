"""A quality classifier from two views that teach each other.

One view sees the words of a text, the other what is known about the page: source, language, length and
layout. Both are fitted on labelled documents; then, in every round, each scores all unlabelled documents
and marks those it is sure about, and the features of all marked and labelled documents are counted by
class for the other view: they set the weights its next fit starts from. Scores of both views are calibrated on
labelled documents kept aside, combined, and used to score all documents.

A document is good if its quality label is 1 and its toxic label is not. Only the labelled documents used
for fitting are bounded (``LABELLED``); marking and scoring read every whole text.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from ._tables import READ_ROWS, give_back, map_rows

# The labelled documents used for fitting.
LABELLED = 12_000
ROUNDS = 3
# How sure a view must be to mark a document, and the score from which documents are kept.
SURE, KEEP = 0.98, 0.5
# Features of marked documents that a view takes up in a round, at most: those with the most evidence.
MOST_FEATURES = 200_000
# Ids of repeated rows that are sent to every task; more of them are joined by a shuffle of the features.
SENT_IDS = 1_000_000
# Words take part if their share in good and bad documents differs by this much (a likelihood ratio;
# 15 happens by chance to about one word in 10,000); what is known of a page always does.
TEXT_EVIDENCE, PAGE_EVIDENCE = 15.0, 0.0
# Features of the sample that are added up together.
FIT_PART = 1 << 20
# A word of fewer documents can't be evidence.
LEAST_DOCUMENTS = 3
# Among marked documents a word has to be so many times as frequent in bad ones: there are so many of them
# that smallest differences would be evidence.
MARKED_TIMES = 3
# Documents whose features are added up together.
PART_ROWS = 512
# Features of marked documents that a task holds before it counts them.
COUNT_PART = 1 << 20
# Starts of words that are features besides the words, in characters.
STARTS = (4, 5)
TOKENS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")


def text_tokens(text: str) -> set[str]:
    """The distinct lower-cased words, numbers and runs of marks of a text, and how words start."""
    words = set(TOKENS.findall(text.lower()))
    return words | {f"{w[:n]}~" for n in STARTS for w in words if len(w) > n}


def _word(token: str) -> int:
    """A word or trait as a signed 32-bit checksum.

    With ``n`` features that have a weight, another one meets one of them by chance ``n`` times in 2^32.
    """
    return zlib.crc32(token.encode()) - (1 << 31)


def page_tokens(text: str, source: str | None, lang: str | None) -> list[str]:
    """What is known about a page without reading its words, in steps."""
    size = len(text)
    words = text.split()
    count = max(1, len(words))
    lines = text.count("\n") + 1
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letters = int(((codes | 32) - 97 < 26).sum() + (codes >= 192).sum())
    lower = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    upper = int((codes != lower).sum()) if len(codes) == len(lower) else 0
    marks = sum(text.count(c) for c in "#*$%&|<>!?")
    spaced = text.count(" ") + lines

    def step(name: str, value: float, per: float) -> str:
        return f"{name}{min(40, int(value * per))}"

    return [
        f"source={source}", f"lang={lang}", step("size", math.log2(size + 1), 2),
        step("lines", math.log2(lines), 2), step("line", math.log2(size / lines + 1), 2),
        step("letters", letters / max(1, size), 20), step("upper", upper / max(1, size), 40),
        step("marks", marks / count, 20), step("word", size / count, 2),
        step("distinct", len(set(words)) / count, 20), step("spaced", spaced / max(1, size), 40),
        step("marked", math.log2(marks + 1), 2)]


@dataclass
class View:
    """Weights of one view's features, and the line that turns its sums into calibrated log odds."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    # Weights of features that only marked documents have, by checksum.
    others: dict[int, float] = field(default_factory=dict)

    def named(self, names: np.ndarray) -> dict[int, float]:
        """All weights by checksum; ``names`` are those of ``weights``."""
        used = np.flatnonzero(self.weights)
        return self.others | dict(zip(names[used].tolist(), self.weights[used].tolist(), strict=True))

    def odds(self, sums):
        return self.slope * (sums + self.bias) + self.offset


@dataclass
class Model:
    """Both views. A document is bad if its words or its page are, so the more doubtful view decides."""

    text: View
    page: View
    slope: float = 1.0
    offset: float = 0.0
    words: dict[int, float] = field(default_factory=dict)
    traits: dict[int, float] = field(default_factory=dict)

    def odds(self, text_sums, page_sums):
        doubtful = np.minimum(self.text.odds(text_sums), self.page.odds(page_sums))
        return self.slope * doubtful + self.offset


class Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list, size: int):
        self.lengths = np.array([len(r) for r in rows], int)
        self.columns = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.empty(0, np.int32)
        self.owner = np.repeat(np.arange(len(rows), dtype=np.int32), self.lengths)
        self.size = size

    def only(self, used: np.ndarray) -> Rows:
        """The same rows without the other features."""
        kept = Rows([], self.size)
        here = used[self.columns]
        kept.lengths, kept.columns, kept.owner = self.lengths, self.columns[here], self.owner[here]
        return kept

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return _added(self.owner, self.columns, weights, len(self.lengths))

    def spread(self, values: np.ndarray) -> np.ndarray:
        return _added(self.columns, self.owner, values, self.size)


def _added(to: np.ndarray, at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """``values[at]`` added up by ``to``, in parts that keep copies small."""
    out = np.zeros(size)
    for start in range(0, len(to), FIT_PART):
        part = slice(start, start + FIT_PART)
        out += np.bincount(to[part], values[at[part]], minlength=size)
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _evidence(in_good: np.ndarray, in_bad: np.ndarray, good: float, bad: float) -> np.ndarray:
    """Likelihood ratio of each feature: is its share of bad documents that of all documents?"""
    both = np.maximum(in_good + in_bad, 1e-9)
    share = bad / (good + bad)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(in_bad > 0, in_bad * np.log(in_bad / (both * share)), 0)
                     + np.where(in_good > 0, in_good * np.log(in_good / (both * (1 - share))), 0))
    return ratio


def fit_view(rows: list, good: np.ndarray, size: int, least: float, start: np.ndarray | None = None,
             steps: int = 150, decay: float = 0.02) -> View:
    """Logistic regression on the features with enough evidence, both classes weighing the same.

    Where evidence is asked for, it has to be evidence of bad documents: long texts collect many words
    that are a little more frequent in good ones, and these would outvote a few bad words. Weights begin
    at ``start`` and are drawn to it; features with one there always take part.
    """
    data, good = Rows(rows, size), good.astype(float)
    in_good, in_bad = data.spread(good), data.spread(1 - good)
    used = (in_good + in_bad > 0) & (_evidence(in_good, in_bad, good.sum(), (1 - good).sum()) >= least)
    if least:
        used &= (in_bad * good.sum() > in_good * (1 - good).sum()) & (in_good + in_bad >= LEAST_DOCUMENTS)
    if start is not None:
        used |= start != 0
    data = data.only(used)
    places = np.flatnonzero(used)
    data.columns, data.size = (np.cumsum(used, dtype=np.int32) - 1)[data.columns], len(places)
    first = np.zeros(len(places)) if start is None else start[places]
    weights, bias = first, 0.0
    balance = np.where(good > 0, 0.5 / max(1, good.sum()), 0.5 / max(1, (1 - good).sum()))
    mean, square = np.zeros(len(places) + 1), np.zeros(len(places) + 1)
    for step in range(1, steps + 1):
        miss = (_sigmoid(data.sums(weights) + bias) - good) * balance
        slope = np.append(data.spread(miss) + decay / len(rows) * (weights - first), miss.sum())
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        move = 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    whole = np.zeros(size)
    whole[places] = weights
    return View(whole, float(bias))


def _line(z: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make sums ``z`` log odds: Newton steps, halved until they help.

    Targets are drawn in a little from 0 and 1, so sums that separate all examples stay finite. Sums that tell
    nothing, being all the same, give the odds of the classes.
    """
    if len(z) and z.min() == z.max():
        return 0.0, math.log((good.sum() + 1) / ((~good).sum() + 1))
    if not len(z) or good.min() == good.max():
        return 1.0, 0.0
    middle, width = z.mean(), z.std() + 1e-9
    x = np.stack([(z - middle) / width, np.ones_like(z)], 1)
    wanted = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))

    def loss(line):
        odds = x @ line
        return (np.logaddexp(0, odds) - wanted * odds).sum() + 1e-3 * (line ** 2).sum()

    line = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ line)
        slope = x.T @ (p - wanted) + 2e-3 * line
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 2e-3 * np.eye(2), slope)
        step = 1.0
        while step > 1e-4 and loss(line - step * move) > loss(line):
            step /= 2
        line = line - step * move
    if line[0] <= 0:
        return 1.0, 0.0
    return float(line[0] / width), float(line[1] - line[0] * middle / width)


def calibrate(view: View, rows: list, good: np.ndarray) -> View:
    sums = Rows(rows, len(view.weights)).sums(view.weights) + view.bias
    return View(view.weights, view.bias, *_line(sums, good))


def _marked_weights(in_good: np.ndarray, in_bad: np.ndarray, good: float, bad: float, sure: float):
    """Log ratio of a feature's shares in documents marked good and bad, of which some are marked wrongly."""
    a, b = (in_good + 0.5) / (good + 1), (in_bad + 0.5) / (bad + 1)
    return np.log((sure * a + (1 - sure) * b) / (sure * b + (1 - sure) * a))


def _limit(sure: float) -> float:
    return math.log(sure / (1 - sure))


def _marks_of_rows(kept: list[tuple], pool: list[tuple], sizes: tuple[int, int], views: list[View],
                   sure: float) -> list[tuple]:
    """The weights both views start from after the other one has marked the rows of ``pool``."""
    data = [Rows([r[v] for r in kept + pool], sizes[v]) for v in (0, 1)]
    labels, starts = np.array([e[2] for e in kept], bool), []
    odds = [view.odds(d.sums(view.weights))[len(kept):] for view, d in zip(views, data, strict=True)]
    for v, least in enumerate((TEXT_EVIDENCE, PAGE_EVIDENCE)):
        sides = [np.append(given, found).astype(float) for given, found in (
            (labels, odds[1 - v] >= _limit(sure)), (~labels, odds[1 - v] <= -_limit(sure)))]
        in_good, in_bad = (data[v].spread(side) for side in sides)
        good, bad = (float(side.sum()) for side in sides)
        here = in_good + in_bad > 0
        if least:
            here &= ((in_good + in_bad >= LEAST_DOCUMENTS) & (in_bad * good >= MARKED_TIMES * in_good * bad)
                     & (_evidence(in_good, in_bad, good, bad) >= least))
        start = np.zeros(sizes[v])
        start[here] = _marked_weights(in_good, in_bad, good, bad, sure)[here]
        starts.append((start, {}))
    return starts


def co_train(examples: list[tuple], pool: list[tuple] | Callable, sizes: tuple[int, int], rounds: int = ROUNDS,
             sure: float = SURE) -> Model | None:
    """Fit on ``(text features, page features, good)`` and a pool of ``(text features, page features)``.

    Features are numbers below ``sizes``. The pool may also be a function that takes both views and how
    sure they must be, lets them mark its documents, and returns for each view the weights to start from
    and those of features beyond ``sizes``. Every fourth example is kept aside for calibration. Nothing is
    fitted unless there are good and bad examples.
    """
    aside = [e for i, e in enumerate(examples) if i % 4 == 3]
    kept = [e for i, e in enumerate(examples) if i % 4 != 3]
    labels = np.array([e[2] for e in kept], bool)
    if not len(labels) or labels.min() == labels.max():
        return None
    test = np.array([e[2] for e in aside], bool)
    least, views, starts = (TEXT_EVIDENCE, PAGE_EVIDENCE), [None, None], [(None, {}), (None, {})]
    for turn in range(rounds + 1):
        for v, (start, others) in enumerate(starts):
            views[v] = calibrate(fit_view([e[v] for e in kept], labels, sizes[v], least[v], start),
                                 [e[v] for e in aside], test)
            views[v].others = others
        if turn < rounds:
            # What one view is sure about teaches the other.
            starts = pool(views, sure) if callable(pool) else _marks_of_rows(
                kept, pool, sizes, views, sure)
    model = Model(*views)
    sums = [Rows([e[v] for e in aside], sizes[v]).sums(views[v].weights) for v in (0, 1)]
    model.slope, model.offset = _line(model.odds(*sums), test)
    return model


def features_of(documents: DataFrame) -> DataFrame:
    """``doc_id, words, page, row``: the features of every row, and a hash of it; written once."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for text, source, lang, *rest in rows:
            text = text or ""
            words = np.unique(np.array([*map(_word, text_tokens(text))], np.int32))
            page = np.unique(np.array([*map(_word, page_tokens(text, source, lang))], np.int32))
            yield words, page, *rest
        give_back()

    kind = documents.schema["doc_id"].dataType.simpleString()
    row = ("text", "source", "lang")
    made = map_rows(documents.select(*row, "doc_id", F.xxhash64(*row).alias("row")), work,
                    f"words array<int>, page array<int>, doc_id {kind}, row long")
    return stage(made, "features")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time: sums take several times the room of the features themselves."""
    for batch in batches:
        for start in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(start, PART_ROWS)


def _parts(column) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and how many each row has."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0]:offsets[-1]], np.diff(offsets)


def _word_sums(values: np.ndarray, lengths: np.ndarray, known: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights of each row's words added up; ``known`` words are sorted."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    if not len(known):
        return np.zeros(len(lengths))
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    here = known[at] == values
    return np.bincount(owner[here], weights[at[here]], minlength=len(lengths))


def _marked_counts(pool: DataFrame, views: list[View], names: tuple[np.ndarray, np.ndarray], sure: float) -> DataFrame:
    """``view, feature, good, bad``: how many marked documents of each class have a feature of a view.

    All documents of the pool without a label are scored by both views, and the marks of one count for
    the other; labelled ones count as such. Views 2 and 3 hold the numbers of all these documents.
    """
    found = [view.named(n) for view, n in zip(views, names, strict=True)]
    known = [np.array(sorted(f), np.int32) for f in found]
    weights = [np.array([f[w] for w in k.tolist()], float) for f, k in zip(found, known, strict=True)]
    limit = _limit(sure)
    lines = [(v.slope, v.bias, v.offset) for v in views]
    out = pa.schema([("view", pa.int32()), ("feature", pa.int32()), ("good", pa.int64()), ("bad", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, totals = [[[], []], [[], []]], np.zeros((2, 2), np.int64)

        def made(view: int, side: int, features: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            nothing = np.zeros(len(counts), np.int64)
            sides = (counts, nothing) if side == 0 else (nothing, counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(counts), view, np.int32)), pa.array(features.astype(np.int32)),
                 *map(pa.array, sides)], schema=out)

        def counted() -> Iterator[pa.RecordBatch]:
            for v in (0, 1):
                for side in (0, 1):
                    parts, held[v][side] = held[v][side], []
                    if parts:
                        yield made(v, side, *np.unique(np.concatenate(parts), return_counts=True))

        size = 0
        for batch in _slices(batches):
            columns = [_parts(batch.column(name)) for name in ("words", "page")]
            sums = [_word_sums(*columns[v], known[v], weights[v]) for v in (0, 1)]
            odds = [slope * (s + bias) + offset for s, (slope, bias, offset) in zip(sums, lines, strict=True)]
            given = batch.column("good").fill_null(False).to_numpy(zero_copy_only=False)
            labelled = batch.column("good").is_valid().to_numpy(zero_copy_only=False)
            for v, (values, lengths) in enumerate(columns):
                for side, marked in enumerate((np.where(labelled, given, odds[1 - v] >= limit),
                                               np.where(labelled, ~given, odds[1 - v] <= -limit))):
                    totals[v, side] += marked.sum()
                    held[v][side].append(values[np.repeat(marked, lengths)])
                    size += len(held[v][side][-1])
            if size >= COUNT_PART:
                yield from counted()
                size = 0
        yield from counted()
        for v in (0, 1):
            for side in (0, 1):
                yield made(v + 2, side, np.zeros(1), totals[v, side:side + 1])
        give_back()

    return (pool.select("words", "page", "good").mapInArrow(run, "view int, feature int, good long, bad long")
            .groupBy("view", "feature").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))


def _marks_of_table(pool: DataFrame, names: tuple[np.ndarray, np.ndarray], views: list[View],
                    sure: float) -> list[tuple]:
    """The same as ``_marks_of_rows`` for staged features; only features that tell reach the driver.

    Their number is bounded by ``MOST_FEATURES``; what the page view knows from the sample always counts.
    """
    counts = stage(_marked_counts(pool, views, names, sure), "marks")
    totals = {r["view"] - 2: (float(r["good"]), float(r["bad"])) for r in counts.filter("view >= 2").collect()}
    starts = []
    for v, least in enumerate((TEXT_EVIDENCE, PAGE_EVIDENCE)):
        good, bad = totals[v]
        start = np.zeros(len(names[v]))
        both, share = F.col("good") + F.col("bad"), bad / (good + bad)

        def part(count: str, of: float, both: Column = both) -> Column:
            return F.when(F.col(count) > 0, F.col(count) * F.log(F.col(count) / (both * of))).otherwise(0.0)

        evidence = 2 * (part("bad", share) + part("good", 1 - share))
        mine = counts.filter(F.col("view") == v).withColumn("evidence", evidence)
        telling = ((both >= LEAST_DOCUMENTS) & (F.col("evidence") >= least)
                   & (F.col("bad") * good >= MARKED_TIMES * F.col("good") * bad)) if least else F.lit(True)
        told = mine.filter(telling).orderBy(F.col("evidence").desc(), "feature").limit(MOST_FEATURES)
        if not least:  # every trait of the sample takes part: one row each
            sample = counts.sparkSession.createDataFrame(pa.table({"feature": names[v]}))
            told = told.unionByName(mine.join(F.broadcast(sample), "feature").select(mine.columns)).distinct()
        found = told.select("feature", "good", "bad").toArrow()
        features = found["feature"].to_numpy()
        weights = _marked_weights(found["good"].to_numpy(), found["bad"].to_numpy(), good, bad, sure)
        at = np.searchsorted(names[v], features)
        here = np.isin(features, names[v])
        start[at[here]] = weights[here]
        starts.append((start, dict(zip(features[~here].tolist(), weights[~here].tolist(), strict=True))))
    return starts


def _one_of_each(features: DataFrame) -> DataFrame:
    """Of the rows with one id that with the smallest hash; only rows of repeated ids are moved."""
    rows = features.filter("doc_id is not null")
    repeated = stage(rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "repeated")
    count = repeated.count()
    if not count:
        return rows
    ids = F.broadcast(repeated) if count <= SENT_IDS else repeated
    one = rows.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct("words", "page", "row"), "row").alias("one")).select("doc_id", "one.*")
    return rows.join(ids, "doc_id", "left_anti").unionByName(one)


def fit(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model | None:
    """Fit on documents of ``doc_id, text, source, lang`` and labels of ``doc_id, quality, toxic``."""
    return fit_features(features_of(documents), labels, labelled, rounds)


def fit_features(features: DataFrame, labels: DataFrame, labelled: int = LABELLED,
                 rounds: int = ROUNDS) -> Model | None:
    """Fit on the features of documents and labels of ``doc_id, quality, toxic``.

    The labelled documents used are those with the smallest hashes of ids among the present ones, so they
    don't depend on partitions; all others are marked in every round, whether they have a label or not. A
    document with several labels is good only if all say so; labels without a quality are left out. Of rows
    with one id, the one with the smallest hash is taken, however many there are; rows without an id are
    left out. Features are read where they lie; only ids and rows of repeated ids are shuffled.
    """
    spark = features.sparkSession
    judged = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min((F.col("quality") > 0) & (F.coalesce("toxic", F.lit(0)) < 1)).alias("good"))
    one = _one_of_each(features)
    order = F.xxhash64("doc_id")
    # The sample's size is bounded by the parameter.
    chosen = stage(judged.join(one.select("doc_id"), "doc_id").withColumn("place", order)
                   .orderBy("place", "doc_id").limit(labelled), "chosen")
    found = one.join(F.broadcast(chosen), "doc_id").toArrow().combine_chunks()
    if not found.num_rows:
        return None
    names, rows = [], []
    for name in ("words", "page"):
        values, lengths = _parts(found[name].chunk(0))
        names.append(np.unique(values))
        rows.append(_split(np.concatenate(
            [np.searchsorted(names[-1], values[i:i + FIT_PART]).astype(np.int32)
             for i in range(0, max(1, len(values)), FIT_PART)]), lengths))
    good = found["good"].to_pylist()
    in_order = np.lexsort((found["doc_id"].to_numpy(), found["place"].to_numpy())).tolist()
    # Every fourth one is kept aside by ``co_train``; the others count with their labels, all else is marked.
    aside, kept = ([p for i, p in enumerate(in_order) if (i % 4 == 3) == side] for side in (True, False))
    sides = [F.broadcast(spark.createDataFrame(found.select(["doc_id", "good"]).take(p))) if p
             else None for p in (aside, kept)]
    pool = one.join(sides[0], "doc_id", "left_anti") if sides[0] is not None else one
    pool = pool.join(sides[1], "doc_id", "left")
    model = co_train([(rows[0][i], rows[1][i], good[i]) for i in in_order],
                     lambda views, sure: _marks_of_table(pool, tuple(names), views, sure),
                     (len(names[0]), len(names[1])), rounds)
    if model is not None:  # tasks look features up by name
        model.words, model.traits = model.text.named(names[0]), model.page.named(names[1])
        model.text, model.page = (replace(v, weights=np.empty(0), others={}) for v in (model.text, model.page))
    return model


def _split(values: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum(lengths)
    return [values[b - n:b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


def _scorer(model: Model):
    names = ("text_score", "page_score", "score")

    def score(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        def weight(word: int) -> float:
            return model.words.get(word, 0.0)

        def sums(text: str | None, source: str | None, lang: str | None) -> tuple[float, float]:
            page = set(map(_word, page_tokens(text or "", source, lang)))
            words = map(_word, text_tokens(text or ""))
            return (math.fsum(map(weight, set(words))),
                    math.fsum(model.traits.get(t, 0.0) for t in page))

        for columns in batches:
            found = np.zeros((len(columns[0]), 2))
            # A few rows at a time: texts take more room in Python than in the batch.
            for start in range(0, len(found), READ_ROWS):
                part = zip(*(c.slice(start, READ_ROWS).to_pylist() for c in columns), strict=True)
                for i, row in enumerate(part, start):
                    found[i] = sums(*row)
            words, page = found.T
            made = (model.text.odds(words), model.page.odds(page), model.odds(words, page))
            yield pa.StructArray.from_arrays([pa.array(_sigmoid(odds)) for odds in made], names=names)
            give_back()

    return F.arrow_udf(score, ", ".join(f"{name} double" for name in names))


def scores(model: Model | None, text: Column, source: Column, lang: Column) -> Column:
    """A struct of ``text_score, page_score, score`` for every row: how likely the document is good.

    Null texts are empty; a null source or language is a value of its own. Without a model all three are
    null. Equal rows get equal scores.
    """
    if model is None:
        nothing = F.lit(None).cast("double")
        return F.struct(*[nothing.alias(c) for c in ("text_score", "page_score", "score")])
    return _scorer(model)(text, source, lang)


def score_features(model: Model | None, features: DataFrame) -> DataFrame:
    """``doc_id, text_score, page_score, score`` of every row of ``features_of``, without reading texts again."""
    names = ("text_score", "page_score", "score")
    if model is None:
        return features.select("doc_id", *[F.lit(None).cast("double").alias(n) for n in names])
    tables = [_sorted_weights(w) for w in (model.words, model.traits)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            words, page = (_word_sums(*_parts(batch.column(n)), *t)
                           for n, t in zip(("words", "page"), tables, strict=True))
            odds = (model.text.odds(words), model.page.odds(page), model.odds(words, page))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(_sigmoid(o)) for o in odds]], names=["doc_id", *names])

    kind = features.schema["doc_id"].dataType.simpleString()
    return features.select("doc_id", "words", "page").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names))


def _sorted_weights(weights: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    known = np.array(sorted(weights), np.int32)
    return known, np.array([weights[w] for w in known.tolist()], float)


def kept(score: Column, keep: float = KEEP) -> Column:
    """Documents without a score are kept."""
    return F.coalesce(score >= keep, F.lit(True))


def keep_good(documents: DataFrame, model: Model | None, keep: float = KEEP) -> DataFrame:
    """The documents whose score is high enough, with their own columns."""
    scored = documents.select(F.struct("*").alias("_doc"), scores(
        model, F.col("text"), F.col("source"), F.col("lang")).alias("_scores"))
    return scored.filter(kept(F.col("_scores.score"), keep)).select("_doc.*")
