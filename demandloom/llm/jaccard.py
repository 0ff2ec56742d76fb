"""Near duplicates by a blocked sparse matrix product of documents and word shingles.

The incidence matrix has a row per class of documents with equal shingle sets and a column per shingle.
Its product with its own transpose holds the overlap of any two classes; with their sizes that gives
their Jaccard similarity. Columns are dealt into blocks by Spark's shuffle, every block multiplies its
own columns, and partial overlaps are added up per pair.

Bounds that follow from the sizes keep the product sparse. Sizes ``n`` and ``m`` ask for an overlap of at
least ``k = similar (n + m) / (100 + similar)``. In one order of all columns, frequent ones last, a pair
with that overlap shares at least ``s`` of the first ``n - k + s`` and ``m - k + s`` columns of its rows;
only those leading columns are multiplied, and pairs whose counts there stay below ``s`` are discarded.
The overlap of what remains is counted over all shingles.

Big groups of near copies would still make all their pairs. Components make most of them needless: in a
first product every column only meets its most central row, and pairs that are connected afterwards are
left out of the second, full product. No pair that could add a connection is left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from ._tables import give_back, map_rows
from .components import components

SHINGLE_WORDS = 5
# Similarity in percent from which two documents are linked.
SIMILAR = 80
# Leading columns that a pair has to share, at least.
SHARED = 4
# Frequent columns that every task is told, so it can put them last. More of them cost nothing but
# memory, fewer only make the product larger: any order of the columns gives the same links.
# The column that holds a hash of the text beside the columns of documents.
ROW = "_near_row"
FREQUENT_COLUMNS = 1 << 17
# Shingles that one task counts together.
COUNT_BATCH = 1 << 20
# Bits of the filter that spares most texts from being cut again; a full one spares none.
FILTER_BITS = 24
# Bytes of a text that are hashed together.
PART_BYTES = 1 << 20
SPACE = re.compile(rb"[ \t-\r]")
BASE, MULTIPLY, SPREAD = 0x9E3779B97F4A7C15, np.uint64(0xD1342543DE82EF95), np.uint64(0xD6E8FEB86659FD93)
BACK = pow(BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * SPREAD
    return h ^ (h >> np.uint64(29))


def _letter_codes() -> np.ndarray:
    """A 64-bit number per byte, the same for A-Z and a-z."""
    codes = _mix(_mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLY))
    codes[65:91] = codes[97:123]
    return codes


_CODES = _letter_codes()
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse; two tables per worker, as long as the longest part."""
    if len(_powers[0]) < size:
        for i, base in enumerate((BASE, BACK)):
            powers = np.full(max(size, 1 << 16), base, np.uint64)
            powers[0] = 1
            _powers[i] = np.multiply.accumulate(powers)
    return _powers


def _hash_part(part: bytes) -> np.ndarray:
    """Hashes of the words of some bytes: polynomials of their letters, from sums over all bytes."""
    letters = np.frombuffer(part, np.uint8)
    inside = np.zeros(len(letters) + 2, bool)
    inside[1:-1] = ~_IS_SPACE[letters]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    powers, back = _powers_up_to(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_CODES[letters] * powers[:len(letters)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order; long texts are cut at white space."""
    parts, at = [], 0
    while at < len(text):
        end = len(text)
        if end - at > PART_BYTES:
            gap = SPACE.search(text, at + PART_BYTES)
            end = gap.end() if gap else end
        parts.append(_hash_part(text[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingles(text: bytes | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words of a whole text.

    A-Z are lower-cased, words end at ASCII white space. Fewer words than ``size`` make one shingle, no
    words none. Two of ``n`` different shingles share a hash with a probability of about ``n**2 / 2**65``.
    """
    h = word_hashes(text or b"")
    if not len(h):
        return h
    size = min(size, len(h))
    runs = len(h) - size + 1
    rolled = _mix(h[:runs] + np.uint64(size))
    for k in range(1, size):
        rolled = _mix(rolled * MULTIPLY + h[k:runs + k])
    return np.unique(rolled)


def needed_overlap(size: int, similar: int = SIMILAR) -> int:
    """The least overlap with any class that is similar to one of ``size`` shingles."""
    return -(-similar * size // 100)


def _columns(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _repeated(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that stand in the arrays more than once, ascending, and how often; ``held`` is emptied."""
    together = np.concatenate(held)
    held.clear()
    together.sort()
    again = together[1:][together[1:] == together[:-1]]
    del together
    column, n = np.unique(again, return_counts=True)
    return column, n + 1


def _frequent_columns(texts: DataFrame, bits: int, size: int) -> DataFrame:
    """Columns that occur in several rows of one batch of a task, with how often that was."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        def count(held):
            if held:
                for c, k in zip(*_repeated(held), strict=True):
                    yield int(c), int(k)

        held, seen, total = [], set(), 0
        for (text,) in rows:
            hashes = shingles(text, size)
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            if digest in seen:
                continue
            seen.add(digest)
            held.append(_columns(hashes, bits))
            total += len(hashes)
            if total >= COUNT_BATCH:
                yield from count(held)
                held, seen, total = [], set(), 0
        yield from count(held)
        give_back()

    counts = stage(map_rows(texts, work, "col long, n long").groupBy("col").agg(F.sum("n").alias("n")),
                   "column-counts")
    # The most frequent ones by steps of the count, so nothing is sorted in one task.
    step = F.floor(8 * F.log2("n"))
    least, room = None, FREQUENT_COLUMNS
    for at, columns in sorted(counts.groupBy(step).count().collect(), reverse=True):
        room -= columns
        if room < 0:
            break
        least = at
    return counts.filter(step >= least if least is not None else F.lit(False))


def _incidence(documents: DataFrame, frequent, bits: int, similar: int, size: int) -> DataFrame:
    """Per row its set's node and size, how off-centre it is, and its leading columns in order.

    ``lost`` counts leading shingles whose column stands in the list already.
    """
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        often, counts = frequent.value
        for name, row, text in rows:
            hashes = shingles(text, size)
            n = len(hashes)
            column = _columns(hashes, bits)
            weight = np.zeros(n, np.int64)
            if len(often):
                at = np.searchsorted(often, column).clip(max=len(often) - 1)
                weight = np.where(often[at] == column, counts[at], 0)
            lead = min(n, n - needed_overlap(n, similar) + SHARED)
            ordered = column[np.lexsort((column, weight))[:lead]]
            leading = ordered[np.append(True, ordered[1:] != ordered[:-1])] if n else ordered
            rare = int(1000 * np.count_nonzero(weight == 0) / n) if n else 0
            yield name, row, n, _node(hashes), rare, lead - len(leading), leading
        give_back()

    return map_rows(documents.select("doc_id", "row", "text"), work,
                    "doc_id long, row long, n int, node long, rare int, lost int, leading array<long>")


def _node(hashes: np.ndarray) -> int:
    """What names a set, whatever documents hold it: 64 bits of its digest.

    Among ``k`` different sets two share a name by chance with ``k * k`` in 2^65.
    """
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _filter_of(wanted: DataFrame) -> np.ndarray:
    """A bit per hash of a wanted document, built in Spark; its size does not depend on the data."""
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FILTER_BITS)
    words = (wanted.select(F.shiftright(h, 6).alias("word"), F.expr("1L").alias("one"), h.alias("h"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, cast(h & 63 as int))")).alias("bits")))
    out = np.zeros(1 << FILTER_BITS - 6, np.int64)
    found = words.toPandas()
    out[found["word"].to_numpy(int)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _whole_sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The sets of all wanted documents by node, and of a few others that the filter lets through."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(_filter_of(wanted))

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        wanted_bits = shared.value
        for h, text in rows:
            if h is not None and int(wanted_bits[h >> 6]) >> (h & 63) & 1:
                hashes = shingles(text, size)
                yield _node(hashes), hashes.astype(np.int64)
        give_back()

    hashed = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FILTER_BITS)
    named = documents.filter("doc_id is not null").select(hashed.alias("h"), "text")
    return stage(map_rows(named, work, "node long, hashes array<long>"), "shingle-sets")


def _asked(n: Column, m: Column, similar: int) -> Column:
    """The overlap that two sizes ask for."""
    return F.ceil(similar * (n + m) / F.lit(100 + similar))


def _shared(n: Column, m: Column, similar: int) -> Column:
    return F.least(F.lit(SHARED), _asked(n, m, similar))


def _may_meet(similar: int) -> Column:
    """Sizes are close, and the column leads both rows as seen from the other's size."""
    n, m = F.col("n_a"), F.col("n_b")
    spare = _shared(n, m, similar) - _asked(n, m, similar)
    return ((100 * F.least(n, m) >= similar * F.greatest(n, m))
            & (F.col("pos_a") < n + spare) & (F.col("pos_b") < m + spare))


def _counted(met: DataFrame, similar: int) -> DataFrame:
    """Partial overlaps added up per pair; pairs that share too few leading columns are discarded."""
    partial = met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(
        F.count("*").alias("o"), *[F.first(c).alias(c) for c in ("n_a", "n_b", "lost_a", "lost_b")])
    enough = F.col("o") + F.col("lost_a") + F.col("lost_b") >= _shared(F.col("n_a"), F.col("n_b"), similar)
    return partial.filter(enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _linked(pairs: DataFrame, documents: DataFrame, classes: DataFrame, similar: int, size: int) -> DataFrame:
    """Pairs ``a, b`` of nodes whose whole sets are similar enough; one document of each is cut again."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _whole_sets(documents, ends.join(classes, "node").select("doc_id").distinct(), size)

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("hashes").alias(f"set_{name}"))

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    met = met.select("a", "b", overlap.alias("o"), (F.size("set_a") + F.size("set_b")).alias("both"))
    return met.filter(100 * F.col("o") >= similar * (F.col("both") - F.col("o"))).select("a", "b").distinct()


def _sided(side: str, columns) -> list:
    return [F.col(c).alias(f"{c}_{side}") for c in columns]


def similar_documents(documents: DataFrame, key: str = "doc_id", text: str = "text",
                      similar: int = SIMILAR, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; links are similarities of ``similar`` percent.

    ``component_id`` is the smallest document reachable by links, the document itself included. Null or
    empty texts, and those without words, are linked with nothing. Repeated rows are linked like other
    copies; rows of one id with different texts each get the component of their own text. Rows without an
    id are linked with nothing and have no component. An empty table gives no rows; other columns are not
    read.
    """
    return _classified(documents, key, text, similar, size).select("doc_id", "n_shingles", "component_id")


def _row_hash(text: str):
    return F.xxhash64(F.col(text))


def _classified(documents: DataFrame, key: str, text: str, similar: int, size: int) -> DataFrame:
    """``doc_id, row, n_shingles, label, component_id`` of every row.

    Nodes of links are sets, not ids, so texts that share an id are not taken for one. ``row`` is a hash of
    the text and ``label`` names the component; rows that can't be linked have none.
    """
    texts = documents.select(F.col(key).cast("long").alias("doc_id"), _row_hash(text).alias("row"),
                             F.col(text).alias("text"))
    as_bytes = texts.withColumn("text", F.col("text").cast("binary"))
    characters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    # Columns are wide enough that different shingles rarely meet in one by chance.
    bits = min(63, max(32, math.ceil(math.log2(characters + 2)) + 6))
    spark = documents.sparkSession
    rows = _frequent_columns(as_bytes.select("text"), bits, size).toPandas().sort_values("col")
    frequent = spark.sparkContext.broadcast((rows["col"].to_numpy(), rows["n"].to_numpy()))

    incidence = stage(_incidence(as_bytes, frequent, bits, similar, size), "incidence")
    linkable = incidence.filter("n > 0 and doc_id is not null")
    classes = (linkable.groupBy("node")
               .agg(F.first("n").alias("n"), F.first("rare").alias("rare"),
                    F.first("lost").alias("lost"), F.first("leading").alias("leading")))
    first_ids = stage(linkable.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "first-ids")
    row = ("node", "n", "lost", "pos")
    column = W.partitionBy("col")
    # A column holds a class once, so it is never more than one row per class long.
    entries = classes.select("node", "n", "rare", "lost", F.posexplode("leading").alias("pos", "col"))
    entries = entries.withColumns({
        "rows": F.count("*").over(column),
        "centre": F.min(F.struct("rare", *row)).over(column)}).filter("rows > 1")
    entries = stage(entries.select("col", *row, "centre"), "shared-columns")

    stars = (entries.filter(F.col("node") != F.col("centre.node"))
             .select(*_sided("a", row), *[F.col(f"centre.{c}").alias(f"{c}_b") for c in row]))
    stars = stage(_counted(stars.filter(_may_meet(similar)), similar), "star-pairs")
    first = stage(_linked(stars, as_bytes, first_ids, similar, size), "star-links")
    labels = components(first)

    # Columns whose rows are not connected yet, and in them all pairs that are not.
    known = (entries.select("col", *row).join(labels, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    split = known.groupBy("col").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    known = stage(known.join(split.select("col"), "col", "left_semi"), "open-columns")
    row = (*row, "label")
    met = (known.select("col", *_sided("a", row)).join(known.select("col", *_sided("b", row)), "col")
           .filter("node_a < node_b and label_a <> label_b").filter(_may_meet(similar)))
    pairs = stage(_counted(met, similar), "pairs")
    found = components(first.unionByName(_linked(pairs, as_bytes, first_ids, similar, size)))

    # The smallest id of every component; a class without links is a component of its own.
    linked = found.join(first_ids, "node")
    named = linked.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    labelled = first_ids.join(linked.select("node", "label").join(named, "label"), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"),
        F.coalesce("component_id", "doc_id").alias("component_id"))
    can_link = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return (incidence.select("doc_id", "row", F.col("n").cast("long").alias("n_shingles"), "node")
            .join(labelled, "node", "left")
            .select("doc_id", "row", "n_shingles", F.when(can_link, F.col("label")).alias("label"),
                    F.when(can_link, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text",
                     similar: int = SIMILAR, size: int = SHINGLE_WORDS) -> DataFrame:
    """One document of every component, the one with the smallest id, with all its columns.

    Different texts of one id are documents of their own; of equal rows of one id and text one stays. Texts
    without words and rows without an id are linked with nothing and all stay. Rows are moved only to drop
    the ones that go, or where ids and texts repeat.
    """
    found = stage(_classified(documents, key, text, similar, size).filter("doc_id is not null"), "classified")
    one = F.struct("doc_id", "row")
    firsts = found.filter("label is not null").groupBy("label").agg(F.min(one).alias("first"))
    away = (found.join(firsts, "label").filter(one != F.col("first"))
            .select(F.col("doc_id").alias(key), F.col("row").alias(ROW)).distinct())
    repeated = stage(found.groupBy("doc_id", "row").agg(F.count("*").alias("rows")).filter("rows > 1")
                     .select(F.col("doc_id").alias(key), F.col("row").alias(ROW)), "repeated-rows")
    named = documents.filter(F.col(key).isNotNull()).withColumn(ROW, _row_hash(text))
    stay = named.join(away, [key, ROW], "left_anti")
    if not repeated.isEmpty():
        stay = (stay.join(repeated, [key, ROW], "left_anti").unionByName(
            stay.join(repeated, [key, ROW], "left_semi").dropDuplicates([key, ROW])))
    return stay.select(*documents.columns).unionByName(documents.filter(F.col(key).isNull()))
