"""Language identification with unigram pieces, summed over all segmentations.

Every language has probabilities of the pieces of one fixed public vocabulary. A word's probability is the
sum over all ways to cut it into pieces, found by the forward algorithm; a text's is the product over its
words. The probabilities are fitted by expectation maximisation: forward and backward sums give the
expected number of times each piece is used, whatever the segmentation.

Words are worked on in groups of one length, as arrays. Runs of letters of any length are one word; long
ones are gone through in steps, in logarithms, with only the sums in reach of the longest piece held.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb

from ..sources.staging import stage
from ._tables import map_rows

MARK = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
# Learning: documents per language (on average; all of a rarer one), rounds, and added counts.
SAMPLE_DOCUMENTS, ROUNDS, SMOOTHING = 6_000, 3, 0.05
# Words above this length are computed in logarithms, in steps of so many characters of all words together.
LONG_WORD, STEP_CHARS = 40, 1 << 16
# Words scored together, and words and their characters that a task remembers.
WORD_BATCH, MEMORY_WORDS, MEMORY_CHARS = 20_000, 300_000, 1 << 24
UNKNOWN_LANGUAGE = "und"
# Keeps products of small probabilities inside the range of doubles.
PER_CHARACTER = 1000.0
BASE, SPREAD = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
TABLE_BITS = 20


class Pieces:
    """The letters-only pieces of a vocabulary file, lower-cased, found by the hash of a substring."""

    def __init__(self, path: str):
        model = model_pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        found = {p.piece.lower() for p in model.pieces if p.type == 1}
        self.pieces = sorted(p for p in found if p == MARK or LETTERS.fullmatch(p.removeprefix(MARK)))
        self.longest = max(map(len, self.pieces), default=1)
        # One more for a character that is no piece.
        self.size, self.unknown = len(self.pieces) + 1, len(self.pieces)
        self.tables = []
        left = list(range(len(self.pieces)))
        hashes = [self._hash_of(p) for p in self.pieces]
        for spread in SPREAD:
            keys, ids = np.zeros(1 << TABLE_BITS, np.uint64), np.full(1 << TABLE_BITS, -1, np.int32)
            crowded = []
            for i in left:
                at = (int(hashes[i]) * int(spread) & (1 << 64) - 1) >> (64 - TABLE_BITS)
                if ids[at] < 0:
                    keys[at], ids[at] = hashes[i], i
                else:
                    crowded.append(i)
            self.tables.append((spread, keys, ids))
            left = crowded
        if left:
            raise ValueError("the piece tables are too small for this vocabulary")

    @staticmethod
    def _hash_of(piece: str) -> np.uint64:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) & (1 << 64) - 1
        return np.uint64(h)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        out = np.full(hashes.shape, -1, np.int32)
        for spread, keys, ids in self.tables:
            at = (hashes * spread) >> np.uint64(64 - TABLE_BITS)
            hit = (keys[at] == hashes) & (ids[at] >= 0)
            out = np.where(hit, ids[at], out)
        return out

    def lattice(self, words: list[str]) -> list[np.ndarray]:
        """For words of one length, the pieces of length 1, 2, .. at every start: arrays (word, start)."""
        codes = np.array([[ord(c) for c in w] for w in words], np.uint64) + np.uint64(1)
        length = codes.shape[1]
        spans, h = [], codes
        for size in range(1, min(length, self.longest) + 1):
            if size > 1:
                h = h[:, :-1] * BASE + codes[:, size - 1:]
            spans.append(self.find(h))
        spans[0] = np.where(spans[0] < 0, np.int32(self.unknown), spans[0])
        return spans


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters, marked at the start."""
    found = LETTERS.findall(text.lower())
    if not all(map(str.isalpha, found)):  # some signs count as word characters, but are no letters
        found = [w for w in ("".join(filter(str.isalpha, w)) for w in found) if w]
    return [MARK + w for w in found]


def _scaled(probabilities: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Probabilities times a constant per character, and a last row of zeros for "no piece"."""
    sizes = np.array([len(p) for p in pieces.pieces] + [1], float)
    scaled = probabilities * (PER_CHARACTER ** sizes)[:, None]
    return np.vstack([scaled, np.zeros(probabilities.shape[1])])


def _forward(spans: list[np.ndarray], scaled: np.ndarray) -> np.ndarray:
    """Sums over the segmentations of every prefix: (end, word, language)."""
    count, length = spans[0].shape
    sums = np.zeros((length + 1, count, scaled.shape[1]))
    sums[0] = 1
    for end in range(1, length + 1):
        for size in range(1, min(end, len(spans)) + 1):
            piece = spans[size - 1][:, end - size]
            if size == 1 or (piece >= 0).any():
                sums[end] += sums[end - size] * scaled[piece]
    return sums


def _steps(words: list[str]) -> list[tuple[int, int]]:
    """Stretches of words of one length, of a bounded number of characters in all words together."""
    size, step = len(words[0]), max(16, STEP_CHARS // len(words))
    return [(start, min(start + step, size)) for start in range(0, size, step)]


def _pieces_ending(words: list[str], pieces: Pieces, start: int, stop: int) -> np.ndarray:
    """Pieces that end behind each character from ``start`` to ``stop``, longest first: (end, size, word)."""
    back = max(0, start + 1 - pieces.longest)
    out = np.full((stop - start, pieces.longest, len(words)), -1, np.int32)
    for size, span in enumerate(pieces.lattice([w[back:stop] for w in words]), 1):
        first = max(0, start + 1 - back - size)
        part = span[:, first:stop - back - size + 1]
        at = back + first + size - start - 1
        out[at:at + part.shape[1], -size] = part.T
    return out


def _pieces_starting(words: list[str], pieces: Pieces, start: int, stop: int) -> np.ndarray:
    """Pieces that start at each character from ``start`` to ``stop``, shortest first: (start, size, word)."""
    out = np.full((stop - start, pieces.longest, len(words)), -1, np.int32)
    for size, span in enumerate(pieces.lattice([w[start:stop + pieces.longest - 1] for w in words]), 1):
        part = span[:, :stop - start]
        out[:part.shape[1], size - 1] = part.T
    return out


def _long_forward(words: list[str], pieces: Pieces, logs: np.ndarray) -> Iterator[np.ndarray]:
    """Logarithms of the sums over all segmentations of prefixes, step by step: (end, word, language)."""
    reach = pieces.longest
    held = np.full((reach, len(words), logs.shape[1]), -np.inf)
    held[-1] = 0
    for start, stop in _steps(words):
        found = _pieces_ending(words, pieces, start, stop)
        sums = np.concatenate([held, np.empty((stop - start, *held.shape[1:]))])
        for i in range(stop - start):
            sums[reach + i] = np.logaddexp.reduce(sums[i:reach + i] + logs[found[i]], axis=0)
        yield sums[reach:]
        held = sums[-reach:].copy()


def _long_counts(words: list[str], times: np.ndarray, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """How often each piece is expected in long words of one length and language."""
    ahead = np.concatenate([np.zeros((1, len(words))), *(s[:, :, 0] for s in _long_forward(words, pieces, logs))])
    counts, reach = np.zeros(pieces.size), pieces.longest
    held = np.full((reach, len(words)), -np.inf)
    held[0] = 0
    for start, stop in reversed(_steps(words)):
        found = _pieces_starting(words, pieces, start, stop)
        chances = logs[found, 0]
        behind = np.concatenate([np.empty((stop - start, len(words))), held])
        for i in range(stop - start - 1, -1, -1):
            behind[i] = np.logaddexp.reduce(chances[i] + behind[i + 1:i + 1 + reach], axis=0)
        for size in range(1, reach + 1):
            piece = found[:, size - 1]
            known = piece >= 0
            use = np.exp(ahead[start:stop] + chances[:, size - 1] + behind[size:size + stop - start] - ahead[-1]) * times
            counts += np.bincount(piece[known], use[known], minlength=pieces.size)
        held = behind[:reach]
    return counts


def _logs(scaled: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Logarithms of probabilities from their scaled form; the last row is "no piece"."""
    sizes = np.array([len(p) for p in pieces.pieces] + [1, 0], float)
    with np.errstate(divide="ignore"):
        return np.log(scaled) - np.log(PER_CHARACTER) * sizes[:, None]


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Positions of words of one length, in groups of bounded size."""
    sizes = np.array([len(w) for w in words])
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        step = max(1, min(WORD_BATCH // 4, STEP_CHARS * 4 // int(length)))
        for start in range(0, len(at), step):
            yield at[start:start + step]


def word_scores(words: list[str], pieces: Pieces, scaled: np.ndarray) -> np.ndarray:
    """Log probabilities (word, language) of words, all segmentations summed."""
    out = np.empty((len(words), scaled.shape[1]))
    logs = _logs(scaled, pieces) if any(len(w) > LONG_WORD for w in words) else None
    for at in _by_length(words):
        group = [words[i] for i in at]
        if len(group[0]) > LONG_WORD:
            for sums in _long_forward(group, pieces, logs):
                out[at] = sums[-1]
            continue
        total = _forward(pieces.lattice(group), scaled)[-1]
        out[at] = np.log(np.maximum(total, 1e-300)) - len(group[0]) * np.log(PER_CHARACTER)
    return out


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, scaled: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words of one language that occur so many ``times``."""
    counts = np.zeros(pieces.size)
    logs = _logs(scaled, pieces) if any(len(w) > LONG_WORD for w in words) else None
    for at in _by_length(words):
        if len(words[at[0]]) > LONG_WORD:
            counts += _long_counts([words[i] for i in at], times[at], pieces, logs)
            continue
        spans = pieces.lattice([words[i] for i in at])
        ahead = _forward(spans, scaled)[:, :, 0]
        length = ahead.shape[0] - 1
        behind = np.zeros_like(ahead)
        behind[length] = 1
        for start in range(length - 1, -1, -1):
            for size in range(1, min(length - start, len(spans)) + 1):
                piece = spans[size - 1][:, start]
                behind[start] += scaled[piece, 0] * behind[start + size]
        share = times[at] / np.maximum(ahead[length], 1e-300)
        for size, span in enumerate(spans, 1):
            for start in range(length - size + 1):
                piece = span[:, start]
                known = piece >= 0
                if known.any():
                    use = ahead[start] * scaled[piece, 0] * behind[start + size] * share
                    counts += np.bincount(piece[known], use[known], minlength=pieces.size)
    return counts


def held_out(key: Column) -> Column:
    """Whether a document is kept out of learning: by the checksum of its id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _word_counts(learned: DataFrame) -> DataFrame:
    def summed(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[tuple[str, str], int] = {}
        size = 0
        for lang, text in rows:
            size += len(text)
            for word in words_of(text):
                held[lang, word] = held.get((lang, word), 0) + 1
            if len(held) >= MEMORY_WORDS or size >= MEMORY_CHARS:
                yield from ((a, b, n) for (a, b), n in held.items())
                held, size = {}, 0
        yield from ((a, b, n) for (a, b), n in held.items())

    return (map_rows(learned, summed, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def learn(documents: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
          lang: str = "lang", per_language: int = SAMPLE_DOCUMENTS,
          rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, piece probabilities (piece, language) and shares, from documents not held out.

    Of a language with more than ``per_language`` documents, about that many are taken by a hash of id
    and text; all of a rarer one are. Word counts stay in Spark; the driver gets one number per piece
    and language and round.
    """
    usable = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("lang")).filter(
        ~held_out(F.col("_key")) & F.col("_text").isNotNull() & F.col("lang").isNotNull())
    totals = usable.groupBy("lang").agg(F.count("*").alias("n"))
    shares = {r["lang"]: r["n"] for r in totals.collect()}
    languages = sorted(shares)
    if not languages:
        return [], np.zeros((0, 0)), np.zeros(0)
    part = F.pmod(F.xxhash64("_key", "_text"), F.lit(1 << 30)) / float(1 << 30)
    # As literals, so that no text is shuffled by language.
    rates = F.create_map(*[F.lit(v) for name in languages for v in (name, per_language / shares[name])])
    chosen = usable.filter(part < rates[F.col("lang")]).select("lang", "_text")
    words = stage(_word_counts(chosen), "language-words")
    pieces = Pieces(vocabulary)
    probabilities = np.full((pieces.size, len(languages)), 1 / pieces.size)
    place = {name: i for i, name in enumerate(languages)}
    spark = documents.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(_scaled(probabilities, pieces))

        def work(rows: Iterator[tuple]) -> Iterator[tuple]:
            own, scaled = Pieces(vocabulary), shared.value
            held: dict[str, list] = {}

            def count(name: str, group: list) -> np.ndarray:
                return expected_counts([w for w, _ in group], np.array([n for _, n in group], float),
                                       own, scaled[:, [place[name]]])

            sums: dict[str, np.ndarray] = {}
            for name, word, n in rows:
                group = held.setdefault(name, [])
                group.append((word, n))
                if len(group) >= WORD_BATCH or len(word) >= WORD_BATCH:
                    sums[name] = sums.get(name, 0) + count(name, held.pop(name))
            for name, group in held.items():
                sums[name] = sums.get(name, 0) + count(name, group)
            for name, total in sums.items():
                for piece in np.flatnonzero(total):
                    yield name, int(piece), float(total[piece])

        found = map_rows(words, work, "lang string, piece int, n double").groupBy("lang", "piece").agg(
            F.sum("n").alias("n")).toPandas()
        counts = np.full((pieces.size, len(languages)), SMOOTHING)
        np.add.at(counts, (found["piece"].to_numpy(int), found["lang"].map(place).to_numpy(int)),
                  found["n"].to_numpy(float))
        probabilities = counts / counts.sum(0)
    weight = np.array([shares[name] for name in languages], float)
    return languages, probabilities, weight / weight.sum()


def identify(documents: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], vocabulary: str,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` of every row; the score is the posterior of the predicted language.

    Only the text is used. A null text, one without a letter, or a model without languages gives
    ``und`` with score 0. Ties go to the language that sorts first. Repeated rows get equal results; an
    empty table gives no rows.
    """
    languages, probabilities, shares = model
    shared = documents.sparkSession.sparkContext.broadcast((languages, probabilities, shares))

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        names, chances, prior = shared.value
        pieces = Pieces(vocabulary)
        scaled = _scaled(chances, pieces) if names else None
        known: dict[str, int] = {}
        chars, table = 0, np.empty((0, len(names)))

        def judge(group: list[tuple]) -> Iterator[tuple]:
            nonlocal known, chars, table
            split = [words_of(value) if value and names else [] for _, value in group]
            if len(known) > MEMORY_WORDS or chars > MEMORY_CHARS:
                known, chars, table = {}, 0, np.empty((0, len(names)))
            new = list(dict.fromkeys(w for words in split for w in words if w not in known))
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                chars += sum(map(len, new))
                table = np.vstack([table, word_scores(new, pieces, scaled)])
            for (name, _), words in zip(group, split, strict=True):
                if not words:
                    yield name, UNKNOWN_LANGUAGE, 0.0
                    continue
                total = table[np.fromiter(map(known.__getitem__, words), int, len(words))].sum(0)
                total += np.log(prior)
                best = int(np.argmax(total))
                yield name, names[best], float(1 / np.exp(total - total[best]).sum())

        held, size = [], 0
        for name, value in rows:
            held.append((name, value))
            size += len(value or "")
            if size >= 1 << 21 or len(held) >= 4096:
                yield from judge(held)
                held, size = [], 0
        yield from judge(held)

    kind = documents.schema[key].dataType.simpleString()
    return map_rows(documents.select(key, text), work, f"`{key}` {kind}, lang_pred string, score double")
