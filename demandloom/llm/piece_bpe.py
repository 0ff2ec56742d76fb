"""Encoding and decoding with merge-type SentencePiece vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the piece they would form, ties
from the left, and merges the best pair until none is left. Merges never cross the start of a word when
no piece has a word mark behind another character, so texts are cut there (the vocabulary is asked, not
assumed) and the ids of words met before are reused. What the agenda makes of new words is compared with
the sentencepiece library, batch by batch.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_pb

from ._tables import map_rows

MARK = "▁"
# Words that one Python worker remembers twice over (lately and before), and the longest of them.
MEMORY_WORDS, MEMORY_CHARS = 400_000, 40
# New words that are given to the library together.
CHECK_WORDS = 8192
# Kinds of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class PieceEncoder:
    """One vocabulary file of merge type, with the sentencepiece library beside it."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = model_pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normalizer = model.normalizer_spec
        if model.trainer_spec.model_type != 2:
            raise ValueError("the vocabulary is not of merge type")
        if (normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces
                or not normalizer.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix
                or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces)):
            raise ValueError("only plain normalisation and normal pieces are supported")
        self.prefix = MARK if normalizer.add_dummy_prefix else ""
        self.number = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        scores = {p.score for p in model.pieces if p.type == NORMAL}
        place = {score: i for i, score in enumerate(sorted(scores, reverse=True))}
        self.order = {p.piece: place[p.score] for p in model.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.words = re.compile(self._word_pattern(), re.DOTALL)
        self.young: dict[str, tuple[tuple[int, ...], str]] = {}
        self.old: dict[str, tuple[tuple[int, ...], str]] = {}

    def _word_pattern(self) -> str:
        """Pieces of text between which no merge is possible, as far as the vocabulary allows."""
        if any(MARK in p.lstrip(MARK) for p in self.number):
            return ".+"
        latin = "A-Za-zÀ-ÖØ-öø-ɏ"
        apart = re.compile(f"{MARK}*[{latin}]+|{MARK}*[^{MARK}{latin}]+|{MARK}+")
        if all(apart.fullmatch(p) for p in self.number):
            return apart.pattern
        return f"{MARK}*[^{MARK}]+|{MARK}+"

    def merge(self, word: str) -> list[str]:
        """The pieces of one word, by an agenda of adjacent pairs.

        An entry is the order of the piece a pair would form and the pair's place, as one number.
        ``waiting`` has the order that is current for each place, so entries of pairs that are gone are
        passed over.
        """
        order, size = self.order.get, len(word)
        symbols, waiting = list(word), [order(word[i:i + 2]) for i in range(size)]
        waiting[-1] = None
        agenda = [o * size + i for i, o in enumerate(waiting) if o is not None]
        heapq.heapify(agenda)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        while agenda:
            best, left = divmod(heapq.heappop(agenda), size)
            if waiting[left] != best:
                continue
            right = after[left]
            joined = symbols[left] + symbols[right]
            symbols[left], symbols[right], waiting[right] = joined, "", None
            after[left] = right = after[right]
            waiting[left] = None
            if right < size:
                before[right] = left
                waiting[left] = found = order(joined + symbols[right])
                if found is not None:
                    heapq.heappush(agenda, found * size + left)
            previous = before[left]
            if previous >= 0:
                waiting[previous] = found = order(symbols[previous] + joined)
                if found is not None:
                    heapq.heappush(agenda, found * size + previous)
        return [s for s in symbols if s]

    def ids(self, word: str) -> tuple[int, ...]:
        out = []
        for piece in self.merge(word):
            found = self.number.get(piece)
            if found is not None:
                out.append(found)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            elif not out or out[-1] != self.unknown:  # neighbouring unknown characters share one id
                out.append(self.unknown)
        return tuple(out)

    def words_of(self, text: str, new: dict[str, tuple[int, ...]] | None = None) -> list[tuple]:
        """The words of a whole text as ``(ids, the same printed with commas)``.

        Words that were not in memory are noted in ``new``.
        """
        if not text:
            return []
        young, out = self.young, []
        for word in self.words.findall((self.prefix + text).replace(" ", MARK)):
            entry = young.get(word)
            if entry is None:
                entry = self.old.get(word)
                if entry is None:
                    ids = self.ids(word)
                    entry = (ids, ",".join(map(str, ids)))
                    if new is not None:
                        new[word] = ids
                if len(word) <= MEMORY_CHARS:
                    young[word] = entry
            out.append(entry)
        if len(young) >= MEMORY_WORDS:
            self.old, self.young = young, {}
        return out

    def encode(self, text: str) -> list[int]:
        return [i for ids, _ in self.words_of(text) for i in ids]

    def decode(self, ids: Iterable[int]) -> str:
        return self.library.decode(list(ids))

    def check(self, new: dict[str, tuple[int, ...]]) -> None:
        """Compare new words that begin with the prefix with the library, which takes them on their own."""
        prefix = self.prefix
        words = [w for w in new if not prefix or w.startswith(prefix)]
        plain = [w[len(prefix):].replace(MARK, " ") for w in words]
        for word, expected in zip(words, self.library.encode(plain, num_threads=1), strict=True):
            if word != prefix and tuple(expected) != new[word]:
                raise ValueError(f"the library encodes {word!r} as {expected}, not {new[word]}")


    def stretches(self, text: str, wanted: set[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Words without the prefix that are ``wanted``, with all words back to one that has it, and their ids."""
        run: list[str] = []
        for word in [*self.words.findall((self.prefix + text).replace(" ", MARK)), self.prefix]:
            if word.startswith(self.prefix):
                if not wanted.isdisjoint(run):
                    yield "".join(run), tuple(i for w in run for i in self.ids(w))
                run = []
            run.append(word)


@functools.cache
def encoder_of(path: str) -> PieceEncoder:
    """One encoder per worker and vocabulary, so its memory of words outlives a task."""
    return PieceEncoder(path)


def _encoded(rows: Iterator[tuple], path: str, check: bool) -> Iterator[tuple]:
    """``key, words, ids`` of every row; new words go through the library in batches."""
    encoder = encoder_of(path)
    new: dict[str, tuple[int, ...]] = {}
    for name, value in rows:
        before = len(new)
        words = encoder.words_of(value or "", new if check else None)
        inner = {w for w in islice(reversed(new), len(new) - before) if not w.startswith(encoder.prefix)}
        if inner:  # the library takes them only together with the word before
            new.update(encoder.stretches(value, inner))
        if len(new) >= CHECK_WORDS:
            encoder.check(new)
            new.clear()
        yield name, words, list(chain.from_iterable([ids for ids, _ in words]))
    encoder.check(new)


def encode_table(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 check: bool = True) -> DataFrame:
    """``key``, the ids of every whole text and the text decoded from them.

    A null text is empty and has no ids. Rows are independent: repeated rows give repeated results, an
    empty table gives none. With ``check`` every word that a worker meets for the first time is also
    encoded by the library, and a difference is an error.
    """
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        decode = encoder_of(path).decode
        for name, _, ids in _encoded(rows, path, check):
            yield name, ids, decode(ids)

    kind = documents.schema[key].dataType.simpleString()
    return map_rows(documents.select(key, text), work,
                    f"`{key}` {kind}, ids array<int>, decoded string")


def digest_table(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 check: bool = True) -> DataFrame:
    """The same as digests: the number of ids, SHA-256 of their list and of the decoded text."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        decode = encoder_of(path).decode
        for name, words, ids in _encoded(rows, path, check):
            listed = ",".join([printed for _, printed in words]).encode()
            yield (name, len(ids), hashlib.sha256(listed).hexdigest(),
                   hashlib.sha256(decode(ids).encode()).hexdigest())

    kind = documents.schema[key].dataType.simpleString()
    return map_rows(documents.select(key, text), work,
                    f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
