"""Byte-level BPE by reuse of content-defined chunks.

A rolling hash over the last characters decides where a text is cut, so passages that documents share fall
into equal chunks wherever they stand. A worker encodes a chunk once and keeps its ids. Chunks are cut
without regard to words, so their joins are wrong at first and are repaired: the text around a join is
encoded again, from the last place before it to the first place behind it where every split of the text
into words agrees. That is between a letter or digit and an ASCII space or mark: no word of the
vocabulary's pattern holds both, and the pattern doesn't look back. Chunks without such a place are
joined to their neighbours until there is one, so the ids are those of the whole text.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from ._tables import map_rows

# Characters that the rolling hash sees, and the bits of it that are zero at a cut (one place in 512).
WINDOW, CUT_BITS = 32, 9
SHORTEST, LONGEST = 64, 8192
# Characters of a text that are hashed at once.
HASH_PART = 1 << 20
# Characters of chunks that one worker remembers twice over (lately and before), and of joins.
MEMORY_CHUNKS, MEMORY_JOINS = 16_000_000, 2_000_000
# Longer texts between two agreed places are left to the tokenizers library; the faster one can't hold them.
LONG = 50_000

# Characters that are letters or digits in every version of Unicode, and ends of words.
LETTERS = "0-9A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-Ωα-ωА-яא-תぁ-ゖァ-ヺ一-龥가-힣"
ENDS = r" \t\n\r!-/:-@\[-`{-~"
AGREED = re.compile(f"[{LETTERS}](?=[{ENDS}])")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def cut_places(text: str) -> list[int]:
    """Where the text is cut: after each run of ``WINDOW`` characters whose hash ends in zeros.

    Cuts nearer than ``SHORTEST`` to the one before are left out; stretches without a cut are cut at
    ``LONGEST``.
    """
    found, last = [], 0
    for start in range(0, len(text), HASH_PART):
        lead = min(start, WINDOW - 1)
        codes = np.frombuffer(text[start - lead:start + HASH_PART].encode("utf-32-le"), dtype="<u4")
        mixed = codes * np.uint32(0x9E3779B1)
        rolled = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        width = 1
        while width < WINDOW:  # sums over twice as many characters each time
            wider = rolled.copy()
            wider[width:] += rolled[:-width] << np.uint32(width)
            rolled, width = wider, 2 * width
        zero = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1
        for place in (zero[zero > lead] + (start - lead)).tolist():
            while place - last > LONGEST:
                last += LONGEST
                found.append(last)
            if place - last >= SHORTEST and place >= WINDOW:
                last = place
                found.append(last)
    while len(text) - last > LONGEST:
        last += LONGEST
        found.append(last)
    return found


def cut(text: str) -> list[str]:
    places = [0, *cut_places(text), len(text)]
    return [text[a:b] for a, b in zip(places, places[1:], strict=False) if b > a]


def last_agreed(chunk: str) -> int:
    """The last place where every split into words agrees; the chunk has one."""
    reach = 64
    while True:
        start = max(0, len(chunk) - reach)
        found = [m.end() for m in AGREED.finditer(chunk, start)]
        if found:
            return found[-1]
        reach *= 8


class Memory:
    """What was used lately, bounded by characters: two halves, of which the older one is forgotten."""

    def __init__(self, limit: int):
        self.limit, self.size, self.young, self.old = limit, 0, {}, {}

    def get(self, name: str):
        found = self.young.get(name)
        if found is None and (found := self.old.get(name)) is not None:
            self.put(name, found)
        return found

    def put(self, name: str, value) -> None:
        self.young[name] = value
        self.size += len(name)
        if self.size >= self.limit:
            self.old, self.young, self.size = self.young, {}, 0


class ChunkEncoder:
    """One byte-level vocabulary of the tokenizers library, with a memory of chunks and joins.

    ``encoded`` and ``reused`` count characters of chunks that were encoded and that were remembered.
    """

    def __init__(self, path: str, chunk_memory: int = MEMORY_CHUNKS, join_memory: int = MEMORY_JOINS):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        if (spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
                or not split.get("use_regex") or model["type"] != "BPE" or model.get("dropout")
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
            raise ValueError("only byte-level vocabularies without normalisation are supported")
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = re.compile("(" + "|".join(
            map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        of = byte_alphabet()
        ranks = {bytes(of[c] for c in token): number for token, number in model["vocab"].items()
                 if token not in self.special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        formed = [model["vocab"][left + right] for left, right in pairs]
        if formed != sorted(formed):
            raise ValueError("the merges of the vocabulary are not in the order of their ids")
        self.fast = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        # What the library's decoder makes of each token, and the token's id in decimal.
        tokens = {number: token for token, number in self.library.get_vocab().items()}
        self.pieces = {number: bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
                       for number, token in tokens.items()} if (spec["decoder"] or {}).get("type") == "ByteLevel" else {}
        self.decimals = {number: str(number) for number in tokens}
        self.chunks, self.joins = Memory(chunk_memory), Memory(join_memory)
        self.encoded = self.reused = 0

    def _plain(self, text: str) -> list[int]:
        if len(text) < LONG:
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def _chunk(self, chunk: str) -> tuple[str, list[int], str] | tuple[()]:
        """Text before the first agreed place, ids up to the last one, text behind it."""
        known = self.chunks.get(chunk)
        if known is not None:
            self.reused += len(chunk)
            return known
        self.encoded += len(chunk)
        first = AGREED.search(chunk)
        entry: tuple = ()
        if first:
            start, end = first.end(), last_agreed(chunk)
            entry = (chunk[:start], self._plain(chunk[start:end]), chunk[end:])
        self.chunks.put(chunk, entry)
        return entry

    def _join(self, text: str) -> list[int]:
        if not text:
            return []
        known = self.joins.get(text)
        if known is None:
            known = self._plain(text)
            if len(text) < LONG:
                self.joins.put(text, known)
        return known

    def _segment(self, text: str) -> Iterator[list[int]]:
        """Ids of a text without special tokens, in parts that end at agreed places."""
        held: list[str] = []
        for chunk in cut(text):
            entry = self._chunk(chunk)
            if entry:
                head, ids, tail = entry
                yield self._join("".join([*held, head]))
                yield ids
                held = [tail]
            else:
                held.append(chunk)
        yield self._join("".join(held))

    def encode(self, text: str) -> list[int]:
        """Exactly what the library gives without added begin or end ids.

        The string of a special token in a text is that token, as the library has it by default.
        """
        out: list[int] = []
        for part in self.splitter.split(text) if self.splitter else [text]:
            number = self.special.get(part)
            if number is not None:
                out.append(number)
            elif part:
                for ids in self._segment(part):
                    out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """Exactly what the library gives with special tokens: the bytes of all tokens, read as UTF-8."""
        try:
            return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")
        except KeyError:  # not in the vocabulary, or another decoder
            return self.library.decode(ids, skip_special_tokens=False)

    def listed(self, ids: list[int]) -> str:
        """Ids of the vocabulary in decimal, joined by commas."""
        return ",".join(map(self.decimals.__getitem__, ids))


@functools.cache
def encoder_of(path: str) -> ChunkEncoder:
    """One encoder per worker and vocabulary, so its chunks outlive a task."""
    return ChunkEncoder(path)


def encode_table(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the ids of every whole text and the text decoded from them.

    A null text is empty and has no ids. Rows are independent: repeated rows give repeated results, rows
    without a key keep a null one, an empty table gives no rows, and other columns are not read.
    """
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = encoder_of(path)
        for name, value in rows:
            ids = encoder.encode(value or "")
            yield name, ids, encoder.decode(ids)

    kind = documents.schema[key].dataType.simpleString()
    return map_rows(documents.select(key, text), work,
                    f"`{key}` {kind}, ids array<int>, decoded string")


def digest_table(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The same as digests: the number of ids, SHA-256 of their list and of the decoded text."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = encoder_of(path)
        for name, value in rows:
            ids = encoder.encode(value or "")
            yield (name, len(ids), hashlib.sha256(encoder.listed(ids).encode()).hexdigest(),
                   hashlib.sha256(encoder.decode(ids).encode()).hexdigest())

    kind = documents.schema[key].dataType.simpleString()
    return map_rows(documents.select(key, text), work,
                    f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
