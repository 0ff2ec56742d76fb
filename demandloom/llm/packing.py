"""Packing without padding by powers of two.

A document of ``n`` tokens is cut into pieces whose lengths are the binary digits of ``n``, none above
the longest sequence. Every piece is a whole sequence of its own and sequences of one length form a
bucket, so no sequence crosses documents and nothing is padded.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ._tables import give_back, map_rows

LONGEST = 2048
END_ID = 1
# tiktoken's expression fails on runs of nearly a million white-space characters; texts with runs from
# this length on are left to the tokenizers library.
LONG_SPACE = 100_000
SPACE = re.compile(r"\s+")


def special_tokens(json_path: str) -> dict[str, int]:
    """The special tokens of a vocabulary file of the tokenizers library."""
    with open(json_path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


def byte_bpe(ranks_path: str, special: dict[str, int] | None = None) -> tiktoken.Encoding:
    """The byte-level vocabulary in its faster form; strings not in ``special`` are ordinary text.

    The ranks file holds the vocabulary and merges of ``byte_bpe_50k.json`` for a faster library; the
    tests hold its ids against the tokenizers library.
    """
    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=special or {})


def holds_long_space(text: str) -> bool:
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in SPACE.finditer(text))


def encoder(ranks_path: str, special_as_text: bool = False) -> Callable[[str], list[int]]:
    """Texts to ids: by tiktoken, and by the ``.json`` beside the ranks where white space is very long.

    The string of a special token in a text is that token, as the tokenizers library has it by default;
    with ``special_as_text`` it is ordinary text, so that no text can end a document early.
    """
    json_path = os.path.splitext(ranks_path)[0] + ".json"
    special = {} if special_as_text else special_tokens(json_path)
    fast, slow = byte_bpe(ranks_path, special), None

    def encode(text: str) -> list[int]:
        nonlocal slow
        if not holds_long_space(text):
            if any(token in text for token in special):
                return fast.encode(text, allowed_special="all")
            return fast.encode_ordinary(text)
        if slow is None:
            slow = Tokenizer.from_file(json_path)
            slow.encode_special_tokens = special_as_text
        return slow.encode(text, add_special_tokens=False).ids

    return encode


def binary_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that add up to ``n``: as many of the longest as fit, then the binary digits."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(documents: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text",
         longest: int = LONGEST, end_id: int = END_ID, special_as_text: bool = False) -> DataFrame:
    """One row per piece: ``key, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers. Every text ends with ``end_id``; a null or empty
    text is that id alone. A piece is its own sequence (``offset`` 0) in the bucket of its ``length``;
    sequence ids are unique and follow the input's partitions. Repeated rows are packed one by one; an
    empty table gives no rows; other columns are not read. ``special_as_text`` is as for ``encoder``.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        encode = encoder(ranks_path, special_as_text)
        for name, value in rows:
            ids = np.array([*encode(value or ""), end_id], dtype="<u4")
            start = 0
            for length in binary_lengths(len(ids), longest):
                yield name, start, length, ids[start:start + length].tobytes(), len(ids)
                start += length
        del encode
        give_back()

    kind = documents.schema[key].dataType.simpleString()
    pieces = map_rows(documents.select(key, text), work,
                      f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long")
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(),
                               "offset": F.lit(0).cast("long")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length, so a training batch needs no padding."""
    packed.write.partitionBy("length").parquet(path)
