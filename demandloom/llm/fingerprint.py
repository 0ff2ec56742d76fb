"""Document fingerprints: Merkle trees over sections and paragraphs.

A text is cut into sections (at blank lines, and after a number of lines where it has none), sections
into paragraphs (lines) and paragraphs into sentences. Long sentences, and all at the start of a text, are
cut further where their characters say so, not at fixed places, so an insert moves few cuts. Each node hashes its children; equal roots mean
equal texts. Two trees are compared from the root downwards: equal branches are skipped, so the differing
ones locate an edit.

A fingerprint is a string: the root, then the sections in order, ``root=section{paragraph[leaf:size,..]..}``.
"""

from __future__ import annotations

import hashlib
import re
from binascii import b2a_base64
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import map_rows

SECTION_LINES = 16
HASH_BYTES = 9
SECTION = re.compile(r"\n(?:[ \t]*\n)+")
LINE = re.compile(r"[^\n]*\n|[^\n]+")
# Up to and including the space behind a closing mark; marks of scripts without spaces need none.
SENTENCE = re.compile(r".*?(?:[.!?]+[ \t]+|[。！？｡]+[ \t」』”’）]*)|.+", re.DOTALL)
# Sentences up to this length are whole leaves, but not near the start of a text, where leaves of about 4
# and then 16 code points (and 64 behind it) also tell short texts apart.
WHOLE_SENTENCE = 400
LEAF_SIZES = ((128, 4), (512, 16))
LONG_LEAF = 64
# From here on the leaves of a sentence don't depend on its place.
FAR = LEAF_SIZES[-1][0]
URL_SAFE = bytes.maketrans(b"+/", b"-_")
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
SECTIONS = re.compile(r"([\w-]+)\{(.*?)\}")
PARAGRAPHS = re.compile(r"([\w-]+)\[(.*?)\]")


@dataclass(slots=True)
class Node:
    """A branch: its hash, its place in the text in code points, its children."""

    digest: str
    start: int
    size: int
    children: list[Node]


def _hash(data: bytes, kind: bytes) -> str:
    made = hashlib.blake2b(data, digest_size=HASH_BYTES, person=kind).digest()
    return b2a_base64(made, newline=False).translate(URL_SAFE).decode()


def _parent(children: list[Node], start: int, kind: bytes) -> Node:
    joined = ",".join(f"{c.digest}:{c.size}" for c in children).encode()
    return Node(_hash(joined, kind), start, sum(c.size for c in children), children)


def _sections(text: str) -> Iterator[str]:
    """Cuts at blank lines; sections of more lines are cut after every ``SECTION_LINES``."""
    at = 0
    for gap in [*(m.end() for m in SECTION.finditer(text)), len(text)]:
        lines = LINE.findall(text, at, gap)
        for i in range(0, len(lines), SECTION_LINES):
            yield "".join(lines[i:i + SECTION_LINES])
        at = gap


def _leaf_size(at: int) -> int:
    return next((size for end, size in LEAF_SIZES if at < end), LONG_LEAF)


def _leaves(sentence: str, at: int) -> Iterator[str]:
    """A sentence that starts at ``at``, cut by a rolling hash of four characters if too long."""
    n, size = len(sentence), _leaf_size(at)
    if n <= (WHOLE_SENTENCE if size == LONG_LEAF else 2 * size):
        yield sentence
        return
    codes = np.frombuffer(sentence.encode("utf-32-le"), np.uint32)
    rolled = np.zeros(n, np.uint32)
    for back, factor in enumerate(MIX[:n]):
        rolled[back:] += codes[:n - back] * factor
    rolled = (rolled ^ (rolled >> np.uint32(15))) * MIX[0] >> np.uint32(8)
    start, cuts, cuts_of = 0, [], 0
    while start < n:
        size = _leaf_size(at + start)
        first, last = start + size // 2, start + 4 * size
        if n - start <= 2 * size:
            end = n
        else:
            # The first place whose hash is a multiple of the size, or else the smallest hash.
            if size != cuts_of:
                cuts, cuts_of = np.flatnonzero(rolled % np.uint32(size) == 0).tolist(), size
            i = bisect_left(cuts, first - 1)
            if i < len(cuts) and cuts[i] < last:
                end = cuts[i] + 1
            else:
                end = first + int(rolled[first - 1:last].argmin())
        yield sentence[start:end]
        start = end


def tree(text: str, known: dict | None = None) -> Node:
    """The Merkle tree of a whole text; the empty text is a root without sections.

    ``known`` keeps the leaves of sentences for trees of other texts that hold them too.
    """
    known = {} if known is None else known
    at, sections = 0, []
    for section in _sections(text):
        section_start, paragraphs = at, []
        for line in LINE.findall(section):
            line_start, leaves = at, []
            for sentence in SENTENCE.findall(line):
                key = sentence, min(at, FAR)
                cut = known.get(key)
                if cut is None:
                    cut = known[key] = [(_hash(leaf.encode(), b"leaf"), len(leaf)) for leaf in _leaves(*key)]
                for digest, size in cut:
                    leaves.append(Node(digest, at, size, []))
                    at += size
            paragraphs.append(_parent(leaves, line_start, b"paragraph"))
        sections.append(_parent(paragraphs, section_start, b"section"))
    return _parent(sections, 0, b"root")


def encode(root: Node) -> str:
    """The tree as a string; hashes of one text are the same wherever it is stored."""
    def leaves(p: Node) -> str:
        return ",".join(f"{x.digest}:{x.size}" for x in p.children)

    sections = (s.digest + "{" + "".join(f"{p.digest}[{leaves(p)}]" for p in s.children) + "}"
                for s in root.children)
    return f"{root.digest}=" + "".join(sections)


def fingerprint(text: str | None) -> str:
    return encode(tree(text or ""))


def decode(printed: str) -> Node:
    """The tree back from its string, with places in the text."""
    digest, _, rest = printed.partition("=")
    at, sections = 0, []
    for section, inner in SECTIONS.findall(rest):
        start, paragraphs = at, []
        for paragraph, listed in PARAGRAPHS.findall(inner):
            first, leaves = at, []
            for leaf in listed.split(","):
                name, _, size = leaf.partition(":")
                leaves.append(Node(name, at, int(size), []))
                at += int(size)
            paragraphs.append(Node(paragraph, first, at - first, leaves))
        sections.append(Node(section, start, at - start, paragraphs))
    return Node(digest, 0, at, sections)


def _rest(one: list[Node], other: list[Node]) -> tuple[list[Node], list[Node], int]:
    """What is left of two lists of branches without those in both, and the size of these."""
    common = Counter(n.digest for n in one) & Counter(n.digest for n in other)

    def unmatched(nodes: list[Node]) -> tuple[list[Node], int]:
        left, kept, size = Counter(common), [], 0
        for n in nodes:
            if left[n.digest] > 0:
                left[n.digest] -= 1
                size += n.size
            else:
                kept.append(n)
        return kept, size

    a, size = unmatched(one)
    b, _ = unmatched(other)
    return a, b, size


def _descend(one: Node, other: Node) -> tuple[list[Node], list[Node], int]:
    """Leaves that differ on either side, and the code points that both have."""
    if one.digest == other.digest:
        return [], [], one.size
    a, b, shared = [one], [other], 0
    for _ in range(3):
        a = [c for n in a for c in n.children]
        b = [c for n in b for c in n.children]
        a, b, size = _rest(a, b)
        shared += size
    return a, b, shared


def likeness(one: str, other: str) -> float:
    """Twice the code points in branches of both trees, over those of both texts; 1 for equal roots."""
    a, b = decode(one), decode(other)
    return tree_likeness(a, b)


def tree_likeness(a: Node, b: Node) -> float:
    if a.digest == b.digest:
        return 1.0
    return 2 * _descend(a, b)[2] / max(1, a.size + b.size)


def edits(old: str, new: str) -> list[tuple[str, int, int]]:
    """Where two texts differ: ``("old" or "new", start, end)`` in code points, neighbours joined."""
    a, b, _ = _descend(decode(old), decode(new))
    spans: list[tuple[str, int, int]] = []
    for side, nodes in (("old", a), ("new", b)):
        for n in sorted(nodes, key=lambda n: n.start):
            if spans and spans[-1][0] == side and spans[-1][2] == n.start:
                spans[-1] = (side, spans[-1][1], n.start + n.size)
            else:
                spans.append((side, n.start, n.start + n.size))
    return spans


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the fingerprint of every whole text; a null text counts as empty."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for name, value in rows:
            yield name, fingerprint(value)

    kind = documents.schema[key].dataType.simpleString()
    return map_rows(documents.select(key, text), work, f"`{key}` {kind}, fingerprint string")


def _search(value: Column, starts: list) -> Column:
    """The index of the last of the sorted ``starts`` that is not above ``value``, by bisection."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(value < F.lit(starts[middle]), between(low, middle - 1)).otherwise(
            between(middle, high))

    return between(0, len(starts) - 1)


def in_order_blocks(documents: DataFrame, key: str = "doc_id", text: str = "text",
                    blocks: int | None = None) -> DataFrame:
    """``block, borrowed, key, text`` in ascending order within partitions, whole blocks in one partition.

    Blocks are ranges of the key. The first row of a block is also lent to the end of the block before
    (that of the first block to the last one), so every row of a block has its successor behind it. Only
    the ends of the ranges reach the driver, and texts move once. Nulls come first, equal keys follow
    their texts.
    """
    if dict(documents.dtypes)[key] not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError("documents are ordered by a whole number")
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks or 2 * partitions
    # Percentiles are keys that occur, so the first key of every block is known.
    steps = [i / blocks for i in range(1, blocks)]
    ends = documents.agg(F.min(key), F.count_if(F.col(key).isNull()), F.percentile_approx(
        key, steps, 20 * blocks) if steps else F.lit(None)).first()
    starts = [None if ends[1] else ends[0], *sorted(set(ends[2] or ()) - {ends[0]})]
    named = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    block = F.when(F.col("key").isNull(), F.lit(0)).otherwise(_search(F.col("key"), starts))
    opens = F.when(F.col("block") == 0, F.col("key").eqNullSafe(F.lit(starts[0]))).otherwise(
        F.col("key").isin(starts[1:]))
    own = F.struct(F.col("block"), F.lit(False).alias("borrowed"))
    lent = F.struct(F.pmod(F.col("block") - 1, F.lit(len(starts))).alias("block"),
                    F.lit(True).alias("borrowed"))
    dealt = named.withColumn("block", block).select(
        F.explode(F.when(opens, F.array(own, lent)).otherwise(F.array(own))).alias("place"), "key", "text")
    return (dealt.select("place.*", "key", "text").repartition(partitions, "block")
            .sortWithinPartitions("block", "borrowed", "key", "text"))


def edited_half(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next text, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_in_order(documents: DataFrame, key: str = "doc_id", text: str = "text",
                     blocks: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness to that and to the next text.

    The text after the last one is the first, which for a single document is itself. Null texts are
    empty; an empty text equals its edited form. Repeated rows are compared one by one; an empty table
    gives no rows.
    """
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        last = None
        for block, borrowed, name, value in rows:
            value, known = value or "", {}
            own = tree(value, known)
            if last is not None and last[0] == block and not last[1]:
                _, _, last_name, last_value, last_tree, last_known = last
                edited = edited_half(last_value, value)
                changed = tree(edited, last_known | known)
                yield (last_name, len(last_value), hashlib.sha256(edited.encode()).hexdigest(),
                       encode(last_tree), encode(changed), tree_likeness(last_tree, changed),
                       tree_likeness(last_tree, own))
            last = (block, borrowed, name, value, own, known)

    kind = documents.schema[key].dataType.simpleString()
    return map_rows(
        in_order_blocks(documents, key, text, blocks), work,
        f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
