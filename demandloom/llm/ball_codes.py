"""Vector code compression: one ball k-means per part of the vectors.

Vectors are cut into equal parts and every part position has a codebook. The parts that share an entry
form its ball: a centre and a radius no part of it exceeds. An entry farther away than twice that radius
can't take a part from the ball, so only the others are its neighbours. A part nearer to its centre than
half the way to the first neighbour lies in the stable core and keeps its entry without another look; the
rest lie in rings, and a part in the k-th ring is compared with the k nearest neighbours only. All of it is
integer arithmetic: nothing is rounded, and ties are kept in.

The entry of every part travels with its row: a round reads the last round's table and writes its own, and
the one before is deleted. A task sends one count, sum and radius per entry; the driver holds codebooks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import drop_folders, recorded, stage
from ._vectors import integers, mean_floor, packed, squared, unpacked, usable

PARTS, ENTRIES, ROUNDS, FACTOR = 8, 16, 6, 4096
# Vectors that are compared with the entries at once.
BATCH = 4096


@dataclass(frozen=True)
class Balls:
    """The codebook of one part position with what its balls rule out."""

    entries: np.ndarray    # one row per entry
    apart: np.ndarray      # squared distances between entries
    neighbour: np.ndarray  # whether an entry (column) can take parts from a ball (row)
    core: np.ndarray       # squared distance to the nearest neighbour, by ball


def balls_of(entries: np.ndarray, radii: list[int] | None = None) -> Balls:
    """``radii``: no part of a ball is farther from its centre; without them every entry is a neighbour."""
    n = len(entries)
    apart = np.stack([squared(entries, e[None, :]) for e in entries]) if n else np.zeros((0, 0), np.int64)
    reach = np.array([4 * r * r if r < 1 << 30 else np.iinfo(np.int64).max for r in radii],
                     dtype=np.int64) if radii is not None else np.full(n, np.iinfo(np.int64).max)
    neighbour = (apart <= reach[:, None]) & ~np.eye(n, dtype=bool)
    core = np.where(neighbour, apart, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
    return Balls(entries, apart, neighbour, core)


def nearest_entries(parts: np.ndarray, home: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry (ties: the lower index), squared distance, and how many distances were computed.

    ``home`` is any entry per part, the last round's as a rule; every part lies in the ball of its home.
    """
    inside = squared(parts, balls.entries[home])
    best, least = home.copy(), inside.copy()
    outer = np.flatnonzero(4 * inside >= balls.core[home])
    ring = (balls.apart[home[outer]] <= 4 * inside[outer, None]) & balls.neighbour[home[outer]]
    row, entry = np.nonzero(ring)
    distances = np.full(ring.shape, np.iinfo(np.int64).max)
    distances[row, entry] = squared(parts[outer[row]], balls.entries[entry])
    distances[np.arange(len(outer)), home[outer]] = inside[outer]
    best[outer] = distances.argmin(axis=1)
    least[outer] = distances[np.arange(len(outer)), best[outer]]
    return best, least, len(parts) + len(row)


def radius_above(squared_radius: int, squared_shift: int) -> int:
    """At least the distance of a part from a centre that has moved."""
    def up(n: int) -> int:
        return math.isqrt(n) + (math.isqrt(n) ** 2 < n)
    return up(squared_radius) + up(squared_shift)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def _length(kept: DataFrame, parts: int) -> int:
    """The length of the usable vector with the smallest key; it must be a multiple of ``parts``."""
    first = kept.filter(F.size("_v") > 0).orderBy(F.col("_key").asc_nulls_last(), "_v").select(
        F.size("_v")).first()
    if first is None:
        return 0
    if first[0] % parts:
        raise ValueError(f"vectors of {first[0]} components have no {parts} equal parts")
    return first[0]


def compress(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", carry=("label",),
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             factor: int = FACTOR) -> tuple[DataFrame, np.ndarray]:
    """``key``, the ``carry`` columns, ``codes`` (one byte per part) and ``error``, and the codebooks.

    Vectors that are null or have a component that is no finite number are left out, as are those of
    another length than the usable vector with the smallest key. The others become ``floor(factor * x)``.
    Codebooks start as the parts of the vectors with the smallest keys; a missing key comes last, equal
    keys follow the components. Fewer vectors than ``entries`` give shorter codebooks, none give no rows.
    Repeated rows each count. Columns that are neither named nor carried are not read. Components too
    large for exact 64-bit distances are an error.
    """
    if entries > 256:
        raise ValueError("a code has one byte per part")
    kept = vectors.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)],
                          F.col(embedding).cast("array<double>").alias("_v")).filter(usable(F.col("_v")))
    kinds = [vectors.schema[c].dataType.simpleString() for c in (key, *carry)]
    names = ["_key", *[f"_carry_{i}" for i in range(len(carry))]]
    columns = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    dims = _length(kept, parts)
    kept = kept.filter((F.size("_v") == dims) & (F.size("_v") > 0))
    width = dims // parts

    first = kept.orderBy(F.col("_key").asc_nulls_last(), "_v").limit(entries).select("_v").collect()
    start = integers(pa.array([r[0] for r in first], pa.list_(pa.float64())), dims, factor) if first \
        else np.zeros((0, 0), np.int64)
    books = start.reshape(len(start), parts, -1).transpose(1, 0, 2) if first else np.zeros((parts, 0, 0), np.int64)

    def rows_of(batch: pa.RecordBatch) -> np.ndarray:
        return unpacked(batch.column("v"), dims, "<i4").astype(np.int64).reshape(-1, parts, width)

    def coded(rows: np.ndarray, codes: np.ndarray, all_balls: list[Balls]) -> tuple[np.ndarray, np.ndarray]:
        """New codes, and squared distances by part."""
        found, least = np.empty_like(codes), np.empty(codes.shape, dtype=np.int64)
        for p in range(parts):
            found[:, p], least[:, p], _ = nearest_entries(rows[:, p], codes[:, p].astype(np.int64), all_balls[p])
        return found, least

    def first_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = [balls_of(books[p]) for p in range(parts)]
        for batch in _batches(batches):
            rows = integers(batch.column(len(names)), dims, factor)
            codes = np.zeros((len(rows), parts), dtype=np.uint8)
            found, _ = coded(rows.reshape(-1, parts, width), codes, every)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], packed(rows, "<i4"), packed(found, "u1")],
                names=[*names, "v", "codes"])

    def next_codes(every: list[Balls]):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _batches(batches):
                found, _ = coded(rows_of(batch), unpacked(batch.column("codes"), parts, "u1"), every)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed(found, "u1")],
                                                 names=batch.schema.names)
        return work

    def ball_sums(now: np.ndarray):
        n = now.shape[1]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros((parts, n, width), np.int64), np.zeros((parts, n), np.int64)
            radii = np.zeros((parts, n), np.int64)
            for batch in _batches(batches):
                rows, codes = rows_of(batch), unpacked(batch.column("codes"), parts, "u1").astype(np.int64)
                for p in range(parts):
                    np.add.at(sums[p], codes[:, p], rows[:, p])
                    counts[p] += np.bincount(codes[:, p], minlength=n)
                    np.maximum.at(radii[p], codes[:, p], squared(rows[:, p], now[p][codes[:, p]]))
            part, entry = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part, width), pa.int32()), pa.array(np.repeat(entry, width), pa.int32()),
                 pa.array(np.tile(np.arange(width), len(part)), pa.int32()),
                 pa.array(np.repeat(counts[part, entry], width), pa.int64()),
                 pa.array(np.repeat(radii[part, entry], width), pa.int64()),
                 pa.array(sums[part, entry].ravel(), pa.int64())],
                names=["part", "entry", "place", "rows", "radius", "total"])
        return work

    table_kind = f"{columns}, v binary, codes binary"
    with recorded() as last:
        table = stage(kept.mapInArrow(first_codes, table_kind), "codes")
    for _ in range(rounds if first else 0):
        found = table.select("v", "codes").mapInArrow(
            ball_sums(books), "part int, entry int, place int, rows long, radius long, total long")
        summed = found.groupBy("part", "entry", "place").agg(
            F.sum("rows").alias("rows"), F.max("radius").alias("radius"),
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        new, radii = books.copy(), np.zeros(books.shape[:2], dtype=np.int64)
        for r in summed:
            new[r["part"], r["entry"], r["place"]] = mean_floor(r["total"], r["rows"])
            radii[r["part"], r["entry"]] = r["radius"]
        every = [balls_of(new[p], [radius_above(int(radii[p, e]), int(((new[p, e] - books[p, e]) ** 2).sum()))
                                   for e in range(books.shape[1])]) for p in range(parts)]
        books = new
        with recorded() as written:
            table = stage(table.mapInArrow(next_codes(every), table_kind), "codes")
        drop_folders(table.sparkSession, last)
        last = written

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            rows, codes = rows_of(batch), unpacked(batch.column("codes"), parts, "u1")
            total = sum(squared(rows[:, p], books[p][codes[:, p]]) for p in range(parts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], batch.column("codes"), pa.array(total, pa.int64())],
                names=[*names, "codes", "error"])

    done = table.mapInArrow(errors, f"{columns}, codes binary, error long")
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, (key, *carry), strict=True)],
                       "codes", "error"), books


def decode(codes: bytes, books: np.ndarray, factor: int = FACTOR) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p, c] for p, c in enumerate(codes)]) / factor


def code_table(vectors: DataFrame, key: str = "vec_id", label: str = "label", **settings) -> DataFrame:
    """Codes in hex with ``error``, ``label_error`` (rows without a label together) and the books' digest."""
    found, books = compress(vectors, key, carry=(label,), **settings)
    found = stage(found, "coded")
    listed = ",".join(map(str, books.ravel().tolist())).encode()
    per_label = found.groupBy(F.col(label).alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return found.join(per_label, found[label].eqNullSafe(per_label["_label"])).select(
        key, F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(listed).hexdigest()).alias("codebooks_sha256"))
