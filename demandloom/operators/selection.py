"""Cuts in a total order without sorting or numbering the rows.

A split after the first ``r`` rows needs one row only: the last one before the cut. It is found by
narrowing a bracket around its rank. Each step samples a few keys inside the bracket, counts rows below and
up to two of them exactly, and goes on with the stretch that holds the rank; the sample decides how fast a
bracket shrinks, never where the cut is. All cuts are narrowed by the same jobs, which read the ordering
columns only. A cut is then a comparison with literals that reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordinal import ORDINAL, in_order, with_ordinal

# Keys sampled from a bracket in one step, and the rows of a bracket that one task may order.
SAMPLE, ORDERED_ROWS = 4096, 100_000
# Rows of the sample that a bracket reaches beyond the expected place of its rank.
REACH = 200


@dataclass(frozen=True)
class Key:
    """The ordering columns' values of one row, as literals."""

    values: tuple
    kinds: tuple[str, ...]
    columns: tuple[str, ...]

    def _literal(self, i: int) -> Column:
        return F.lit(self.values[i]).cast(self.kinds[i])

    def holds(self) -> Column:
        return reduce(lambda a, b: a & b, [
            F.col(c).eqNullSafe(self._literal(i)) for i, c in enumerate(self.columns)])

    def place(self) -> Column:
        """This key as one value that compares with ``place_of`` the ordering columns."""
        return F.struct(*[x for i in range(len(self.columns)) for x in (
            F.lit(self.values[i] is None), self._literal(i))])

    def before(self, or_equal: bool) -> Column:
        """Whether a row comes before this key; missing values come last. Never null."""
        found = F.lit(or_equal)
        for i in reversed(range(len(self.columns))):
            column = F.col(self.columns[i])
            if self.values[i] is None:
                less = column.isNotNull()
            else:
                less = column.isNotNull() & (column < self._literal(i))
            found = less | (column.eqNullSafe(self._literal(i)) & found)
        return found


@dataclass(frozen=True)
class Cut:
    """A cut after the first ``rank`` rows: rows before ``key``, and ``taken`` of the ``tied`` rows equal to it.

    Without a key all rows lie on one side: before the cut if ``rank`` is positive.
    """

    rank: int
    key: Key | None = None
    taken: int = 0
    tied: int = 0

    @property
    def inside_ties(self) -> bool:
        return self.key is not None and self.taken < self.tied

    def behind(self) -> Column:
        """Whether a row comes after the cut, for rows that are not tied with it."""
        if self.key is None:
            return F.lit(self.rank <= 0)
        return ~self.key.before(or_equal=True)


@dataclass
class _Bracket:
    """Rows between ``low`` and ``high`` (both optional, neither included); ``below`` rows come before."""

    rank: int
    below: int
    inside: int
    low: Key | None = None
    high: Key | None = None
    found: Cut | None = None

    def holds(self) -> Column:
        after = ~self.low.before(or_equal=True) if self.low else F.lit(True)
        return after & self.high.before(or_equal=False) if self.high else after


def find_cuts(df: DataFrame, order_by: Sequence[str], ranks: Sequence[int], total: int | None = None,
              sample: int = SAMPLE, ordered_rows: int = ORDERED_ROWS) -> list[Cut]:
    """One cut per rank, in the order of ``order_by`` with missing values last.

    A rank is the number of rows before the cut; ranks of 0 or of all rows need no key. ``df`` is read a few
    times, so it should be a stored table; only the ordering columns of it are read.
    """
    if not order_by:
        raise ValueError("give at least one column to order by")
    keys = df.select(*order_by)
    total = keys.count() if total is None else total
    brackets = [_Bracket(r, 0, total) for r in ranks]
    open_ = [b for b in brackets if 0 < b.rank < total]
    large = [b for b in open_ if b.inside > ordered_rows]
    step = 0
    while large:
        _narrow(keys, order_by, large, sample, step)
        large = [b for b in large if b.found is None and b.inside > ordered_rows]
        step += 1
    _finish(keys, order_by, [b for b in open_ if b.found is None])
    return [b.found or Cut(b.rank if b.rank < total else total) for b in brackets]


def _kinds(keys: DataFrame) -> tuple[str, ...]:
    return tuple(f.dataType.simpleString() for f in keys.schema.fields)


def _plain(keys: DataFrame) -> list[Column]:
    """Ordering columns in a form that comes back from the driver as the same literal."""
    return [F.col(f.name).cast("string").alias(f"_v{i}")
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name).alias(f"_v{i}")
            for i, f in enumerate(keys.schema.fields)]


def place_of(columns: Sequence[str]) -> Column:
    """The ordering columns as one comparable value; missing values come last."""
    return F.struct(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def _drawn(keys: DataFrame, order_by: Sequence[str], brackets: list[_Bracket], sample: int,
           step: int) -> dict[tuple, list[Key]]:
    """About ``sample`` keys of every different bracket, in order."""
    different = list({(b.low, b.high): b for b in brackets}.values())
    picked = F.array_compact(F.array(*[
        F.when(b.holds() & (F.rand(1000 * step + i) < F.lit(min(1.0, sample / b.inside))), F.lit(i))
        for i, b in enumerate(different)]))
    kinds, names = _kinds(keys), tuple(order_by)
    found: dict[tuple, list[Key]] = {}
    for row in (keys.withColumn("_bracket", F.explode(picked)).orderBy("_bracket", *in_order(names))
                .select("_bracket", *_plain(keys)).collect()):
        b = different[row["_bracket"]]
        found.setdefault((b.low, b.high), []).append(Key(tuple(row)[1:], kinds, names))
    return found


def _narrow(keys: DataFrame, order_by: Sequence[str], brackets: list[_Bracket], sample: int, step: int) -> None:
    """One step: two sampled keys per bracket, and exact counts around them."""
    drawn = _drawn(keys, order_by, brackets, sample, step)
    bounds = {}
    for i, b in enumerate(brackets):
        found = drawn.get((b.low, b.high))
        if found:
            at = int((b.rank - b.below) * len(found) / b.inside)
            reach = max(1, REACH * len(found) // SAMPLE)
            bounds[i] = found[max(at - reach, 0)], found[min(at + reach, len(found) - 1)]
    if not bounds:
        return
    held = reduce(or_, [brackets[i].holds() for i in bounds])
    counts = []
    for i, (low, high) in bounds.items():
        inside = F.col("_place") > brackets[i].low.place() if brackets[i].low else F.lit(True)
        inside = inside & (F.col("_place") < brackets[i].high.place()) if brackets[i].high else inside
        counts += [F.count_if(inside & condition).alias(f"{name}{i}") for name, condition in (
            ("a", F.col("_place") < low.place()), ("b", F.col("_place") <= low.place()),
            ("c", F.col("_place") < high.place()), ("d", F.col("_place") <= high.place()))]
    row = keys.filter(held).select(place_of(order_by).alias("_place")).agg(*counts).first()
    for i, (low, high) in bounds.items():
        _go_on(brackets[i], low, high, *(brackets[i].below + row[f"{c}{i}"] for c in "abcd"))


def _go_on(b: _Bracket, low: Key, high: Key, before_low: int, to_low: int, before_high: int, to_high: int) -> None:
    """Keep the stretch that holds the rank, or settle the cut if it is one of the two keys."""
    end = b.below + b.inside
    for key, before, through in ((low, before_low, to_low), (high, before_high, to_high)):
        if before < b.rank <= through:
            b.found = Cut(b.rank, key, b.rank - before, through - before)
            return
    if b.rank <= before_low:
        b.high, b.inside = low, before_low - b.below
    elif b.rank <= before_high:
        b.low, b.high, b.below, b.inside = low, high, to_low, before_high - to_low
    else:
        b.low, b.below, b.inside = high, to_high, end - to_high


def _finish(keys: DataFrame, order_by: Sequence[str], brackets: list[_Bracket]) -> None:
    """Order the few keys that are left in each bracket and pick the one at its rank."""
    if not brackets:
        return
    names, kinds = tuple(order_by), _kinds(keys)
    held = F.array_compact(F.array(*[F.when(b.holds(), F.lit(i)) for i, b in enumerate(brackets)]))
    counted = (keys.withColumn("_bracket", F.explode(held))
               .groupBy("_bracket", *names).agg(F.count("*").alias("_tied")))
    in_bracket = W.partitionBy("_bracket").orderBy(*in_order(names))
    through = counted.withColumn("_through", F.sum("_tied").over(in_bracket))
    wanted = reduce(or_, [(F.col("_bracket") == i) & (F.col("_through") >= b.rank - b.below)
                          & (F.col("_through") - F.col("_tied") < b.rank - b.below)
                          for i, b in enumerate(brackets)])
    for row in through.filter(wanted).select("_bracket", "_tied", "_through", *_plain(keys)).collect():
        b = brackets[row["_bracket"]]
        before = b.below + row["_through"] - row["_tied"]
        b.found = Cut(b.rank, Key(tuple(row)[3:], kinds, names), b.rank - before, row["_tied"])


def count_cuts(df: DataFrame, cuts: Sequence[Cut], order_by: Sequence[str], name: str) -> DataFrame:
    """Add the number of ``cuts`` that a row comes after.

    Rows that are tied with a cut are told apart by a number of their own; only those rows are numbered.
    """
    def passed(cut: Cut) -> Column:
        return cut.behind().cast("int")

    split = {c.key: None for c in cuts if c.inside_ties}
    whole = reduce(lambda a, b: a + b, [passed(c) for c in cuts], F.lit(0))
    if not split:
        return df.withColumn(name, whole)
    made = df.filter(~reduce(or_, [k.holds() for k in split])).withColumn(name, whole)
    for key in split:
        tied = with_ordinal(df.filter(key.holds()), list(order_by), total="_tied")
        count = reduce(lambda a, b: a + b, [
            (F.col(ORDINAL) > c.taken).cast("int") if c.key == key else passed(c) for c in cuts], F.lit(0))
        made = made.unionByName(tied.withColumn(name, count).drop(ORDINAL, "_tied"))
    return made

