"""Exact interpolated quantiles without gathering a column in one task.

``percentile`` and ``median`` keep every distinct value of a column in the memory of the final task.
Here a mergeable sketch first brackets each wanted rank, and only the few values inside the bracket
are counted and ordered. The sketch decides how much is ordered, never the answer: the ranks below the
bracket are counted exactly, and a bracket that misses its rank is widened.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import finite

INFINITY = float("inf")
SKETCH_ACCURACY = 10_000
FINEST_SKETCH = 1_000_000
# Size of a stored sketch: off by about 0.07 % of the rows, up to 200 KB each.
SKETCH_K = 8192
# The most distinct values that one task may order.
ORDERED_VALUES = 1_000_000


@dataclass
class _Target:
    column: str
    probability: float
    count: int = 0
    low: float = -INFINITY
    high: float = INFINITY
    inside: int = 0  # upper bound on the rows strictly inside the bracket

    @property
    def position(self) -> float:
        return (self.count - 1) * self.probability

    @property
    def ranks(self) -> tuple[int, int]:
        """Zero-based ranks of the two values to interpolate between."""
        first = min(int(self.position), self.count - 1)
        return first, first if first == self.position else min(first + 1, self.count - 1)

    def contains(self, value: Column) -> Column:
        return (value >= F.lit(self.low)) & (value <= F.lit(self.high))

    def forget_bracket(self) -> None:
        self.low, self.high, self.inside = -INFINITY, INFINITY, self.count

    def interpolate(self, first: float, second: float) -> float:
        fraction = self.position - self.ranks[0]
        if fraction == 0.5:
            return (first + second) / 2
        return first + (second - first) * fraction


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]],
                    accuracy: int = SKETCH_ACCURACY,
                    ordered_values: int = ORDERED_VALUES) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns, missing values ignored.

    Runs two aggregation jobs over the wanted columns, however many they are, for up to about 10^9 rows
    and two more for every further factor of some thousand. A column without values yields ``None``.
    """
    targets = [_Target(c, p) for c, probabilities in wanted.items() for p in probabilities]
    values = df.select(*[finite(F.col(c).cast("double")).alias(c) for c in wanted])

    _bracket_all(values, targets, accuracy)
    return _exact(values, targets, accuracy, ordered_values)


def quantile_sketches(df: DataFrame, columns, groupby=("year", "week"), k: int = SKETCH_K) -> DataFrame:
    """One KLL sketch per group and column, under the column's name; missing values are not counted.

    A sketch holds about three times ``k`` values however many it has seen. Kept per week, sketches are
    replaced with their week and merged for any range of weeks.
    """
    return df.groupBy(*groupby).agg(*[
        F.kll_sketch_agg_double(finite(F.col(c).cast("double")), k).alias(c) for c in columns])


def quantiles_from_sketches(df: DataFrame, sketches: DataFrame, wanted: dict[str, list[float]],
                            where: Column | None = None, k: int = SKETCH_K,
                            ordered_values: int = ORDERED_VALUES) -> dict[str, list[float | None]]:
    """The same numbers as ``exact_quantiles(df.filter(where), wanted)``, with one scan of ``df``.

    ``sketches`` are those of ``df`` by the columns that ``where`` speaks about, made with ``k`` values or more.
    Merged, they bracket the ranks; the scan counts what lies below and orders what lies inside. Sketches
    that count other rows than ``df`` has are an error, as long as they count any. Above some
    10^8 rows a bracket is first narrowed, with two more scans.
    """
    targets = [_Target(c, p) for c, probabilities in wanted.items() for p in probabilities]
    if where is not None:
        df, sketches = df.filter(where), sketches.filter(where)
    values = df.select(*[finite(F.col(c).cast("double")).alias(c) for c in wanted])
    accuracy = 1 / rank_error(k)
    slack = 3.0 / accuracy
    known = [F.col(c).isNotNull() & (F.kll_sketch_get_n_double(c) > 0) for c in wanted]
    merged = sketches.agg(*[F.kll_merge_agg_double(F.when(has, F.col(c))).alias(c)
                            for c, has in zip(wanted, known, strict=True)])
    expressions = []
    for c, probabilities in wanted.items():
        edges = [min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-slack, slack)]
        some = F.kll_sketch_get_n_double(c) > 0
        expressions += [F.coalesce(F.kll_sketch_get_n_double(c), F.lit(0)).alias(f"n_{c}"), F.when(
            some, F.kll_sketch_get_quantile_double(c, F.array(*map(F.lit, edges)))).alias(f"b_{c}")]
    row = merged.select(*expressions).first()
    for c in wanted:
        edges = iter(row[f"b_{c}"] or [])
        for t in (t for t in targets if t.column == c and row[f"n_{c}"]):
            t.count, t.low, t.high = row[f"n_{c}"], next(edges), next(edges)
            t.inside = int(t.count * 4.0 * slack) + 2
    return _exact(values, targets, SKETCH_ACCURACY, ordered_values)


def rank_error(k: int) -> float:
    """The share of rows by which a rank in a KLL sketch of ``k`` is off, in 99 of 100 cases."""
    return 2.3 / k ** 0.9


def _exact(values: DataFrame, targets: list[_Target], accuracy: int,
           ordered_values: int) -> dict[str, list[float | None]]:
    """Quantiles from bracketed targets."""
    found: dict[int, tuple[float, float]] = {}
    pending = {i: t for i, t in enumerate(targets) if t.count}
    while pending:
        _narrow(values, [t for t in pending.values() if t.inside > ordered_values],
                accuracy, ordered_values)
        selected = _select(values, pending)
        for i in list(pending):
            if i in selected:
                found[i] = selected[i]
                del pending[i]
            else:  # the sketch was off: start again from the whole column with a finer one
                pending[i].forget_bracket()
        accuracy *= 4

    answers: dict[str, list[float | None]] = {c: [] for c in values.columns}
    for i, target in enumerate(targets):
        answers[target.column].append(target.interpolate(*found[i]) if i in found else None)
    return answers


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, {c: [0.5] for c in columns}).items()}


def approximate_quantiles(df: DataFrame, wanted: dict[str, list[float]],
                          accuracy: int = SKETCH_ACCURACY) -> dict[str, list[float | None]]:
    """One pass, with a rank error of at most ``rows / accuracy`` and no interpolation."""
    row = df.agg(*[
        F.approx_percentile(finite(F.col(c).cast("double")), p, accuracy).alias(c)
        for c, p in wanted.items()
    ]).first()
    return {c: list(row[c]) if row[c] else [None] * len(p) for c, p in wanted.items()}


def _fractions(first: int, last: int, count: int, accuracy: int) -> list[float]:
    """Sketch probabilities that bracket the ranks ``first..last`` of ``count`` values."""
    slack = 3.0 / accuracy
    return [max(first / count - slack, 0.0), min((last + 1) / count + slack, 1.0)]


def _bracket_all(values: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """First brackets, from one sketch per column."""
    slack = 3.0 / accuracy
    bounds: dict[str, list[float]] = {c: [] for c in values.columns}
    for t in targets:
        bounds[t.column] += [max(t.probability - slack, 0.0), min(t.probability + slack, 1.0)]
    row = values.agg(*[e for c, b in bounds.items() for e in (
        F.count(c).alias(f"n_{c}"), F.approx_percentile(c, b, accuracy).alias(f"b_{c}"))]).first()
    for c in bounds:
        found = iter(row[f"b_{c}"] or [])
        for t in (t for t in targets if t.column == c):
            t.count = row[f"n_{c}"]
            if t.count:
                t.low, t.high = next(found), next(found)
                t.inside = int(t.count * 8.0 / accuracy) + 2


def _narrow(values: DataFrame, targets: list[_Target], accuracy: int, ordered_values: int) -> None:
    """Shrink the brackets that still hold too many rows, with a finer sketch each time."""
    while targets:
        accuracy = min(accuracy * 4, FINEST_SKETCH)
        expressions = []
        for i, t in enumerate(targets):
            value = F.col(t.column)
            expressions += [F.count_if(value < F.lit(t.low)).alias(f"below{i}"),
                            F.count_if(t.contains(value)).alias(f"inside{i}")]
        counts = values.agg(*expressions).first()
        sketches = []
        for i, t in enumerate(targets):
            below, inside = counts[f"below{i}"], counts[f"inside{i}"]
            first, last = (r - below for r in t.ranks)
            if first < 0 or last >= inside:  # missed: the next sketch covers the whole column
                t.forget_bracket()
                first, last, inside = *t.ranks, t.count
            t.inside = int(inside * 8.0 / accuracy) + 2
            value = F.col(t.column)
            sketches.append(F.approx_percentile(
                F.when(t.contains(value), value), _fractions(first, last, inside, accuracy),
                accuracy).alias(f"b{i}"))
        bounds = values.agg(*sketches).first()
        for i, t in enumerate(targets):
            t.low, t.high = bounds[f"b{i}"]
        targets = [t for t in targets if t.inside > ordered_values and t.low < t.high]


def _select(values: DataFrame, targets: dict[int, _Target]) -> dict[int, tuple[float, float]]:
    """The values at the wanted ranks, for every target whose bracket holds them, in one pass."""
    columns = sorted({t.column for t in targets.values()})
    picked = {c: [t for t in targets.values() if t.column == c] for c in columns}
    entries = F.array(*[F.struct(
        F.lit(c).alias("column"), _region(F.col(c), ts).alias("region"), F.col(c).alias("value"))
        for c, ts in picked.items()])
    counted = (
        values.select(F.explode(entries).alias("entry")).select("entry.*").filter("value is not null")
        .select("column", "region", F.when(F.col("region") % 2 == 1, F.col("value")).alias("value"))
        .groupBy("column", "region", "value").agg(F.count("*").alias("rows")))
    through = F.sum("rows").over(W.partitionBy("column").orderBy("region", "value"))
    total = F.sum("rows").over(W.partitionBy("column"))
    ranked = counted.withColumns({"through": through, "total": total})
    covers = reduce(lambda a, b: a | b, [
        (F.col("column") == c) & (F.col("through") > rank) & (F.col("through") - F.col("rows") <= rank)
        for c, ts in picked.items() for rank in sorted({r for t in ts for r in t.ranks})])
    rows = ranked.filter(covers).collect()  # at most two rows per target
    found = {}
    for i, t in targets.items():
        mine = [r for r in rows if r["column"] == t.column]
        if not mine or mine[0]["total"] != t.count:
            raise ValueError(f"{t.column} has other rows than were counted before")
        at = [next(r["value"] for r in mine if r["through"] - r["rows"] <= rank < r["through"])
              for rank in t.ranks]
        if None not in at:
            found[i] = (at[0], at[1])
    return found


def _region(value: Column, targets: list[_Target]) -> Column:
    """The number of the region that a value of this column falls in.

    The brackets cut the number line into regions; odd ones are brackets. Inside a bracket every distinct
    value is counted, and all rows of the region between two brackets share one null value, so the counts
    in order are exact ranks and yet few. A rank that falls outside the brackets comes back as null.
    """
    brackets: list[list[float]] = []
    for low, high in sorted((t.low, t.high) for t in targets):
        if brackets and low <= brackets[-1][1]:
            brackets[-1][1] = max(high, brackets[-1][1])
        else:
            brackets.append([low, high])
    region = None
    for i, (low, high) in enumerate(brackets):
        region = (F if region is None else region).when(value < F.lit(low), 2 * i)
        region = region.when(value <= F.lit(high), 2 * i + 1)
    return region.otherwise(2 * len(brackets))
