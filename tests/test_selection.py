import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import selection, splits
from demandloom.spec import PRODUCT, STORE, SeriesSpec

WEEK = f"{STORE} long, {PRODUCT} string, year int, week int, at timestamp_ntz, quantity double"
ORDER = ["year", "week", STORE, PRODUCT]


def weeks(n, seed=1, hot=0):
    """Rows with gaps in every ordering column; ``hot`` copies of one of them."""
    rng = np.random.default_rng(seed)
    rows = [(None if i % 41 == 0 else int(rng.integers(0, 20)), None if i % 37 == 0 else f"p{rng.integers(0, 9)}",
             None if i % 53 == 0 else int(rng.integers(2000, 2003)), int(rng.integers(1, 53)),
             datetime.datetime(2022, 1, 1) + datetime.timedelta(seconds=int(rng.integers(0, 10 ** 6))), float(i))
            for i in range(n)]
    return rows + [(5, "p5", 2001, 7, datetime.datetime(2022, 1, 5, 1, 2, 3, 4), float(n + i)) for i in range(hot)]



def place(row):
    return tuple((v is None, v if v is not None else "") for v in (row[2], row[3], row[0], row[1]))


@pytest.mark.parametrize("sample,ordered_rows", [(4096, 100_000), (30, 50), (4, 1)])
@pytest.mark.parametrize("hot", [0, 3000])
def test_cuts_are_those_of_a_sort(spark, sample, ordered_rows, hot):
    rows = weeks(2000, hot=hot)
    total = len(rows)
    ranks = [0, 1, total // 6, total // 2, total // 2 + 1, total - 1, total]
    cuts = selection.find_cuts(spark.createDataFrame(rows, WEEK), ORDER, ranks, None, sample, ordered_rows)
    ordered = sorted(rows, key=place)
    for rank, cut in zip(ranks, cuts, strict=True):
        if rank in (0, total):
            assert cut.key is None
            continue
        last = ordered[rank - 1]
        assert cut.key.values == (last[2], last[3], last[0], last[1])
        equal = [i for i, r in enumerate(ordered) if place(r) == place(last)]
        assert (cut.taken, cut.tied) == (rank - equal[0], len(equal))


@pytest.mark.parametrize("columns", [["at"], ["quantity"], ["at", "quantity"]])
def test_times_and_doubles_come_back_as_they_were(spark, columns):
    rows = [*weeks(500), (1, "x", 2000, 1, None, float("nan")), (1, "x", 2000, 1, None, float("inf")),
            (1, "x", 2000, 1, None, None), (1, "x", 2000, 1, None, -1 / 3)]
    df = spark.createDataFrame(rows, WEEK)
    for rank in (1, 2, 250, len(rows) - 3, len(rows) - 1):
        cuts = selection.find_cuts(df, columns, [rank], None, 40, 60)
        labelled = selection.count_cuts(df, cuts, columns, "passed")
        counts = {r["passed"]: r["count"] for r in labelled.groupBy("passed").count().collect()}
        assert counts == {0: rank, 1: len(rows) - rank}
        first = labelled.filter("passed = 0").orderBy(*[F.col(c).desc_nulls_first() for c in columns]).first()
        after = labelled.filter("passed = 1").orderBy(*[F.col(c).asc_nulls_last() for c in columns]).first()
        both = spark.createDataFrame([first, after], labelled.schema).orderBy(
            *[F.col(c).asc_nulls_last() for c in columns], "passed").collect()
        assert [r["passed"] for r in both] == [0, 1]


@pytest.mark.parametrize("hot", [0, 3000])
def test_labels_equal_numbers(spark, hot):
    df = spark.createDataFrame(weeks(2000, hot=hot), WEEK)
    total, grain = df.count(), [*ORDER]
    for size in (0.2, 0.5, 0.0, 1.0):
        found, numbered = (splits.time_split(df, size, numbered=n).groupBy(*grain, "split").count()
                           for n in (False, True))
        assert sorted(map(repr, found.collect())) == sorted(map(repr, numbered.collect()))
        train = found.filter("split = 'train'").agg(F.sum("count")).first()[0] or 0
        assert train == math.floor((1 - size) * total)
    found, numbered = (splits.time_folds(df, 5, numbered=n).groupBy(*grain, "fold", "part").count()
                       for n in (False, True))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, numbered.collect()))


def test_labels_move_and_write_nothing(spark, tmp_path):
    rows = {(r[0] or 0, r[1] or "", r[2] or 0, r[3]): r for r in weeks(3000)}
    spark.createDataFrame([(k[0], k[1], k[2], k[3], 1.0) for k in rows],
                          f"{STORE} long, {PRODUCT} string, year int, week int, quantity double").write.parquet(
        str(tmp_path / "weekly"))
    stored = spark.read.parquet(str(tmp_path / "weekly"))
    for made in (splits.time_split(stored), splits.time_folds(stored)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
        assert str(tmp_path) in " ".join(made.inputFiles()) and len(made.inputFiles()) == len(stored.inputFiles())
    test = splits.time_split(stored).filter("split = 'test'")
    assert test.count() == len(rows) - math.floor(0.8 * len(rows))


def test_few_and_no_rows(spark):
    df = spark.createDataFrame(weeks(3), WEEK)
    assert sorted(r["split"] for r in splits.time_split(df, 0.4).collect()) == ["test", "test", "train"]
    assert splits.time_split(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="more than 5 rows"):
        splits.time_folds(spark.createDataFrame(weeks(5), WEEK), 5)
    with pytest.raises(ValueError, match="two folds"):
        splits.time_folds(df, 1)
    with pytest.raises(ValueError, match="at least one column"):
        selection.find_cuts(df, [], [1])


def test_a_cut_inside_ties_numbers_only_these(spark):
    df = spark.range(1000).selectExpr("id", "int(id / 300) as day")
    made = splits.time_split(df, 0.5, SeriesSpec((), ("day",)))
    counts = {(r["day"], r["split"]): r["count"] for r in made.groupBy("day", "split").count().collect()}
    assert counts == {(0, "train"): 300, (1, "train"): 200, (1, "test"): 100, (2, "test"): 300, (3, "test"): 100}
