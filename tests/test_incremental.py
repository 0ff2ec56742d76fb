import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from demandloom.operators import distinct, weekly
from demandloom.plans import incremental
from demandloom.spec import LAGS, MEASURES, PRODUCT, STORE, WINDOWS

SCHEMA = (f"{STORE} long, {PRODUCT} long, year int, week int, is_weekend int, "
          + ", ".join(f"{m} double" for m in MEASURES))
PAIR = [STORE, PRODUCT]


def sales(seed=1, series=6, weeks=40):
    rng = random.Random(seed)
    rows = []
    for s in range(series):
        for w in range(weeks):
            for _ in range(rng.choice((0, 0, 1, 3))):  # series have gaps
                rows.append((s % 3, s, 2021 + w // 20, w % 20 + 1, rng.randint(0, 1),
                             *[float(rng.randint(-9, 9)) for _ in MEASURES]))
    rows += [(None, 1, 2021, 3, 0, *[1.0] * len(MEASURES)), (1, 1, None, 3, 0, *[1.0] * len(MEASURES))]
    return rows


def full(table):
    made = weekly.create_lag_features(weekly.weekly_rollup(table, digits=6), PAIR, lags=LAGS, order_by=("year", "week"))
    return weekly.create_rolling_features(made, PAIR, windows=WINDOWS, order_by=("year", "week"))


def same(spark, folder, table, rows):
    expected = full(table)
    columns = [F.round(c, 9).alias(c) if c not in (*PAIR, "year", "week") else F.col(c) for c in expected.columns]
    found = incremental.read_features(spark, folder)
    assert rows(found.select(*columns)) == rows(expected.select(*columns))


def files(folder, part):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder, part).rglob("*.parquet")}


@pytest.fixture
def table(spark):
    return spark.createDataFrame(sales(), SCHEMA)


def test_increments_equal_the_whole_run(spark, tmp_path, table, rows):
    folder, weeks = str(tmp_path), incremental.weeks_of(table)
    assert weeks == sorted(set(weeks)) and len(weeks) > 30
    for start in range(0, len(weeks), 7):
        incremental.update_weeks(table, folder, weeks[start:start + 7], digits=6)
    same(spark, folder, table, rows)


def test_old_weeks_are_neither_read_nor_written(spark, tmp_path, table, rows):
    folder, weeks = str(tmp_path), incremental.weeks_of(table)
    incremental.update_weeks(table, folder, weeks[:30], digits=6)
    before = {part: files(folder, part) for part in ("weekly", "features")}
    # Old weekly rows could not be read any more.
    for path in before["weekly"]:
        Path(path).write_bytes(b"PAR1 spoilt")
    spoilt = files(folder, "weekly")
    incremental.update_weeks(table, folder, weeks[30:], digits=6)
    assert {k: v for k, v in files(folder, "features").items() if k in before["features"]} == before["features"]
    assert {k: v for k, v in files(folder, "weekly").items() if k in spoilt} == spoilt
    same(spark, folder, table, rows)


def test_only_the_weeks_of_a_run_are_scanned(spark, tmp_path, table):
    folder = f"{tmp_path}/sales"
    table.filter("year is not null").write.partitionBy("year", "week").parquet(folder)
    picked = spark.read.parquet(folder).filter(incremental.week_code().isin([202103, 202104]))
    plan = picked._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: []" not in plan.toString()
    picked._jdf.queryExecution().toRdd().count()
    assert plan.collectLeaves().apply(0).metrics().apply("numPartitions").value() == 2


def test_late_and_repeated_weeks(spark, tmp_path, table, rows):
    folder, weeks = str(tmp_path), incremental.weeks_of(table)
    late = weeks[9:12]
    incremental.update_weeks(table, folder, weeks[:9], digits=6)
    incremental.update_weeks(table, folder, weeks[12:20], digits=6)
    incremental.update_weeks(table, folder, weeks[20:], digits=6)
    assert incremental.carries(spark, folder) == [weeks[8], weeks[19], weeks[-1]]
    incremental.update_weeks(table, folder, late, digits=6)
    assert incremental.carries(spark, folder) == [weeks[8], weeks[-1]]
    same(spark, folder, table, rows)
    for again in (weeks[-3:], late, [], weeks[:1]):
        incremental.update_weeks(table, folder, again, digits=6)
        same(spark, folder, table, rows)


def test_empty_sales(spark, tmp_path, table):
    assert incremental.weeks_of(table.limit(0)) == []
    incremental.update_weeks(table.limit(0), str(tmp_path), [])
    assert not (tmp_path / "weekly").exists()


def test_sketches_of_weeks_merge(spark):
    rows = [(2020 + i % 3, i % 50, i * 7919 % 40_000, f"p{i % 300}") for i in range(60_000)] + [(2020, 1, None, None)]
    df = spark.createDataFrame(rows, "year int, week int, buyer long, product string")
    sketches = distinct.distinct_sketches(df, ["buyer", "product"])
    assert sketches.count() == 150
    for where in (None, F.col("year") == 2021, (F.col("year") == 2020) & (F.col("week") < 9)):
        exact = (df if where is None else df.filter(where)).agg(
            F.count_distinct("buyer").alias("buyer"), F.count_distinct("product").alias("product")).first()
        found = distinct.estimated_distinct(sketches, ["buyer", "product"], where=where).first()
        assert all(abs(found[c] - exact[c]) <= 0.03 * exact[c] for c in ("buyer", "product"))
    nothing = distinct.estimated_distinct(sketches, ["buyer"], where=F.lit(False)).collect()
    assert [r["buyer"] for r in nothing] == [0]
    missing = distinct.distinct_sketches(df.filter("buyer is null"), ["buyer"])
    assert distinct.estimated_distinct(missing, ["buyer"], groupby=["year"]).collect() == [(2020, 0)]
