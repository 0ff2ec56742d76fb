import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from demandloom.operators import horizon, weekly
from demandloom.sources import series_store as store
from demandloom.spec import LAGS, PRODUCT, STORE, WINDOWS

PAIR, ORDER = [STORE, PRODUCT], ("year", "week")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rows_by_week(spark):
    rng = random.Random(3)
    data = [(s % 5, s, y, w, float(rng.randint(0, 40)), f"x{s}")
            for s in range(30) for y in (2020, 2021, 2022) for w in range(1, 20) if rng.random() < 0.7]
    # A pair without a store, and columns whose names need quotes.
    data += [(None, 1, 2021, w, 1.0, None) for w in (3, 4)]
    return spark.createDataFrame(data, f"{STORE} long, {PRODUCT} long, year int, week int, quantity double, `a b` string")


def features(df):
    made = weekly.create_lag_features(df, PAIR, lags=LAGS, order_by=ORDER)
    return weekly.create_rolling_features(made, PAIR, windows=WINDOWS, order_by=ORDER)


def test_windows_on_a_store_move_no_row(spark, tmp_path, rows_by_week, rows):
    kept = store.write_store(rows_by_week, f"{tmp_path}/it's", buckets=5)
    assert kept.columns == rows_by_week.columns and kept.dtypes == rows_by_week.dtypes
    made = features(kept)
    assert "Exchange" not in plan(made) and "Exchange" in plan(features(rows_by_week))
    assert rows(made.withColumnRenamed("a b", "a")) == rows(features(rows_by_week).withColumnRenamed("a b", "a"))
    assert "Exchange" not in plan(weekly.last_observation(kept)) + plan(weekly.distinct_series(kept))


def test_horizon_of_a_store_moves_no_row(spark, tmp_path, rows_by_week, rows):
    folder = f"{tmp_path}/features"
    plain = features(rows_by_week.drop("a b"))
    kept = store.write_store(plain, folder, buckets=4)
    assert store.newest_week(spark, folder) == plain.agg(F.max(F.col("year") * 100 + F.col("week"))).first()[0]
    made = horizon.generate_forecast_features(kept, newest=store.newest_week(spark, folder))
    assert "Exchange" not in plan(made)
    assert rows(made) == rows(horizon.generate_forecast_features(plain))


def test_stores_cut_alike_join_without_exchange(spark, tmp_path, rows_by_week):
    left = store.write_store(rows_by_week.drop("a b"), f"{tmp_path}/left", buckets=4)
    right = store.write_store(rows_by_week.select(*PAIR, "year", "week", F.col("quantity").alias("planned")),
                              f"{tmp_path}/right", buckets=4)
    latest = weekly.last_observation(right).select(*PAIR, "planned")
    joined = left.hint("merge").join(latest, PAIR)
    assert "Exchange" not in plan(joined)
    assert joined.count() == left.filter(F.col(STORE).isNotNull()).count()


def test_only_replaced_years_are_written(spark, tmp_path, rows_by_week, rows):
    folder = f"{tmp_path}/s"
    store.write_store(rows_by_week, folder, buckets=3)

    def files():
        return {p: p.stat().st_mtime_ns for p in Path(folder, "data").rglob("*.parquet")}

    before = files()
    assert len(before) <= 3 * 3  # one file per year and bucket
    new = rows_by_week.filter("year = 2021").withColumn("quantity", F.lit(-1.0)).unionByName(
        rows_by_week.limit(1).withColumn("year", F.lit(2024)))
    store.replace_years(new, folder)
    after = files()
    assert {p: t for p, t in before.items() if "year=2021" not in str(p)}.items() <= after.items()
    expected = rows_by_week.filter("year <> 2021").unionByName(new)
    assert rows(store.open_store(spark, folder)) == rows(expected)
    assert store.newest_week(spark, folder) == 202400 + new.filter("year = 2024").first()["week"]
    # A session that has not seen the store, and one whose catalog is behind.
    other = spark.newSession()
    assert rows(store.open_store(other, folder)) == rows(expected)


def test_years_are_pruned(spark, tmp_path, rows_by_week):
    kept = store.write_store(rows_by_week, f"{tmp_path}/s", buckets=3).filter("year = 2022")
    kept.collect()
    leaf = kept._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().apply("numPartitions").value() == 1


def test_a_store_without_rows(spark, tmp_path, rows_by_week):
    folder = f"{tmp_path}/s"
    kept = store.write_store(rows_by_week.limit(0), folder)
    assert kept.count() == 0 and store.newest_week(spark, folder) is None
    store.replace_years(rows_by_week, folder)
    assert store.open_store(spark, folder).count() == rows_by_week.count()
    with pytest.raises(Exception, match="already exists"):
        store.write_store(rows_by_week, folder)
    with pytest.raises(ValueError):
        store.write_store(rows_by_week.drop("year"), f"{tmp_path}/t")


def test_rows_without_a_year_have_a_partition(spark, tmp_path, rows_by_week, rows):
    folder = f"{tmp_path}/s"
    nulls = rows_by_week.limit(3).withColumn("year", F.lit(None).cast("int"))
    kept = store.write_store(rows_by_week.unionByName(nulls), folder, buckets=2)
    assert rows(kept) == rows(rows_by_week.unionByName(nulls))
    assert store.newest_week(spark, folder) // 100 == 2022


def test_a_dropped_store_leaves_nothing(spark, tmp_path, rows_by_week):
    before = {t.name for t in spark.catalog.listTables()}
    for buckets in (2, 3):  # the folder can be used again, in another layout
        assert store.write_store(rows_by_week, f"{tmp_path}/s", buckets=buckets).count() == rows_by_week.count()
        store.drop_store(spark, f"{tmp_path}/s")
        assert not (tmp_path / "s").exists() and {t.name for t in spark.catalog.listTables()} == before


def test_buckets_follow_the_rows():
    assert [store.bucket_count(n, 8, 100) for n in (0, 100, 801, 100_000)] == [8, 8, 9, 1000]
