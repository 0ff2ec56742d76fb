import datetime as dt

import numpy as np
import pytest

from demandloom.operators import blocks
from demandloom.operators.decompose import decompose_time_series


def by_definition(x, period, additive):
    n, half = len(x), period // 2
    weights = np.ones(period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5]
    trend = np.full(n, np.nan)
    for i in range(half, n - half):
        trend[i] = (x[i - half:i + half + 1] * weights).sum() / period
    detrended = x - trend if additive else x / trend
    index = np.array([np.nanmean(detrended[p::period]) for p in range(period)])
    index = index - index.mean() if additive else index / index.mean()
    seasonal = np.resize(index, n)
    resid = x - trend - seasonal if additive else x / (trend * seasonal)
    return trend, seasonal, resid


def frame(spark, values, key="a", schema="k string, transaction_date date, quantity double"):
    start = dt.date(2022, 1, 1)
    rows = []
    for i, v in enumerate(values):
        # Two rows per date, dates with gaps.
        day = start + dt.timedelta(days=2 * i)
        rows += [(key, day, float(v) - 1), (key, day, 1.0)]
    return spark.createDataFrame(rows, schema)


def check(made, values, period, additive):
    made = made.orderBy("transaction_date").toPandas()
    trend, seasonal, resid = by_definition(np.asarray(values, float), period, additive)
    assert np.allclose(made["observed"], values)
    for name, expected in (("trend", trend), ("seasonal", seasonal), ("resid", resid)):
        assert np.allclose(made[name], expected, equal_nan=True), name


@pytest.mark.parametrize("period, model", [(4, "additive"), (7, "additive"), (7, "multiplicative"),
                                           (4, "multiplicative"), (1, "additive")])
def test_by_definition(spark, period, model):
    values = np.random.default_rng(period).integers(5, 50, size=40)
    made = decompose_time_series(frame(spark, values), period=period, model=model)
    check(made, values, period, model == "additive")


def test_exactly_two_periods(spark):
    values = [3, 5, 4, 8, 9, 7, 1, 2]
    check(decompose_time_series(frame(spark, values), period=4), values, 4, True)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks.over_blocks, "__defaults__", ((), 9))
    values = np.random.default_rng(0).integers(5, 50, size=60)
    check(decompose_time_series(frame(spark, values), period=8), values, 8, True)


def test_many_series(spark):
    a, b = [3, 5, 4, 8, 9, 7, 1, 2], [9, 1, 8, 2, 7, 3, 6, 4, 5, 5]
    df = frame(spark, a, "a").unionByName(frame(spark, b, "b"))
    made = decompose_time_series(df, period=3, keys=["k"])
    check(made.filter("k = 'a'"), a, 3, True)
    check(made.filter("k = 'b'"), b, 3, True)


def test_short_and_non_positive_series_keep_their_rows(spark):
    good, short, low = [3, 5, 4, 8, 9, 7, 1, 2], [1, 2, 3], [5, 4, 0, 3, 2, 1, 1]
    df = frame(spark, good, "a").unionByName(frame(spark, short, "b")).unionByName(frame(spark, low, "c"))
    made = decompose_time_series(df, period=3, model="multiplicative", keys=["k"])
    check(made.filter("k = 'a'"), good, 3, False)
    rest = made.filter("k <> 'a'").toPandas()
    assert rest[["trend", "seasonal", "resid"]].isna().all().all() and len(rest) == 10
    assert dict(zip(rest["k"], rest["reason"], strict=True)) == {"b": "short", "c": "not positive"}
    only_short = decompose_time_series(frame(spark, short), period=3, keys=["k"])
    assert only_short.count() == 3


def test_rejected_input(spark):
    with pytest.raises(ValueError, match="a series has 7"):
        decompose_time_series(frame(spark, range(1, 8)), period=4)
    with pytest.raises(ValueError, match="positive values"):
        decompose_time_series(frame(spark, [1, 0, 2, 3]), period=2, model="multiplicative")
    with pytest.raises(ValueError, match="model"):
        decompose_time_series(frame(spark, [1, 2]), model="other")
