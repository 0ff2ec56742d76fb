import numpy as np
import pandas as pd
import pytest

from demandloom.operators import decompose, sliding, weekly


def series(n, seed=3):
    rng = np.random.default_rng(seed)
    values = np.round(rng.normal(50, 20, n), 2)
    return [("long", i, None if i % 13 == 5 else float(v)) for i, v in enumerate(values)]


def expected(rows, size, before):
    frame = pd.DataFrame(rows, columns=["k", "t", "v"]).sort_values(["k", "t"])
    out = {}
    for k, group in frame.groupby("k"):
        rolled = group["v"].rolling(size, min_periods=1)
        table = pd.DataFrame({"mean": rolled.mean(), "std": rolled.std(), "min": rolled.min(), "max": rolled.max()})
        if before:
            table = table.shift(1)
        for t, values in zip(group["t"], table.fillna(0).to_numpy(), strict=True):
            out[k, t] = values
    return out


@pytest.mark.parametrize("long_series", [False, True])
@pytest.mark.parametrize("include_current", [False, True])
def test_long_windows_equal_pandas(spark, long_series, include_current, monkeypatch):
    monkeypatch.setattr("demandloom.operators.blocks.BLOCK", 100)
    rows = [*series(700), *[("short", i, float(i * i)) for i in range(5)], ("one", 1, 2.0), ("none", 1, None),
            *[("even", i, 7.0) for i in range(90)]]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    sizes = (3, 32, 52, 365)
    made = weekly.create_rolling_features(df, ["k"], "v", sizes, ("t",), include_current, long_series)
    assert made.columns == ["k", "t", "v", *[f"v_roll_{s}_{n}" for n in sizes for s in ("mean", "std", "min", "max")]]
    found = {(r["k"], r["t"]): r for r in made.collect()}
    assert len(found) == len(rows)
    for size in sizes:
        for place, values in expected(rows, size, not include_current).items():
            got = [found[place][f"v_roll_{s}_{size}"] for s in ("mean", "std", "min", "max")]
            assert got == pytest.approx(values.tolist(), abs=1e-7), (place, size)


@pytest.mark.parametrize("period", [52, 53, 365])
def test_long_trends_equal_direct_sums(spark, period):
    rows = [(i, float((i * 37) % 101)) for i in range(900)]
    numbered = spark.createDataFrame([(i + 1, len(rows), v) for i, v in rows],
                                     "ordinal int, total_rows int, v double")
    found = {r["ordinal"]: r["trend"] for r in decompose.centred_average(numbered, "v", period).collect()}
    half, values = period // 2, [v for _, v in rows]
    for i in range(len(rows)):
        if i < half or i >= len(rows) - half:
            assert found[i + 1] is None
            continue
        around = sum(values[i - half:i + half + 1])
        if period % 2 == 0:
            around -= (values[i - half] + values[i + half]) / 2
        assert found[i + 1] == pytest.approx(around / period)


def test_rows_move_once_for_all_sizes(spark):
    df = spark.range(1000).selectExpr("id % 2 as k", "int(id / 2) + 1 as ordinal", "double(id) as v")
    made = sliding.sliding_statistics(df, ["k"], "ordinal", df["v"], [40, 52, 365], ["a", "b", "c"])
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
