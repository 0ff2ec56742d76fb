import numpy as np
import pytest

from demandloom.operators import ordinal, splits
from demandloom.spec import PRODUCT, STORE

WEEK = f"{STORE} long, {PRODUCT} long, year int, week int, quantity double"


def grid(spark, weeks, stores=2, products=1):
    rows = [(s, p, 2022, w, float(w)) for w in range(1, weeks + 1) for s in range(stores)
            for p in range(products)]
    return spark.createDataFrame(rows, WEEK)


def test_ordinal_equals_a_global_sort(spark):
    rng = np.random.default_rng(1)
    keys = {(int(rng.integers(0, 9)), int(rng.integers(0, 30)), int(rng.integers(2020, 2023)),
             int(rng.integers(1, 53))) for _ in range(3000)}
    # One store holds most rows.
    keys |= {(99, p, 2021, w) for p in range(100) for w in range(1, 40)}
    df = spark.createDataFrame([(*k, 1.0) for k in keys], WEEK)
    found = ordinal.weekly_ordinal(df).collect()
    expected = {k: i + 1 for i, k in enumerate(
        sorted(keys, key=lambda k: (k[2], k[3], k[0], k[1])))}
    assert {tuple(r)[:4]: r["ordinal"] for r in found} == expected
    assert {r["total_rows"] for r in found} == {len(keys)}


@pytest.mark.parametrize("case", ["stray_time", "text", "date_only", "sequence", "repeated"])
def test_a_hot_key_is_split_whatever_its_order(spark, case):
    """A key with nearly all rows: no range is much larger than its share, and positions are right."""
    n, ranges = 20_000, 40
    base = spark.range(n).selectExpr("id", "if(id % 20 = 0, 'rare', 'hot') as k")
    order = {
        "stray_time": ["at", "id"], "text": ["at", "name"], "date_only": ["at"], "sequence": ["id"],
        "repeated": ["name"]}[case]
    at = "if(id = 7, timestamp_ntz '2022-01-01 10:00:00', timestamp_ntz '2022-01-01 00:00:00') as at"
    df = base.selectExpr("*", at, "'same' as name" if case == "repeated" else "lpad(id, 9, '0') as name")
    sizes = [r["count"] for r in ordinal.lay_out(df, order, ("k",), ranges).groupBy("_range").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 3 * n / ranges
    made = ordinal.with_ordinal(df, order, ("k",), ranges=ranges)
    assert made.columns == [*df.columns, "ordinal", "total_rows"]
    rows = made.toPandas()
    for _, group in rows.groupby("k"):
        assert sorted(group["ordinal"]) == list(range(1, len(group) + 1))
        assert (group["total_rows"] == len(group)).all()
        ordered = group.sort_values("ordinal")
        assert all(tuple(x) <= tuple(y) for x, y in zip(
            ordered[order].values.tolist(), ordered[order].values.tolist()[1:], strict=False))


def test_ordinal_of_text_keys(spark):
    df = spark.createDataFrame([("b", "z", 1, 1), ("a", "y", 1, 1), ("a", "x", 1, 1)],
                               f"{STORE} string, {PRODUCT} string, year int, week int")
    found = {tuple(r)[:2]: r["ordinal"] for r in ordinal.weekly_ordinal(df).collect()}
    assert found == {("a", "x"): 1, ("a", "y"): 2, ("b", "z"): 3}


def test_ordinal_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(None, 1, 2022, 1, 1.0), (1, None, 2022, 1, 2.0),
                                (1, 1, None, 1, 3.0), (1, 1, 2022, 1, 4.0)], WEEK)
    found = {r["quantity"]: r["ordinal"] for r in ordinal.weekly_ordinal(df).collect()}
    assert found == {4.0: 1, 2.0: 2, 1.0: 3, 3.0: 4}


def test_ordinal_restarts_within_keys(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("b", 1, 9), ("a", 1, 7)],
                               "k string, m int, d int")
    made = ordinal.with_ordinal(df, ["m", "d"], ("k",))
    assert sorted((r["k"], r["m"], r["d"], r["ordinal"], r["total_rows"])
                  for r in made.collect()) == [
        ("a", 1, 5, 1, 3), ("a", 1, 7, 2, 3), ("a", 2, 1, 3, 3), ("b", 1, 9, 1, 1)]
    with pytest.raises(ValueError, match="at least one column"):
        ordinal.with_ordinal(df, [])


def test_split_cuts_inside_a_week(spark):
    made = splits.time_split(grid(spark, weeks=5, stores=2), test_size=0.3, numbered=True).collect()
    train = {r["ordinal"] for r in made if r["split"] == "train"}
    test = {r["ordinal"] for r in made if r["split"] == "test"}
    assert train == set(range(1, 8)) and test == {8, 9, 10}
    assert {(r["week"], r["split"]) for r in made if r["week"] == 4} == {(4, "train"), (4, "test")}


def test_folds_by_hand(spark):
    # Seven rows, five folds: blocks of one row, the first two rows only train.
    assert [(f.train_end, f.test_end) for f in ordinal.expanding_folds(7, 5)] == [
        (2, 3), (3, 4), (4, 5), (5, 6), (6, 7)]
    made = splits.time_folds(grid(spark, weeks=7, stores=1), folds=5, numbered=True).collect()
    for j, fold in enumerate(ordinal.expanding_folds(7, 5)):
        train = {r["ordinal"] for r in made if r["fold"] == j and r["part"] == "train"}
        test = {r["ordinal"] for r in made if r["fold"] == j and r["part"] == "test"}
        assert train == set(range(1, fold.train_end + 1))
        assert test == set(range(fold.train_end + 1, fold.test_end + 1))


def test_too_few_rows_for_the_folds(spark):
    with pytest.raises(ValueError, match="more than 5 rows"):
        ordinal.expanding_folds(5, 5)
    with pytest.raises(ValueError, match="two folds"):
        ordinal.expanding_folds(5, 1)
    with pytest.raises(Exception, match="need more rows"):
        splits.time_folds(grid(spark, weeks=5, stores=1), folds=5, numbered=True).collect()
