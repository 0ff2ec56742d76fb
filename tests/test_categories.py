import pytest

from demandloom.operators import categories


def frame(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c string")


def codes(df):
    return [r["c_encoded"] for r in df.orderBy("id").collect()]


def test_codes_follow_the_order_of_the_values(spark):
    df = frame(spark, "b", "a", "é", "B", None, "a")
    made, dictionary = categories.encode_categorical_features(df, ["c", "absent"])
    ranking = {v: i for i, v in enumerate(sorted({"b", "a", "é", "B", "Unknown"}))}
    assert codes(made) == [ranking[v] for v in ("b", "a", "é", "B", "Unknown", "a")]
    # Fitting leaves the column itself alone.
    assert [r["c"] for r in made.orderBy("id").collect()][4] is None
    assert {r["value"]: r["code"] for r in dictionary.collect()} == ranking


def test_unseen_values_use_the_fitted_placeholder(spark):
    _, dictionary = categories.encode_categorical_features(frame(spark, "z", None, "y"), ["c"])
    made, _ = categories.encode_categorical_features(frame(spark, "new", None, "z"), ["c"],
                                                     dictionary)
    assert codes(made) == [0, 0, 2]
    assert [r["c"] for r in made.orderBy("id").collect()] == ["Unknown", "Unknown", "z"]


def test_unseen_values_without_a_fitted_placeholder(spark):
    _, dictionary = categories.encode_categorical_features(frame(spark, "z", "y"), ["c"])
    made, _ = categories.encode_categorical_features(frame(spark, "new", "z"), ["c"], dictionary)
    assert codes(made) == [-1, 1]


def test_many_values_over_many_ranges(spark):
    df = spark.range(5000).selectExpr("cast(id as int) as id", "concat('v', id) as c")
    made, dictionary = categories.encode_categorical_features(df, ["c"])
    expected = {v: i for i, v in enumerate(sorted(f"v{i}" for i in range(5000)))}
    assert {r["c"]: r["c_encoded"] for r in made.collect()} == expected


@pytest.mark.parametrize("replace_unseen", [True, False])
def test_many_columns_are_coded_as_one_by_one(spark, rows, monkeypatch, replace_unseen):
    names = ["a", "b", "c", "d"]
    known = spark.createDataFrame([("x", "y", None, 1), ("z", "y", "w", 2)], "a string, b string, c string, d int")
    dictionary = categories.fit_categories(known, names)
    df = spark.createDataFrame([(i, ["x", "z", "new", None][i % 4], ["y", None][i % 2], ["w", None, "u"][i % 3], i % 4)
                                for i in range(40)], "id int, a string, b string, c string, d int")
    made = categories.apply_categories(df, dictionary, names, replace_unseen)
    monkeypatch.setattr(categories, "DIRECT_JOINS", 9)
    one_by_one = categories.apply_categories(df, dictionary, names, replace_unseen)
    assert made.columns == one_by_one.columns and rows(made) == rows(one_by_one)


def test_rows_move_once_however_many_columns(spark, tmp_path):
    spark.range(1000).selectExpr(*[f"concat('v', id % {k}) as c{k}" for k in range(2, 9)]).write.parquet(
        str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    names = facts.columns
    dictionary = categories.fit_categories(facts, names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = categories.apply_categories(facts, dictionary, names)
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        # From the rows up: one join with the coded combinations.
        depths = [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Join" in line]
        assert sum(d == min(depths) for d in depths) == 1
        assert plan.splitlines()[1].lstrip(" :+-").startswith("Join LeftOuter")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_column_present(spark):
    with pytest.raises(ValueError, match="none of the columns"):
        categories.fit_categories(frame(spark, "a"), ["x"])
