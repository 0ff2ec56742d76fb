import pytest
from check_queries import compare, connect

from demandloom.queries import ORACLE, QUERIES

from conftest import SMALL

# Trained models have no counterpart in SQL.
WITHOUT_SQL = {"forecast", "forecast_forest", "training_metrics", "importance"}


@pytest.fixture(scope="module")
def duck():
    connection = connect(SMALL)
    yield connection
    connection.close()


def test_every_query_has_sql_but_the_trained_ones():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert node not in plan
    assert compare(frame, duck, ORACLE[name]) == ""


@pytest.mark.parametrize(("name", "again"), [("time_split", "time_split_numbered"), ("time_folds", "time_folds_numbered")])
def test_splits_and_folds_give_the_position_of_every_row(spark, rows, name, again):
    made, numbered = (QUERIES[n](spark, SMALL) for n in (name, again))
    assert "ordinal" in made.columns
    assert rows(made, *sorted(made.columns)) == rows(numbered, *sorted(numbered.columns))


def test_entry(spark):
    import __spark_entry__ as entry

    frame = entry.entry(spark)
    assert frame.count() > 0
    assert entry.queries().keys() >= entry.oracle_sql().keys()
