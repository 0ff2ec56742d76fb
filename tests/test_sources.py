import datetime as dt
from pathlib import Path
from types import SimpleNamespace

import pytest

from demandloom.sources import staging
from demandloom.sources import (drop_staged, load_tables, shared_folder, stage, write_forecast_csv,
                                write_processed)
from demandloom.sources.tables import PRODUCTS, STORES, TRANSACTIONS, conform


def test_staged_frames_survive_their_source(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(10).write.parquet(source)
    staged = stage(spark.read.parquet(source).filter("id > 3"), "numbers")
    assert staged.count() == 6
    assert shared_folder(spark).removeprefix("file:") in staged.inputFiles()[0]


def session(folder, chosen=None, master="spark://host:7077"):
    context = SimpleNamespace(getCheckpointDir=lambda: chosen, master=master, applicationId="app")
    found = {"spark.checkpoint.dir": folder}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: found.get(key, default)),
                           sparkContext=context)


def test_shared_folder_comes_from_the_session():
    assert shared_folder(session("hdfs://shared/")) == "hdfs://shared"
    assert shared_folder(session(None, "hdfs://chosen")) == "hdfs://chosen"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(None))
    assert shared_folder(session(None, master="local[2]")) == "spark-warehouse/staging"


def test_nothing_is_kept_outside_the_session_folder():
    package = Path(staging.__file__).parent.parent
    assert not [p for p in package.rglob("*.py") if "tempfile" in p.read_text()]


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: f"file:{tmp_path}/shared")
    assert stage(spark.range(3), "ids").count() == 3
    (tmp_path / "shared" / "demandloom" / spark.sparkContext.applicationId / "checkpoints").mkdir()
    drop_staged(spark)
    assert not list((tmp_path / "shared" / "demandloom").iterdir())


def write_inputs(spark, folder):
    sales = spark.createDataFrame(
        [(dt.date(2022, 1, 3), dt.date(2022, 1, 1), 1, 2, 3, 9.0, 9.0, 1.0, 0.0, 0.5, "extra")],
        "transaction_date date, reference_date date, internal_store_id int, internal_product_id "
        "int, quantity int, gross_value double, net_value double, gross_profit double, "
        "discount double, taxes double, note string")
    stores = spark.createDataFrame([(1, "On Premise", "x", "01-234")],
                                   ", ".join(f"{c} {t or 'string'}" for c, t in STORES.items()))
    products = spark.createDataFrame([(2, *"abcdefg")],
                                     ", ".join(f"{c} {t}" for c, t in PRODUCTS.items()))
    for name, df in (("sales", sales), ("stores", stores), ("products", products)):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def test_load_tables_casts_and_keeps_extra_columns(spark, tmp_path):
    write_inputs(spark, str(tmp_path))
    tables = load_tables(spark, *(f"{tmp_path}/{n}" for n in ("sales", "stores", "products")))
    types = dict(tables.transactions.dtypes)
    assert types["internal_store_id"] == "bigint" and types["quantity"] == "double"
    assert types["note"] == "string" and types["transaction_date"] == "date"
    assert tables.stores.first()["zipcode"] == "01-234"


def test_missing_columns_fail_early(spark):
    with pytest.raises(ValueError, match="transactions: missing columns"):
        conform(spark.range(1), TRANSACTIONS, "transactions")


def test_processed_tables_are_optional_and_overwritten(spark, tmp_path):
    root = str(tmp_path)
    sales = spark.createDataFrame([(1, 2022, 5), (2, 2022, 6)], "id int, year int, week int")
    write_processed(root, transactions=sales)
    write_processed(root, transactions=sales.filter("week = 5"))
    assert (tmp_path / "transactions_processed.parquet" / "year=2022" / "week=5").is_dir()
    assert not (tmp_path / "pdvs_processed.parquet").exists()
    read = spark.read.parquet(f"{root}/transactions_processed.parquet")
    assert [tuple(r) for r in read.collect()] == [(1, 2022, 5)]


def test_forecast_file(spark, tmp_path):
    forecast = spark.createDataFrame([(1, 1023, 123, 120.0)],
                                     "semana int, pdv long, produto long, quantidade double")
    path = write_forecast_csv(forecast, str(tmp_path), dt.datetime(2023, 1, 2, 3, 4, 5))
    other = write_forecast_csv(forecast, str(tmp_path), dt.datetime(2023, 1, 2, 3, 4, 5))
    assert other != path and Path(path).name.startswith("sales_forecast_20230102_030405_")
    parts = [p.read_text().splitlines() for p in Path(path).iterdir() if p.suffix == ".csv"]
    assert all(lines[0] == "semana;pdv;produto;quantidade" for lines in parts)
    assert [line for lines in parts for line in lines[1:]] == ["1;1023;123;120"]
