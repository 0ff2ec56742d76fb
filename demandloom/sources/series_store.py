"""A feature store laid out by series: bucketed by the keys, partitioned by year.

All rows of a series lie in one bucket, so lags, windows, last observations and joins on the series need
no exchange. The files are an ordinary Parquet folder; the catalog of a session only learns how they are
cut, which ``open_store`` tells it again from the layout written beside them.

    data/year=/             the rows, cut into buckets by series and sorted inside
    layout/                 one row: keys, order, buckets and schema

Years can be replaced one by one. A series must fit a task, as weekly ones do (53 rows a year).
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..spec import WEEKLY, SeriesSpec
from .staging import drop_folders

YEAR = "year"
LAYOUT = "keys array<string>, order array<string>, buckets int, schema string"
# Rows of one bucket, some hundred MB of features; a bucket is read by one task.
ROWS_PER_BUCKET = 2_000_000


def bucket_count(rows: int, least: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for ``rows`` rows, and no fewer than ``least``."""
    return max(1, least, math.ceil(rows / rows_per_bucket))


def write_store(rows: DataFrame, folder: str, spec: SeriesSpec = WEEKLY, buckets: int | None = None) -> DataFrame:
    """Write ``rows`` as a new store and return a frame that reads it.

    The rows move once, to the task of their bucket, so every year has one file a bucket. Without
    ``buckets`` the rows are counted first; give the number if that would make them twice. A folder that
    has a store already is an error.
    """
    spark = rows.sparkSession
    if YEAR not in rows.columns or len(rows.columns) == 1:
        raise ValueError(f"a store needs the column {YEAR} and others")
    if buckets is None:
        buckets = bucket_count(rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    layout = [(list(spec.keys), list(spec.order_by), buckets, rows.schema.json())]
    spark.createDataFrame(layout, LAYOUT).coalesce(1).write.json(f"{folder}/layout")
    replace_years(rows, folder)
    return open_store(spark, folder)


def open_store(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a store, in the column order they were written in; any session can read it."""
    layout = _layout(spark, folder)
    return spark.table(_table(spark, folder, layout)).select(*map(_quoted, _schema(layout).names))


def replace_years(rows: DataFrame, folder: str) -> None:
    """Replace the years that occur in ``rows``; other years are neither read nor written.

    ``rows`` may not read the years that it replaces. Frames opened before should be opened again.
    """
    spark = rows.sparkSession
    layout = _layout(spark, folder)
    name = _table(spark, folder, layout)
    columns = [c for c in _schema(layout).names if c != YEAR]
    (rows.repartition(layout["buckets"], *map(_quoted, layout["keys"]))
         .select(*map(_quoted, [*columns, YEAR])).write.insertInto(name, overwrite=True))


def drop_store(spark: SparkSession, folder: str) -> None:
    """Delete a store and what the catalog knows of it."""
    spark.sql(f"DROP TABLE IF EXISTS {_table(spark, folder, _layout(spark, folder))}")
    drop_folders(spark, [folder])


def newest_week(spark: SparkSession, folder: str) -> int | None:
    """The latest week as a number YYYYWW; only the last year's weeks are read."""
    store = open_store(spark, folder)
    years = [p[0].removeprefix(f"{YEAR}=") for p in
             spark.sql(f"SHOW PARTITIONS {_table(spark, folder, _layout(spark, folder))}").collect()]
    # A partition may have lost all its rows, so earlier years follow if the last has none.
    for year in sorted((int(y) for y in years if y.lstrip("-").isdigit()), reverse=True):
        week = store.filter(F.col(YEAR) == year).agg(F.max("week")).first()[0]
        if week is not None:
            return year * 100 + week
    return None


def _layout(spark: SparkSession, folder: str) -> Row:
    return spark.read.schema(LAYOUT).json(f"{folder}/layout").first()


def _schema(layout: Row) -> StructType:
    return StructType.fromJson(json.loads(layout["schema"]))


def _table(spark: SparkSession, folder: str, layout: Row) -> str:
    """The name of the store in the catalog, which is told what the folder holds now.

    Folder and layout make the name, so a store that was written anew in another layout has another.
    """
    folder = folder.rstrip("/")
    name = f"series_{hashlib.sha256(json.dumps([folder, *layout]).encode()).hexdigest()[:24]}"
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in _schema(layout))
    keys = ", ".join(map(_quoted, layout["keys"]))
    inside = ", ".join(map(_quoted, [*layout["keys"], *[c for c in layout["order"] if c != YEAR]]))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/data")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)  # a store without rows has no other folder
    location = f"{folder}/data".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY ({YEAR}) "
              f"CLUSTERED BY ({keys}) SORTED BY ({inside}) INTO {layout['buckets']} BUCKETS LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    return name


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
