"""Weekly tables and features kept up to date week by week.

A run recomputes the weeks it is given and nothing before them. Lags and rolling windows of the first new
weeks need the last rows of every series, which earlier runs leave in a carry table; so neither old sales
nor old weekly rows are read. Weeks may be given again, late ones too: what follows them is then made anew
from the last carry before them.

    weekly/year=/week=      sums per series, replaced week by week
    features/year=/week=    the same rows with lags and rolling statistics
    carry/through=YYYYWW    the last rows of every series up to a week

A run that fails half way is repeated with the same weeks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import weekly
from ..sources.staging import drop_folders, recorded, stage
from ..spec import LAGS, WEEKLY, WINDOWS

KEYS, ORDER = list(WEEKLY.keys), ("year", "week")


def week_code() -> Column:
    """Year and week as one number, in the order of a series."""
    return F.col("year") * 100 + F.col("week")


def weeks_of(sales: DataFrame) -> list[int]:
    """The weeks that occur, ascending; a few dozen numbers a year reach the driver."""
    known = sales.select(week_code().alias("code")).filter("code is not null").distinct()
    return sorted(r["code"] for r in known.collect())


def carries(spark: SparkSession, folder: str) -> list[int]:
    """Weeks up to which a whole carry table was written, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/carry/through=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(int(f.getPath().getParent().getName().removeprefix("through=")) for f in found)


def _replace_weeks(df: DataFrame, path: str) -> None:
    (df.hint("rebalance", "year", "week").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("year", "week").parquet(path))


def _series_features(rows: DataFrame, lags, windows) -> DataFrame:
    lagged = weekly.create_lag_features(rows, KEYS, lags=lags, order_by=ORDER)
    return weekly.create_rolling_features(lagged, KEYS, windows=windows, order_by=ORDER)


def update_weeks(sales: DataFrame, folder: str, weeks: Iterable[int], digits: int | None = None,
                 lags=LAGS, windows=WINDOWS) -> None:
    """Replace ``weeks`` (numbers YYYYWW) by their sales, and bring features and carry up to date.

    ``sales`` holds all rows of these weeks, with ``year`` and ``week``; on a table partitioned by them only
    these weeks are read. A week without a row in ``sales`` keeps what it had. Rows with a null key belong
    to no week. No weeks change nothing.
    """
    weeks = sorted(set(weeks))
    if not weeks:
        return
    spark, first = sales.sparkSession, weeks[0]
    rolled = weekly.weekly_rollup(sales.filter(week_code().isin(weeks)), digits=digits)
    _replace_weeks(rolled, f"{folder}/weekly")
    known = carries(spark, folder)
    # Carries that hold a replaced week no longer tell the truth.
    drop_folders(spark, [f"{folder}/carry/through={w}" for w in known if w >= first])
    through = max((w for w in known if w < first), default=None)

    read = spark.read.schema(rolled.schema).parquet  # a schema of its own opens no file of another week
    stored = read(f"{folder}/weekly")
    recent = stored if through is None else stored.filter(week_code() > through).unionByName(
        read(f"{folder}/carry/through={through}"))
    with recorded() as own:
        recent = stage(recent, "recent-weeks")
    made = _series_features(recent, lags, windows).filter(week_code() >= first)
    _replace_weeks(made, f"{folder}/features")

    last = recent.agg(F.max(week_code())).first()[0]
    if last is not None:
        latest = W.partitionBy(*KEYS).orderBy(*[F.col(c).desc() for c in ORDER])
        depth = max([*lags, *windows], default=0)
        (recent.withColumn("_recency", F.row_number().over(latest)).filter(F.col("_recency") <= depth)
               .drop("_recency").write.mode("overwrite").parquet(f"{folder}/carry/through={last}"))
    drop_folders(spark, own)


def read_features(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/features")
