"""Intermediate tables on the cluster's shared folder.

A frame that several jobs read is written once as Parquet and read back. That cuts the lineage, lets
later reads prune columns and push filters, and survives the loss of any executor.
"""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_cleaned: set[str] = set()
_records: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without that setting uses a folder in its warehouse, and removes what it has written
    there when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/staging"
    own = f"{folder}/demandloom/{spark.sparkContext.applicationId}".removeprefix("file:")
    if own not in _cleaned:
        _cleaned.add(own)
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return folder


def application_folder(spark: SparkSession) -> str:
    """Where this application keeps what it writes for itself; ``drop_staged`` removes it."""
    return f"{shared_folder(spark)}/demandloom/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a frame that reads it back."""
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for record in _records:
        record.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that ``stage`` writes inside, for ``drop_folders``."""
    record: list[str] = []
    _records.append(record)
    try:
        yield record
    finally:
        _records[:] = [r for r in _records if r is not record]


def drop_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete staged folders that no frame needs any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged, checkpoints included, once no frame needs it any more."""
    drop_folders(spark, [application_folder(spark)])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative estimators a checkpoint folder if the session has none yet."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{application_folder(spark)}/checkpoints")
