"""Session settings the library is tuned for. A cluster normally brings its own session."""

from __future__ import annotations

import os
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Left joins of facts to a dimension that is too big to broadcast: split hot keys at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # Fits that run side by side share the cores.
    "spark.scheduler.mode": "FAIR",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app_name: str = "demandloom",
                  folder: str | None = None) -> SparkSession:
    """A single-machine session for tests and the bench; intermediate tables go to ``folder``."""
    folder = folder or os.path.abspath("spark-warehouse/staging")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", folder if ":" in folder else f"file:{folder}")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver found it.

    Nothing is sent if the workers find it by their path already. Spark hands the archive to every executor,
    also to those that join later.
    """
    home = os.path.dirname(PACKAGE)
    path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if home in path or getattr(context, "_demandloom_shipped", False):
        return
    made = os.path.join(SparkFiles.getRootDirectory(), "made")  # Spark removes it with the session
    os.makedirs(made, exist_ok=True)
    archive = os.path.join(made, "demandloom.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, home))
    context.addPyFile(archive)
    context._demandloom_shipped = True
