"""Documents through quality rules, a quality classifier, near-duplicate removal and packing."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from demandloom.llm import cotrain, host_quality, jaccard, packing
from demandloom.sources.staging import drop_folders, recorded, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Folders that the stages before the current one staged for themselves.
_left: list[str] = []
# Rows that Spark hands a Python worker together, at most: whole texts take room on both sides.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def clear(spark: SparkSession, docs: DataFrame) -> None:
    """Delete what stages staged for themselves once ``docs`` is read from files of its own.

    A frame that still reads staged folders keeps them, and one that names no files, as a cached one, keeps
    all of them.
    """
    files = docs.inputFiles() if _left else []
    if files:
        read = " ".join(files)
        gone = [folder for folder in _left if folder.rsplit("/", 1)[-1] not in read]
        _left[:] = [folder for folder in _left if folder not in gone]
        drop_folders(spark, gone)


def small_batches(spark: SparkSession) -> None:
    """Python workers get few texts together from now on, in this session."""
    if not 0 < int(spark.conf.get(BATCH)) <= BATCH_ROWS:
        spark.conf.set(BATCH, BATCH_ROWS)


def tidy(function: Stage) -> Stage:
    """A stage that first deletes what the ones before it needed only until their rows were written.

    Its rows may be written after it returned, so batches stay small in the session.
    """
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear(spark, docs)
        small_batches(spark)
        with recorded() as folders:
            out = function(spark, docs, sf_dir)
        _left.extend(folders)
        return out
    return run


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and come from a host that isn't rejected."""
    return host_quality.keep_good(docs)


@tidy
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, takes for good."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return cotrain.keep_good(docs, cotrain.fit(docs, labels))


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one_of_each(docs)


@tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of powers of two, one row per piece with its tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier),
          ("near_duplicates", near_duplicates), ("packing", pack)]

# The classifier is trained, which SQL can't express; the tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    rows = spark.conf.get(BATCH)
    try:
        for name, function in STAGES:
            docs = stage(function(spark, docs, sf_dir), name.replace("_", "-"))
            clear(spark, docs)
    finally:
        spark.conf.set(BATCH, rows)
    return docs
