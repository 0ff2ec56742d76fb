"""Integer codes for categories, fitted once and applied by joining a dictionary."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from ..spec import CATEGORIES, UNKNOWN

NOT_FITTED = -1
# From more columns on, distinct combinations are coded instead of rows.
DIRECT_JOINS = 2


def fit_categories(df: DataFrame, columns=CATEGORIES) -> DataFrame:
    """Dictionary ``(column_name, value, code)``: codes follow the order of the values, from 0.

    Missing values count as a category of their own name; columns that are absent are skipped. The
    distinct values are laid out in ranges, each range is ranked by its own task and shifted by the sizes
    of the ranges before it, so no column has to fit in one task. The dictionary is written to the
    shared folder: applying it does not scan the facts again.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError(f"none of the columns {list(columns)} is present")
    entries = [F.struct(F.lit(c).alias("column_name"),
                        F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("value"))
               for c in present]
    # Combinations first: they are few, and only these are expanded to a row per column.
    values = (df.select(*present).distinct().select(F.explode(F.array(*entries)).alias("entry"))
                .select("entry.column_name", "entry.value").distinct())
    # Written out before it is used: the range of a value must not change between two reads.
    ranged = stage(values.repartitionByRange("column_name", "value")
                   .withColumn("part", F.spark_partition_id()), "category-ranges")
    sizes = ranged.groupBy("column_name", "part").agg(F.count("*").alias("size"))
    before = W.partitionBy("column_name").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("column_name", "part",
                           F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(W.partitionBy("column_name", "part").orderBy("value"))
    dictionary = (
        ranged.withColumn("rank", rank).join(offsets, ["column_name", "part"])
        .select("column_name", "value",
                (F.col("offset") + F.col("rank") - 1).cast("int").alias("code")))
    return stage(dictionary, "categories")


def apply_categories(df: DataFrame, dictionary: DataFrame, columns=CATEGORIES,
                     replace_unseen: bool = True) -> DataFrame:
    """Add ``<column>_encoded``.

    Missing and unseen values become the placeholder category, which gets code -1 if it was not
    there when the dictionary was fitted. ``replace_unseen=False`` leaves the column itself alone.
    However many columns there are, the rows move for one join at most; ``df`` is read twice.
    """
    columns = [c for c in columns if c in df.columns]
    if len(columns) <= DIRECT_JOINS:
        return _coded(df, dictionary, columns, replace_unseen)
    # Combinations of values are few; they are coded column by column, and the rows are joined once.
    named = {c: f"_of_{c}" for c in columns}
    combinations = df.select(columns).distinct()
    coded = _coded(combinations.withColumns({n: F.col(c) for c, n in named.items()}), dictionary, columns,
                   replace_unseen).withColumnsRenamed({f"{c}_encoded": f"_code_of_{c}" for c in columns})
    found = coded.withColumnsRenamed({c: f"_new_{c}" for c in columns})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in named.items()])
    replaced = {c: F.col(f"_new_{c}").alias(c) for c in columns} if replace_unseen else {}
    return df.join(found, same, "left").select(
        *[replaced.get(c, F.col(c)) for c in df.columns if c.removesuffix("_encoded") not in columns or c in columns],
        *[F.col(f"_code_of_{c}").alias(f"{c}_encoded") for c in columns])


def _coded(df: DataFrame, dictionary: DataFrame, columns: list[str], replace_unseen: bool) -> DataFrame:
    """One join per column."""
    # At most one row per column: the code of the placeholder.
    fallback = {row["column_name"]: row["code"] for row in dictionary.filter(
        (F.col("value") == UNKNOWN) & F.col("column_name").isin(columns)).collect()}
    for c in columns:
        known = dictionary.filter(F.col("column_name") == c).select(
            F.col("value").alias("_value"), F.col("code").alias("_code"))
        value = F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
        unseen = F.lit(fallback.get(c, NOT_FITTED))
        df = df.join(known, value == F.col("_value"), "left")
        result = {f"{c}_encoded": F.coalesce("_code", unseen).cast("int")}
        if replace_unseen:
            result[c] = F.coalesce("_value", F.lit(UNKNOWN))
        df = df.withColumns(result).drop("_value", "_code")
    return df


def encode_categorical_features(df: DataFrame, columns=CATEGORIES,
                                dictionary: DataFrame | None = None
                                ) -> tuple[DataFrame, DataFrame]:
    """Encode with a given dictionary, or fit one first; returns the frame and the dictionary."""
    fitted_here = dictionary is None
    if fitted_here:
        dictionary = fit_categories(df, columns)
    return apply_categories(df, dictionary, columns, replace_unseen=not fitted_here), dictionary
