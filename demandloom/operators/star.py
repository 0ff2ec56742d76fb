"""Facts joined to the store and product dimensions.

No join here carries a broadcast hint: Spark broadcasts a dimension when its statistics are under
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge join, with run-time splitting of
hot keys, when it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import PRODUCT, STORE


def assert_unique(df: DataFrame, key: str, table: str) -> None:
    """Raise if a dimension key repeats: it would multiply the facts it joins to."""
    repeated = (df.filter(F.col(key).isNotNull()).groupBy(key).count()
                .filter("count > 1").limit(5).collect())
    if repeated:
        sample = [row[key] for row in repeated]
        raise ValueError(f"{table}: key {key} is not unique, for example {sample}")


def _suffixed(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Columns on both sides get ``_x`` and ``_y``."""
    shared = [c for c in left.columns if c in right.columns]
    return (left.withColumnsRenamed({c: f"{c}_x" for c in shared}),
            right.withColumnsRenamed({c: f"{c}_y" for c in shared}))


def attach(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str,
           how: str = "left") -> DataFrame:
    """Join one dimension, keeping both key columns."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    left, right = _suffixed(facts, dimension)
    fact_key = fact_key if fact_key in left.columns else f"{fact_key}_x"
    dim_key = dim_key if dim_key in right.columns else f"{dim_key}_y"
    return left.join(right, left[fact_key] == right[dim_key], how)


def merge_datasets(transactions: DataFrame, stores: DataFrame, products: DataFrame,
                   how: str = "left", allow_repeated_keys: bool = False) -> DataFrame:
    """Transactions with store and product attributes.

    Left joins keep unmatched facts with null attributes. A repeated dimension key raises unless
    ``allow_repeated_keys``, which multiplies the matching facts.
    """
    if not allow_repeated_keys:
        assert_unique(stores, "pdv", "stores")
        assert_unique(products, "produto", "products")
    merged = attach(transactions, stores, STORE, "pdv", how)
    return attach(merged, products, PRODUCT, "produto", how)
