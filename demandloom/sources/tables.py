"""The three input tables: expected columns, types, and a scan that fails early."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Input schemas.
TRANSACTIONS = {
    "transaction_date": "timestamp_ntz",
    "reference_date": "timestamp_ntz",
    "internal_store_id": "bigint",
    "internal_product_id": "bigint",
    "quantity": "double",
    "gross_value": "double",
    "net_value": "double",
    "gross_profit": "double",
    "discount": "double",
    "taxes": "double",
}
STORES = {"pdv": "bigint", "premise": "string", "categoria_pdv": "string", "zipcode": None}
PRODUCTS = {
    "produto": "bigint",
    "categoria": "string",
    "tipos": "string",
    "label": "string",
    "subcategoria": "string",
    "marca": "string",
    "fabricante": "string",
    "descricao": "string",
}


class RetailTables(NamedTuple):
    transactions: DataFrame
    stores: DataFrame
    products: DataFrame


def conform(df: DataFrame, schema: dict[str, str | None], table: str) -> DataFrame:
    """Cast the expected columns to their types and keep any others as they are.

    String dates are left to ``parse_dates``, and string keys stay strings: both are legal inputs.
    """
    missing = [name for name in schema if name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    found = dict(df.dtypes)
    columns = []
    for name in df.columns:
        wanted = schema.get(name)
        is_text = found[name] == "string"
        keeps_text = is_text and wanted in ("timestamp_ntz", "bigint")
        is_date = wanted == "timestamp_ntz" and found[name] in ("date", "timestamp_ntz")
        if wanted is None or keeps_text or is_date or found[name] == wanted:
            columns.append(F.col(name))
        else:
            columns.append(F.col(name).cast(wanted).alias(name))
    return df.select(*columns)


def load_tables(spark: SparkSession, transactions: str, stores: str, products: str) -> RetailTables:
    """Scan the three Parquet inputs; each path may be a file, a directory or a glob."""
    return RetailTables(
        conform(spark.read.parquet(transactions), TRANSACTIONS, "transactions"),
        conform(spark.read.parquet(stores), STORES, "stores"),
        conform(spark.read.parquet(products), PRODUCTS, "products"),
    )
