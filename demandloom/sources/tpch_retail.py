"""The retail tables as views over a TPC-H style schema, used by the registered queries and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import RetailTables


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str, grain: str = "dense") -> DataFrame:
    """``lineitem`` as sales and returns; ``dense`` is nation by brand, ``sparse`` supplier by part."""
    items = _table(spark, folder, "lineitem")
    parts = _table(spark, folder, "part").select("p_partkey", "p_brand", "p_retailprice")
    suppliers = _table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    joined = (items.join(parts, items.l_partkey == parts.p_partkey)
                   .join(suppliers, items.l_suppkey == suppliers.s_suppkey))
    if grain == "dense":
        store, product = F.col("s_nationkey"), F.substring("p_brand", 7, 10).cast("int")
    else:
        store, product = F.col("l_suppkey"), F.col("l_partkey")
    sign = F.when(F.col("l_returnflag") == "R", -1.0).otherwise(1.0)
    quantity = sign * F.col("l_quantity")
    gross = sign * F.col("l_extendedprice")
    net = gross * (1 - F.col("l_discount"))
    return joined.select(
        F.col("l_shipdate").alias("transaction_date"),
        F.trunc("l_shipdate", "month").cast("timestamp_ntz").alias("reference_date"),
        store.cast("long").alias("internal_store_id"),
        product.cast("long").alias("internal_product_id"),
        quantity.alias("quantity"),
        gross.alias("gross_value"),
        net.alias("net_value"),
        (net - quantity * F.col("p_retailprice")).alias("gross_profit"),
        (gross * F.col("l_discount")).alias("discount"),
        (net * F.col("l_tax")).alias("taxes"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    nations, regions = _table(spark, folder, "nation"), _table(spark, folder, "region")
    key = F.col("n_nationkey")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        key.cast("long").alias("pdv"),
        F.when(key % 2 == 0, "On Premise").otherwise("Off Premise").alias("premise"),
        F.col("r_name").alias("categoria_pdv"),
        (key * 1000).cast("long").alias("zipcode"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    brands = _table(spark, folder, "part").select("p_brand").distinct()
    number = F.substring("p_brand", 7, 10).cast("int")

    def group(prefix: str, size: int):
        return F.concat(F.lit(prefix), (F.col("produto") % size).cast("string"))

    return brands.select("p_brand", number.cast("long").alias("produto")).select(
        "produto",
        group("cat", 6).alias("categoria"), group("tipo", 4).alias("tipos"),
        group("label", 5).alias("label"), group("sub", 3).alias("subcategoria"),
        F.col("p_brand").alias("marca"), group("fab", 7).alias("fabricante"),
        F.col("p_brand").alias("descricao"),
    )


def retail_tables(spark: SparkSession, folder: str) -> RetailTables:
    return RetailTables(transactions(spark, folder), stores(spark, folder),
                        products(spark, folder))
