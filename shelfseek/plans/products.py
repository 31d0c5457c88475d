"""Product-shaped frames derived from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfseek.operators.ingest import ingest_transform

DIMS = 64

# Search parameters that match rows of the given tables.
BRAND = "brand"
MIN_PRICE = 0.0
MAX_PRICE = 950.0
LIMIT = 10
TERMS = ("the", "worthless")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as they are stored, whatever their size; how finely files are read is the session's setting."""
    return table(spark, sf_dir, "documents")


def price() -> Column:
    """Every seventh part has no price, so that the default is used."""
    return F.when(F.col("p_partkey") % 7 != 0, F.col("p_retailprice"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as they leave the enrichment step: the vector is the first of an array of vectors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.array("embedding").alias("embedding"))
    return (
        documents(spark, sf_dir)
        .join(table(spark, sf_dir, "part"), F.col("doc_id") == F.col("p_partkey"))
        .join(vectors, F.col("doc_id") == F.col("vec_id"), "left")
        .select(
            F.col("doc_id").cast("string").alias("asin"),
            F.col("p_name").alias("title"),
            F.concat(F.lit("by "), "p_brand").alias("brand"),
            F.col("text").alias("description"),
            price().alias("price"),
            "embedding",
        )
    )


def collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_transform(raw_products(spark, sf_dir), DIMS)


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The search vector: the one of ``vec_id`` 0."""
    row = table(spark, sf_dir, "embeddings").filter("vec_id = 0").select("embedding").first()
    return list(row.embedding)
