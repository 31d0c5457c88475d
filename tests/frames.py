"""Small literal collections for tests."""

from pyspark.sql import DataFrame, SparkSession

from shelfseek.operators.ingest import ingest_transform

PRODUCT = "asin string, title string, brand string, description string, price double, embedding array<array<double>>"


def products(spark: SparkSession, rows: list[tuple], dims: int = 2) -> DataFrame:
    """Collection of (asin, brand, description, price, vector) rows."""
    full = [
        (asin, f"title {asin}", brand, description, price, None if vector is None else [vector])
        for asin, brand, description, price, vector in rows
    ]
    return ingest_transform(spark.createDataFrame(full, PRODUCT), dims)


def values(df: DataFrame, *columns: str) -> list:
    rows = [tuple(row) for row in df.select(*columns).collect()]
    return [row[0] for row in rows] if len(columns) == 1 else rows
