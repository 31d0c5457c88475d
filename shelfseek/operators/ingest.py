"""From enriched JSON records to collection rows. Row-wise throughout: one stage, no shuffle, and the
same functions for batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfseek.functions.embedding import DEFAULT_DIMS
from shelfseek.functions.records import json_field, json_text, parse_object
from shelfseek.functions.text import tokenize
from shelfseek.functions.vectors import vector_enforce

# Fixed values of the ingest rules.
DEFAULT_PRICE = 30.0
BRAND_NOISE = "by"
DEFAULT_ORIGIN = "product_stream"

NAMED_FIELDS = ("asin", "title", "brand", "description", "price", "embedding")


def estimated_price(price: Column) -> Column:
    return F.when(price.isNull(), F.lit(DEFAULT_PRICE)).otherwise(price)


def brand_tokens(brand: Column) -> Column:
    return F.array_remove(tokenize(brand), BRAND_NOISE)


def parse_products(messages: DataFrame) -> DataFrame:
    """Typed product fields from JSON text in ``value``.

    ``price`` becomes a double where it reads as one, else NULL; ``unread_price`` and ``unread_embedding``
    hold as JSON text what was given and could not be read. Unnamed fields are kept as JSON text in ``other_fields``. ``_meta`` holds the record as it came and where it came from, for those
    source columns the frame has. Text that is no JSON object gives a row without an asin.
    """
    record = F.col("_record")
    parsed = messages.withColumn("_record", parse_object(F.col("value")))
    others = F.map_filter(record, lambda key, _: ~key.isin(*NAMED_FIELDS))
    price = json_field(record, "price").try_cast("double")
    embedding = json_field(record, "embedding").try_cast("array<array<double>>")
    meta = [c for c in ("value", "topic", "partition", "offset", "timestamp") if c in messages.columns]
    return parsed.select(
        *[json_text(json_field(record, name)).alias(name) for name in NAMED_FIELDS[:4]],
        price.alias("price"),
        F.when(price.isNull(), json_text(json_field(record, "price"), encoded=True)).alias("unread_price"),
        embedding.alias("embedding"),
        F.when(embedding.isNull(), json_text(json_field(record, "embedding"), encoded=True)).alias("unread_embedding"),
        F.to_json(others).alias("other_fields"),
        F.struct(*meta).alias("_meta"),
    )


def ingest_transform(
    products: DataFrame, dims: int = DEFAULT_DIMS, origin: str = DEFAULT_ORIGIN
) -> DataFrame:
    """Every input column but ``_meta``, plus key, default price, checked vector, tokens and origin."""
    first_vector = F.try_element_at("embedding", F.lit(1))
    return products.drop("_meta").withColumns(
        {
            "_id": F.col("asin"),
            "estimated_price": estimated_price(F.col("price").try_cast("double")),
            "embedding": vector_enforce(first_vector, dims),
            "brand_tokens": brand_tokens(F.col("brand")),
            "description_tokens": tokenize(F.col("description")),
            "origin": F.lit(origin),
        }
    )


def ingest_problems(products: DataFrame, dims: int = DEFAULT_DIMS) -> DataFrame:
    """(asin, reason, value) for what ``ingest_transform`` replaces or leaves out: a price that is no number, and a
    vector that is none or not of ``dims`` numbers. The rows themselves go into the collection."""
    first_vector = F.try_element_at("embedding", F.lit(1))
    unusable = F.col("unread_embedding").isNotNull() | (
        F.col("embedding").isNotNull() & vector_enforce(first_vector, dims).isNull()
    )
    given = F.coalesce("unread_embedding", F.to_json("embedding"))
    problems = F.array(
        F.when(F.col("unread_price").isNotNull(), F.struct(F.lit("price_not_a_number").alias("reason"), F.col("unread_price").alias("value"))),
        F.when(unusable, F.struct(F.lit("embedding_unusable").alias("reason"), given.alias("value"))),
    )
    return products.select("asin", F.explode(F.array_compact(problems)).alias("problem")).select("asin", "problem.*")
