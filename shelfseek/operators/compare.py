"""Vector and full-text results for the same question, side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfseek.functions.embedding import Embedder
from shelfseek.operators.search import (
    DEFAULT_BRAND,
    DEFAULT_LIMIT,
    DEFAULT_MAX_PRICE,
    DEFAULT_MIN_PRICE,
    embed_query,
    full_text_search,
    similarity_order,
    text_order,
    vector_search,
)


def compare_results(by_vector: DataFrame, by_text: DataFrame, keys: Sequence[str] = ("asin",)) -> DataFrame:
    """Ranked results of both searches joined on ``keys``: both ranks, and whether a row is in both."""
    left = by_vector.select(*keys, F.col("rank").alias("vs_rank"), F.col("title").alias("_vs_title"))
    right = by_text.select(*keys, F.col("rank").alias("fts_rank"), F.col("title").alias("_fts_title"))
    both = F.col("vs_rank").isNotNull() & F.col("fts_rank").isNotNull()
    return left.join(right, list(keys), "full_outer").select(
        *keys,
        F.coalesce("_vs_title", "_fts_title").alias("title"),
        "vs_rank",
        "fts_rank",
        both.alias("in_both"),
    )


def compare_searches(
    collection: DataFrame,
    text: str,
    embedder: Embedder | None = None,
    embedding: Sequence[float] | str | None = None,
    min_price: float | str = DEFAULT_MIN_PRICE,
    max_price: float | str = DEFAULT_MAX_PRICE,
    brand: str = DEFAULT_BRAND,
    limit: int | str = DEFAULT_LIMIT,
) -> DataFrame:
    """Run both searches for ``text``: its words are the terms, its vector is ``embedding`` or comes
    from ``embedder``."""
    if embedding is None:
        if embedder is None:
            raise ValueError("give an embedder or an embedding")
        embedding = embed_query(collection, text, embedder)
    filters = {"min_price": min_price, "max_price": max_price, "brand": brand, "limit": limit}
    by_vector = vector_search(collection, embedding, **filters)
    by_text = full_text_search(collection, text.split(), **filters)
    # Each side holds at most ``limit`` rows by now, so one window over all of them is small.
    return compare_results(
        by_vector.withColumn("rank", F.row_number().over(Window.orderBy(*similarity_order()))),
        by_text.withColumn("rank", F.row_number().over(Window.orderBy(*text_order()))),
    )
