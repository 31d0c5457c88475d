"""One question against the collection: by vector, or by text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfseek.functions.embedding import Embedder
from shelfseek.functions.text import bm25_idf, bm25_weight, has_term, match_terms, occurrences
from shelfseek.functions.vectors import dot_product, same_length, vector_parameter
from shelfseek.operators.text_index import TextIndex

# Default parameters of both searches.
DEFAULT_MIN_PRICE = 0.0
DEFAULT_MAX_PRICE = 50.0
DEFAULT_BRAND = "playstation"
DEFAULT_LIMIT = 10
DEFAULT_TERMS = ("space", "wars")

PRODUCT_COLUMNS = ("asin", "title", "brand", "description", "estimated_price", "brand_tokens")

# Result rows that may be broadcast to look up their products.
MAX_BROADCAST_WINNERS = 100_000


def metadata_filter(
    min_price: float | str = DEFAULT_MIN_PRICE,
    max_price: float | str = DEFAULT_MAX_PRICE,
    brand: str = DEFAULT_BRAND,
) -> Column:
    """Price in the closed range and brand among the tokens. The range reaches the Parquet scan."""
    in_range = F.col("estimated_price").between(float(min_price), float(max_price))
    return in_range & has_term(F.col("brand_tokens"), F.lower(F.lit(brand)))


def similarity_order() -> list[Column]:
    return [F.desc_nulls_last("similarity"), F.asc("asin")]


def text_order() -> list[Column]:
    return [F.desc("text_search_score"), F.asc("estimated_price"), F.asc("asin")]


def embed_query(collection: DataFrame, text: str, embedder: Embedder) -> list[float]:
    """The vector of one question, made by the embedder that made the collection's vectors."""
    question = collection.sparkSession.range(1).select(embedder(F.lit(text)).alias("v"))
    vector = question.first().v
    if vector is None:
        raise ValueError("the search text cannot be embedded")
    return vector


def vector_search(
    collection: DataFrame,
    embedding: Sequence[float] | str,
    min_price: float | str = DEFAULT_MIN_PRICE,
    max_price: float | str = DEFAULT_MAX_PRICE,
    brand: str = DEFAULT_BRAND,
    limit: int | str = DEFAULT_LIMIT,
    dims: int | None = None,
) -> DataFrame:
    """The ``limit`` products most similar to ``embedding`` among those that pass the filters.

    Each task keeps its own best ``limit`` rows, so only those leave it. A query vector of another length than
    ``dims``, or than the collection's vectors, is an error.
    """
    query = vector_parameter(embedding, dims)
    return (
        collection.filter(metadata_filter(min_price, max_price, brand))
        .select(*PRODUCT_COLUMNS, dot_product(same_length(F.col("embedding"), query), query).alias("similarity"))
        .orderBy(*similarity_order())
        .limit(int(limit))
    )


def full_text_search(
    collection: DataFrame,
    terms: Sequence[str] = DEFAULT_TERMS,
    min_price: float | str = DEFAULT_MIN_PRICE,
    max_price: float | str = DEFAULT_MAX_PRICE,
    brand: str = DEFAULT_BRAND,
    limit: int | str = DEFAULT_LIMIT,
    match_all: bool = False,
    normalize_terms: bool = False,
    index: TextIndex | None = None,
) -> DataFrame:
    """The ``limit`` best products by BM25 of ``terms`` among those that pass the filters.

    Terms match tokens exactly; tokens are lower-case, so ``normalize_terms`` lowers the terms too.
    Without an ``index`` every step is row-wise on the collection, after one aggregate over it for
    the statistics. With one, only the postings of ``terms`` are read.
    """
    wanted = distinct_terms(terms, normalize_terms)
    if index is not None:
        return _search_postings(
            collection, index, wanted, float(min_price), float(max_price), brand, int(limit), match_all
        )
    tokens = F.col("description_tokens")
    holds = [F.count_if(has_term(tokens, t)).alias(f"df_{i}") for i, t in enumerate(wanted)]
    lengths = F.coalesce(F.size(tokens), F.lit(0))
    corpus = (
        collection.agg(F.count("*").alias("documents"), F.avg(lengths).alias("avgdl"), *holds)
        .select(F.struct("*"))
        .scalar()
    )
    stats = F.col("_corpus")
    parts = [
        bm25_idf(stats["documents"], stats[f"df_{i}"])
        * bm25_weight(occurrences(tokens, t), F.size(tokens), stats["avgdl"])
        for i, t in enumerate(wanted)
    ]
    return (
        collection.filter(metadata_filter(min_price, max_price, brand))
        .filter(match_terms(tokens, wanted, match_all))
        .withColumn("_corpus", corpus)
        .select(*PRODUCT_COLUMNS, sum(parts[1:], parts[0]).alias("text_search_score"))
        .orderBy(*text_order())
        .limit(int(limit))
    )


def distinct_terms(terms: Sequence[str], normalize: bool = False) -> list[str]:
    """The terms of one question, each once, in order."""
    wanted = list(dict.fromkeys(t.lower() if normalize else t for t in terms))
    if not wanted:
        raise ValueError("a text search needs at least one term")
    return wanted


def _search_postings(
    collection: DataFrame,
    index: TextIndex,
    terms: list[str],
    min_price: float,
    max_price: float,
    brand: str,
    limit: int,
    match_all: bool,
) -> DataFrame:
    corpus, frequencies = F.col("_corpus"), F.col("_frequencies")
    # One (document, term) pair has one posting, so max picks its weight and the sum has a fixed order.
    weights, hits = [], []
    for i, term in enumerate(terms):
        idf = bm25_idf(corpus["documents"], frequencies[term])
        weight = idf * bm25_weight(F.col("tf"), F.col("dl"), corpus["avgdl"])
        weights.append(F.max(F.when(F.col("term") == term, weight)).alias(f"w_{i}"))
        hits.append(F.when(F.col(f"w_{i}").isNotNull(), 1).otherwise(0))
    found_terms = index.terms.filter(F.col("term").isin(terms))
    by_term = F.map_from_entries(F.collect_list(F.struct("term", "df")))
    scored = (
        index.postings.filter(F.col("term").isin(terms))
        .filter(metadata_filter(min_price, max_price, brand))
        .withColumn("_corpus", index.corpus.select(F.struct("documents", "avgdl")).scalar())
        .withColumn("_frequencies", found_terms.agg(by_term).scalar())
        .groupBy("asin", "estimated_price")
        .agg(*weights)
    )
    if match_all:
        scored = scored.filter(sum(hits[1:], hits[0]) == len(terms))
    addends = [F.coalesce(F.col(f"w_{i}"), F.lit(0.0)) for i in range(len(terms))]
    winners = (
        scored.select("asin", "estimated_price", sum(addends[1:], addends[0]).alias("text_search_score"))
        .orderBy(*text_order())
        .limit(limit)
        .select("asin", "text_search_score")
    )
    if limit <= MAX_BROADCAST_WINNERS:
        winners = F.broadcast(winners)
    found = collection.select(*PRODUCT_COLUMNS).join(winners, "asin")
    return found.select(*PRODUCT_COLUMNS, "text_search_score").orderBy(*text_order()).limit(limit)
