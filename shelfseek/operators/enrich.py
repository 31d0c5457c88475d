"""Attach an embedding to JSON records, and say why a record could not get one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfseek.functions.embedding import Embedder
from shelfseek.functions.records import json_field, json_text, parse_object, with_property
from shelfseek.operators.salting import salted_left_join
from shelfseek.scratch import stored

NOT_JSON = "not_json"
NOT_OBJECT = "not_an_object"
NO_DESCRIPTION = "no_description"
NULL_DESCRIPTION = "null_description"
NOT_EMBEDDED = "not_embedded"


def reject_reason(text: Column, record: Column) -> Column:
    """Why ``text``, parsed to ``record``, has no description to embed; NULL if it has one."""
    described = F.map_contains_key(record, F.lit("description"))
    return (
        F.when(F.try_parse_json(text).isNull(), NOT_JSON)
        .when(record.isNull(), NOT_OBJECT)
        .when(~described, NO_DESCRIPTION)
        .when(json_field(record, "description").isNull(), NULL_DESCRIPTION)
    )


def enrich(records: DataFrame, embedder: Embedder, raw_json_text: bool = False) -> DataFrame:
    """``records`` (JSON text in ``value``) with ``embedding``, ``reject_reason`` and, where the
    record was embedded, the ``enriched`` JSON text that holds the embedding as an array of one array.

    ``raw_json_text`` embeds the description as JSON text, quotes and escapes included.
    """
    record = F.col("_record")
    described = (
        records.withColumn("_record", parse_object(F.col("value")))
        .withColumn("reject_reason", reject_reason(F.col("value"), record))
        .withColumn("_text", json_text(json_field(record, "description"), encoded=raw_json_text))
    )
    embedded = described.withColumn("embedding", embedder(F.col("_text")))
    failed = F.col("reject_reason").isNull() & F.col("embedding").isNull()
    vectors = F.array(F.col("embedding"))
    enriched = F.when(
        F.col("embedding").isNotNull(), with_property(record, "embedding", vectors)
    )
    return (
        embedded.withColumn("reject_reason", F.when(failed, NOT_EMBEDDED).otherwise(F.col("reject_reason")))
        .withColumn("enriched", enriched)
        .drop("_record", "_text")
    )


def accepted(enriched: DataFrame) -> DataFrame:
    """Records that got an embedding, with the enriched JSON as ``value``."""
    kept = enriched.filter(F.col("embedding").isNotNull())
    return kept.withColumn("value", F.col("enriched")).drop("enriched", "embedding", "reject_reason")


def rejected(enriched: DataFrame) -> DataFrame:
    """Records that got none, as they came, with ``reject_reason``."""
    return enriched.filter(F.col("embedding").isNull()).drop("enriched", "embedding")


def settled(enriched: DataFrame) -> DataFrame:
    """The records of both with one text each: the enriched JSON of those that got an embedding, as ``value``, and the others
    as they came, with ``reject_reason``; ``is_embedded`` tells them apart. A frame to keep for both writers."""
    embedded = F.col("embedding").isNotNull()
    kept = enriched.withColumns({"is_embedded": embedded, "value": F.when(embedded, F.col("enriched")).otherwise(F.col("value"))})
    return kept.drop("enriched", "embedding")


def embed_distinct(
    df: DataFrame,
    text: str,
    key: str,
    embedder: Embedder,
    parallelism: int | None = None,
    output: str = "embedding",
) -> DataFrame:
    """Embed each distinct text once and hand the vector to every row that holds it.

    For models that charge per call. ``parallelism`` is the number of concurrent callers. Texts are
    matched by their SHA-256, so that a shuffle does not carry them twice. ``key`` names a column that
    tells rows apart and spreads the copies of a frequent text over tasks. The vectors are stored before
    they are handed out, so that a lost executor does not cost the calls again.
    """
    digest = "_digest"
    rows = df.withColumn(digest, F.sha2(F.col(text), 256))
    texts = (
        rows.filter(F.col(digest).isNotNull())
        .groupBy(digest)
        .agg(F.first(text).alias("_text"), F.count("*").alias("_copies"))
    )
    if parallelism is not None:
        texts = texts.repartition(parallelism, digest)
    vectors = stored(texts.select(digest, "_copies", embedder(F.col("_text")).alias(output)), "vectors")
    return salted_left_join(rows, vectors, on=digest, copies="_copies", spread_by=key).drop(digest)
