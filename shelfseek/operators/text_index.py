"""Postings and corpus statistics of a collection, at once or in segments that follow its changes.

A stored index is a list of segments (see ``commits.py``), one for each micro-batch. A segment holds the postings of the
documents that the batch brought or changed, which earlier versions these replace, and what they add to the statistics
and take away. Readers leave out replaced postings and add up the statistics; ``compact_index`` folds all segments into one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfseek.functions.text import bm25_idf, bm25_weight, term_counts
from shelfseek.operators import commits
from shelfseek.operators.collection import MAX_BROADCAST_BYTES, VERSION
from shelfseek.scratch import stored

# Postings of a block, as a power of two.
BLOCK_BITS = 10
SEGMENT = "_segment"


@dataclass(frozen=True)
class TextIndex:
    """``postings`` (asin, term, tf, dl, estimated_price, brand_tokens, and block if stored), ``terms`` (term, df) and
    the one-row ``corpus`` (documents, avgdl). Postings carry the filter columns of a search, so that only its winners
    are looked up in the collection. ``blocks`` (term, block, max_tf, min_dl), if stored, bounds each block's scores.
    ``documents``, if not stored yet, are the ``counted_documents`` that the postings come from."""

    postings: DataFrame
    terms: DataFrame
    corpus: DataFrame
    blocks: DataFrame | None = None
    documents: DataFrame | None = None


def counted_documents(collection: DataFrame) -> DataFrame:
    """One row per document: its filter columns, its length and its distinct terms with their counts."""
    return collection.select(
        "asin", length().alias("dl"), "estimated_price", "brand_tokens", term_counts(F.col("description_tokens")).alias("counted")
    )


def document_postings(documents: DataFrame) -> DataFrame:
    """One row per document and distinct term of ``counted_documents``."""
    # The outer form, as the inner one makes Spark count once more to drop empty lists beforehand.
    rows = documents.select("asin", "dl", "estimated_price", "brand_tokens", F.explode_outer("counted").alias("counted"))
    return rows.select(
        "asin", "counted.term", "counted.tf", "dl", "estimated_price", "brand_tokens"
    ).filter(F.col("term").isNotNull())


def postings(collection: DataFrame) -> DataFrame:
    """One row per document and distinct term. No shuffle: a document is counted where it is read."""
    return document_postings(counted_documents(collection))


def term_statistics(postings_: DataFrame) -> DataFrame:
    """Documents per term. Counts combine before the shuffle, so frequent terms stay cheap."""
    return postings_.groupBy("term").agg(F.count("*").alias("df"))


def length() -> Column:
    return F.coalesce(F.size("description_tokens"), F.lit(0))


def corpus_statistics(collection: DataFrame) -> DataFrame:
    """Number of documents, those without tokens included, and their mean length."""
    return collection.agg(F.count("*").alias("documents"), F.avg(length()).alias("avgdl"))


def text_index(collection: DataFrame) -> TextIndex:
    documents = counted_documents(collection)
    rows = document_postings(documents)
    return TextIndex(rows, term_statistics(rows), corpus_statistics(collection), documents=documents)


def block_bounds(postings_: DataFrame) -> DataFrame:
    """What no posting of a term in a block exceeds: its count of the term, and its document's length from below."""
    return postings_.groupBy("term", "block").agg(F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl"))


def write_postings(rows: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Store postings ranged by (term, asin) and return the stored ones.

    A file covers a narrow range of terms, so a lookup skips most files, and a term that fills many files is split
    between them by asin. A block is a run of rows of one file, so a frequent term has as many blocks as it needs.
    """
    by_term = ("term", "asin")
    ranged = rows.repartitionByRange(files, *by_term) if files else rows.repartitionByRange(*by_term)
    sorted_ = ranged.sortWithinPartitions(*by_term)
    run = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    blocked = sorted_.withColumn("block", F.xxhash64(F.lit(path), run))
    blocked.write.parquet(path, compression="zstd")
    return rows.sparkSession.read.schema(blocked.schema).parquet(path)


def save_index(index: TextIndex, path: str, files: int | None = None) -> TextIndex:
    """Store an index for term lookups and return the stored one."""
    spark = index.postings.sparkSession
    # Ranges are found in a first pass over all rows, so the documents are counted before.
    rows = index.postings if index.documents is None else document_postings(stored(index.documents, "counted-documents"))
    held = write_postings(rows, f"{path}/postings", files)
    term_statistics(held).sortWithinPartitions("term").write.parquet(f"{path}/terms")
    block_bounds(held).sortWithinPartitions("term").write.parquet(f"{path}/blocks")
    index.corpus.write.parquet(f"{path}/corpus")
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> TextIndex:
    return TextIndex(*[spark.read.parquet(f"{path}/{part}") for part in ("postings", "terms", "corpus", "blocks")])


# An index in segments


def update_index(batch: DataFrame, batch_id: int, path: str) -> bool:
    """Bring the index under ``path`` up to ``batch``: rows of a collection, each asin once, with ``_version``.

    Versions that are not newer than the indexed one are left out. False if the batch is indexed already.
    """
    spark = batch.sparkSession
    if commits.is_committed(spark, path, batch_id):
        return False
    folder = commits.new_name("segments")
    known = current_documents(spark, path, batch)
    if known is None:
        rows = batch.withColumns({"_old_segment": F.lit(None).cast("bigint"), "_old_dl": F.lit(None).cast("int")})
    else:
        # Versions are compared alone; only rows that are newer are counted.
        compared = batch.select("asin", VERSION).join(known, "asin", "left").filter(F.col("_held").isNull() | (F.col(VERSION) > F.col("_held")))
        newer = stored(compared.select("asin", "_old_segment", "_old_dl"), "newer")
        rows = batch.join(F.broadcast(newer) if small(newer) else newer, "asin")
    number = F.lit(batch_id).cast("bigint").alias(SEGMENT)
    columns = [c for c in counted_documents(rows).columns if c != "counted"]
    documents = rows.withColumn("dl", length()).withColumn("counted", term_counts(F.col("description_tokens"))).select(
        *columns, "counted", VERSION, number, "_old_segment", "_old_dl"
    )
    documents.write.parquet(f"{path}/{folder}/documents", compression="zstd")
    fresh = spark.read.schema(documents.schema).parquet(f"{path}/{folder}/documents")
    held = write_postings(document_postings(fresh).withColumn(SEGMENT, number), f"{path}/{folder}/postings")
    gone = fresh.filter(F.col("_old_segment").isNotNull()).select("asin", F.col("_old_segment").alias(SEGMENT))
    gone.write.parquet(f"{path}/{folder}/replaced")
    added = held.groupBy("term").agg(F.count("*").alias("df"))
    lost = added.limit(0)
    if known is not None:
        before = read_part(spark, path, segments(spark, path), "documents").select("asin", SEGMENT, F.col("counted.term").alias("terms"))
        replaced = before.join(F.broadcast(gone) if small(gone) else gone, ["asin", SEGMENT], "left_semi")
        lost = replaced.select(F.explode("terms").alias("term")).groupBy("term").agg((-F.count("*")).alias("df"))
    changed = added.union(lost).groupBy("term").agg(F.sum("df").alias("df")).filter(F.col("df") != 0)
    changed.sortWithinPartitions("term").write.parquet(f"{path}/{folder}/terms")
    block_bounds(held).sortWithinPartitions("term").write.parquet(f"{path}/{folder}/blocks")
    fresh.agg(
        (F.count("*") - F.count("_old_segment")).alias("documents"),
        F.coalesce(F.sum(F.col("dl") - F.coalesce("_old_dl", F.lit(0))), F.lit(0)).cast("bigint").alias("tokens"),
    ).write.parquet(f"{path}/{folder}/corpus")
    commits.add(spark, path, batch_id, folder, [])
    return True


def segments(spark: SparkSession, path: str) -> list[str]:
    now = commits.commits(spark, path)
    if now is None:
        raise ValueError(f"nothing has been indexed under {path}")
    return [*now.folders.values(), *[folder for _, folder, _ in now.changes]]


def read_part(spark: SparkSession, path: str, folders: list[str], part: str) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{folder}/{part}" for folder in folders])


def small(rows: DataFrame) -> bool:
    """Whether the rows' asins, measured, may be broadcast."""
    return rows.agg(F.coalesce(F.sum(F.octet_length("asin") + 32), F.lit(0))).first()[0] <= MAX_BROADCAST_BYTES


def current_documents(spark: SparkSession, path: str, batch: DataFrame) -> DataFrame | None:
    """For the batch's asins that are indexed, the version, segment and length that count now."""
    if commits.commits(spark, path) is None:
        return None
    documents = read_part(spark, path, segments(spark, path), "documents")
    asins = batch.select("asin")
    held = documents.join(F.broadcast(asins) if small(asins) else asins, "asin", "left_semi")
    newest = held.groupBy("asin").agg(F.max_by(F.struct(VERSION, SEGMENT, "dl"), SEGMENT).alias("d"))
    return newest.select(
        "asin",
        F.col(f"d.{VERSION}").alias("_held"),
        F.col(f"d.{SEGMENT}").alias("_old_segment"),
        F.col("d.dl").alias("_old_dl"),
    )


def without_replaced(spark: SparkSession, path: str, folders: list[str], rows: DataFrame) -> DataFrame:
    """``rows`` (asin, segment) of versions that count: replaced ones are left out, by broadcast while they are few."""
    replaced = read_part(spark, path, folders, "replaced")
    if replaced.isEmpty():
        return rows
    return rows.join(F.broadcast(replaced) if small(replaced) else replaced, ["asin", SEGMENT], "left_anti")


def read_index(spark: SparkSession, path: str) -> TextIndex:
    """The index as of now."""
    folders = segments(spark, path)
    live = without_replaced(spark, path, folders, read_part(spark, path, folders, "postings")).drop(SEGMENT)
    terms = read_part(spark, path, folders, "terms").groupBy("term").agg(F.sum("df").alias("df")).filter(F.col("df") > 0)
    sums = read_part(spark, path, folders, "corpus").agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    average = F.when(F.col("documents") > 0, F.col("tokens") / F.col("documents"))
    corpus = sums.select("documents", average.alias("avgdl"))
    # Bounds of blocks that hold replaced postings stay bounds.
    return TextIndex(live, terms, corpus, read_part(spark, path, folders, "blocks"))


def compact_index(spark: SparkSession, path: str) -> int:
    """Fold all segments into one and return its version."""
    now, folders = commits.commits(spark, path), segments(spark, path)
    index, folder = read_index(spark, path), commits.new_name("segments")
    upto = now.changes[-1][0] if now.changes else now.upto
    number = F.lit(upto).cast("bigint")
    held = write_postings(index.postings.drop("block").withColumn(SEGMENT, number), f"{path}/{folder}/postings")
    index.terms.sortWithinPartitions("term").write.parquet(f"{path}/{folder}/terms")
    block_bounds(held).sortWithinPartitions("term").write.parquet(f"{path}/{folder}/blocks")
    sums = read_part(spark, path, folders, "corpus").agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    sums.write.parquet(f"{path}/{folder}/corpus")
    documents = without_replaced(spark, path, folders, read_part(spark, path, folders, "documents"))
    documents.drop("_old_segment", "_old_dl").withColumn(SEGMENT, number).write.parquet(f"{path}/{folder}/documents")
    spark.createDataFrame([], f"asin string, {SEGMENT} bigint").write.parquet(f"{path}/{folder}/replaced")
    commits.add(spark, path, upto, folder, [], now.version + 1, {0: folder})
    return now.version + 1


# Scores of terms


def top_weight(corpus_avgdl: Column) -> Column:
    """What no posting of a block weighs more than: the weight of its greatest count in its shortest document."""
    return bm25_weight(F.col("max_tf"), F.col("min_dl"), corpus_avgdl)


def weighted_terms(terms: DataFrame, corpus: DataFrame) -> DataFrame:
    """(term, df, idf, avgdl)."""
    stats = corpus.select(F.struct("documents", "avgdl")).scalar()
    with_stats = terms.withColumn("_corpus", stats)
    return with_stats.select("term", "df", bm25_idf(F.col("_corpus.documents"), F.col("df")).alias("idf"), "_corpus.avgdl")
