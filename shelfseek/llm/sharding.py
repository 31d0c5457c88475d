"""Minimax contiguous sharding: groups of equal texts, in hash order, cut where the largest shard is smallest.

Groups are atomic. In the order of their hash they are laid out as atoms: a group larger than one part in ``BINS`` of
all bytes is an atom of its own, so there are fewer than ``BINS`` of those; the rest of each of ``BINS`` hash ranges is
one atom. The smallest capacity for which greedy filling needs no more than the given shards is found by binary
search over the atoms' sizes, and the cuts are made there. Only SQL expressions are used. What is gathered in one row
has at most 2 * ``BINS`` entries whatever the input.

Defined results: a null text counts as no bytes and is grouped with empty texts; null and repeated ids are numbered
like others, ties ordered by size; an empty table gives no rows. Shards may stay empty when there are few groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfseek.llm.ranks import numbered
from shelfseek.scratch import stored

SHARDS = 40
BINS = 40_000
#: Counted for a row beside its text.
ROW_BYTES = 16
RANGE = 1 << 30


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32 and the hash of the text, without the text; rows are numbered by ``_spread`` and, with
    ``order``, by that column, which ``_spread`` then follows."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    spread = [F.xxhash64(F.col(doc_id), content).alias("_spread")]
    if order:
        total = docs.agg(F.max(order) + 1).scalar()
        along = F.least(F.lit(RANGE - 1), F.floor(F.col(order) / total * RANGE))
        spread = [along.cast("bigint").alias("_spread"), F.col(order).alias("_order")]
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(content).alias("_text"),
        *spread,
    )


def hash_bin(value: Column) -> Column:
    return F.floor(F.pmod(value, F.lit(RANGE)) * BINS / RANGE).cast("int")


def capacity(sizes: Column, total: Column, shards: int) -> Column:
    """Smallest capacity with which greedy filling of ``sizes`` in order needs at most ``shards`` shards."""
    largest = F.coalesce(F.array_max(sizes), F.lit(0).cast("bigint"))
    share = F.ceil(total / shards).cast("bigint")

    def needed(most: Column) -> Column:
        start = F.struct(F.lit(1).alias("n"), F.lit(0).cast("bigint").alias("fill"))

        def put(state: Column, size: Column) -> Column:
            fits = state["fill"] + size <= most
            return F.struct(
                F.when(fits, state["n"]).otherwise(state["n"] + 1).alias("n"),
                F.when(fits, state["fill"] + size).otherwise(size).alias("fill"),
            )

        return F.aggregate(sizes, start, put)["n"]

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("bigint")
        enough = needed(middle) <= shards
        narrowed = F.struct(
            F.when(enough, state["low"]).otherwise(middle + 1).alias("low"),
            F.when(enough, middle).otherwise(state["high"]).alias("high"),
        )
        return F.when(state["low"] >= state["high"], state).otherwise(narrowed)

    start = F.struct(F.greatest(largest, share).alias("low"), (share + largest).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(62)), start, halve)["high"]


def cuts(sizes: Column, most: Column) -> Column:
    """At which atoms greedy filling begins a new shard."""
    start = F.struct(
        F.lit(0).alias("i"), F.lit(0).cast("bigint").alias("fill"), F.expr("CAST(array() AS array<int>)").alias("cuts")
    )

    def put(state: Column, size: Column) -> Column:
        fits = state["fill"] + size <= most
        return F.struct(
            (state["i"] + 1).alias("i"),
            F.when(fits, state["fill"] + size).otherwise(size).alias("fill"),
            F.when(fits, state["cuts"]).otherwise(F.concat(state["cuts"], F.array(state["i"]))).alias("cuts"),
        )

    return F.aggregate(sizes, start, put)["cuts"]


def atom_shards(groups: DataFrame, shards: int) -> DataFrame:
    """The shard of each atom: (_bin, _text, _shard), ``_text`` null where the atom is the rest of a hash range.
    At most 2 * ``BINS`` rows."""
    total = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("total")).scalar()
    own = F.when(F.col("_bytes") * BINS > total, F.col("_text"))
    atoms = (
        groups.select(hash_bin(F.col("_text")).alias("_bin"), own.alias("_text"), "_bytes")
        .groupBy("_bin", "_text")
        .agg(F.sum("_bytes").alias("_bytes"))
    )
    gathered = atoms.agg(
        F.sort_array(F.collect_list(F.struct("_bin", "_text", "_bytes"))).alias("atoms"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("total"),
    )
    sizes = F.col("atoms._bytes")
    searched = gathered.withColumn("most", capacity(sizes, F.col("total"), shards))
    placed = searched.withColumn("cuts", cuts(sizes, F.col("most")))
    shard = F.size(F.filter("cuts", lambda cut: cut <= F.col("pos")))
    exploded = placed.select("cuts", F.posexplode("atoms").alias("pos", "atom"))
    return exploded.select("atom._bin", "atom._text", shard.alias("_shard"))


def shard(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", order: str | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard) and grown_shard (null: shard borders
    move when shards are added), one row per row of ``docs``. Slots follow the column ``order`` (whole numbers from 0,
    each once), if one is named, else a hash."""
    rows = stored(measured(docs, doc_id, text, order), "sharding-rows")
    groups = stored(rows.groupBy("_text").agg(F.sum("size").alias("_bytes")), "sharding-groups")
    places = stored(atom_shards(groups, shards), "sharding-atoms")
    ranges = places.filter("_text IS NULL").select("_bin", F.col("_shard").alias("_range_shard"))
    large = places.filter("_text IS NOT NULL").select("_text", F.col("_shard").alias("_own_shard"))
    # Both tables have at most BINS rows, whatever the input.
    ordered = ["_order"] if order else []
    placed = (
        rows.withColumn("_bin", hash_bin(F.col("_text")))
        .join(F.broadcast(large), "_text", "left")
        .join(F.broadcast(ranges), "_bin", "left")
        .select("doc_id", "size", "text_crc32", "_spread", *ordered, F.coalesce("_own_shard", "_range_shard").alias("shard"))
    )
    counts = placed.groupBy("shard").agg(F.count("*").alias("_rows"))
    slotted = numbered(placed, "shard", counts, [F.col(c) for c in (*ordered, "doc_id", "size")], "slot")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5(spark, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
