"""Mixing sources to target weights by Pfair scheduling.

Time is slots of one block each. Weights become whole units of a period of slots; a source with ``a`` of ``period``
units must run its block ``j`` not before slot ``floor(j * period / a)`` and before slot ``ceil((j + 1) * period / a)``.
Earliest deadline first, among released blocks, meets all of these, so at every slot each source is less than one
block away from its share. The schedule repeats with the period: it is folded once, in SQL, over as many slots as the
period has, and every row's slot follows from its number in its source.

No row is dropped or repeated: when a source has run out its slots are left out, and the others close up.

Bounds: at most ``MAX_SOURCES`` sources (more is an error: targets are settings, not data), the period has at most
``MAX_PERIOD`` slots. Defined results: rows without a source are a source of their own; a source without target gets
the smallest weight of one unit; targets of sources that have no rows are left out; null, empty and repeated rows are
numbered as others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfseek.llm.ranks import numbered

BLOCK_ROWS = 16
PERIOD = 1000
MAX_SOURCES = 500
MAX_PERIOD = 5000
#: With no targets given, a source weighs its rows to this power.
TEMPERATURE = 0.5


def source_table(rows: DataFrame, targets: dict[str | None, float] | None) -> DataFrame:
    """One row per source: its rows and its weight."""
    counts = rows.groupBy("_source").agg(F.count("*").alias("_rows"))
    if targets is None:
        return counts.withColumn("_weight", F.pow(F.col("_rows").cast("double"), F.lit(TEMPERATURE)))
    given = [(source_name(name), float(weight)) for name, weight in targets.items() if weight > 0]
    weights = counts.sparkSession.createDataFrame(given, "_source string, _weight double")
    return counts.join(F.broadcast(weights), "_source", "left").fillna(0.0, ["_weight"])


def source_name(name: str | None) -> str:
    """Sources as strings that tell a missing one from every given one."""
    return "-" if name is None else f"+{name}"


def units(sources: DataFrame, period: int) -> DataFrame:
    """One row: the sources in order of name, each with its rows and its units; units add up to the period.
    Each source has one unit, the rest is dealt by weight, what is left over to the largest remainders."""
    gathered = sources.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("_source", "_rows", "_weight"))).alias("all"),
        F.sum("_weight").alias("total"),
        F.count("*").alias("n"),
    )
    slots = F.least(F.lit(MAX_PERIOD), F.greatest(F.lit(period), F.col("n") * 10)).cast("bigint")
    known = gathered.filter("n > 0").withColumn(
        "period",
        F.when(F.col("n") > MAX_SOURCES, F.raise_error(F.lit(f"more than {MAX_SOURCES} sources"))).otherwise(slots),
    )
    exact = F.transform(
        "all",
        lambda s, i: F.struct(
            i.alias("i"),
            F.when(F.col("total") > 0, s["_weight"] / F.col("total") * (F.col("period") - F.col("n")))
            .otherwise((F.col("period") - F.col("n")) / F.col("n"))
            .alias("share"),
        ),
    )
    floored = known.withColumn("exact", exact)
    left = F.col("period") - F.col("n") - F.aggregate(
        "exact", F.lit(0).cast("bigint"), lambda t, e: t + F.floor(e["share"]).cast("bigint")
    )
    by_remainder = F.sort_array(
        F.transform("exact", lambda e: F.struct((F.floor(e["share"]) - e["share"]).alias("r"), e["i"].alias("i")))
    )
    ranked = floored.withColumn("left", left).withColumn("lucky", F.slice(by_remainder, 1, F.greatest(F.lit(1), F.col("left").cast("int"))))
    own = lambda i: (
        F.floor(F.get("exact", i)["share"]).cast("bigint")
        + 1
        + F.when((F.col("left") > 0) & F.exists("lucky", lambda x: x["i"] == i), 1).otherwise(0)
    )
    return ranked.select(
        "period",
        F.transform(
            "all", lambda s, i: F.struct(s["_source"].alias("source"), s["_rows"].alias("rows"), own(i).alias("units"))
        ).alias("sources"),
    )


def release(j: Column, share: Column, period: Column) -> Column:
    return F.floor(j * period / share).cast("bigint")


def deadline(j: Column, share: Column, period: Column) -> Column:
    return F.ceil((j + 1) * period / share).cast("bigint")


def schedule(shares: DataFrame) -> DataFrame:
    """One row per slot of the period: the source that runs, which of its blocks in this period, and how many
    blocks each source has run before."""
    period = F.col("period")

    def step(state: Column, slot: Column) -> Column:
        waiting = F.transform(
            "sources",
            lambda s, i: F.when(
                release(F.get(state["run"], i), s["units"], period) <= slot,
                F.struct(deadline(F.get(state["run"], i), s["units"], period).alias("deadline"), i.alias("i")),
            ),
        )
        chosen = F.array_min(waiting)["i"]
        entry = F.struct(slot.alias("slot"), chosen.alias("i"), state["run"].alias("before"))
        return F.struct(
            F.transform(state["run"], lambda n, i: F.when(i == chosen, n + 1).otherwise(n)).alias("run"),
            F.concat(state["slots"], F.array(entry)).alias("slots"),
        )

    start = F.struct(
        F.transform("sources", lambda s: F.lit(0).cast("bigint")).alias("run"),
        F.expr("CAST(array() AS array<struct<slot: bigint, i: int, before: array<bigint>>>)").alias("slots"),
    )
    folded = shares.select(
        "period", "sources", F.explode(F.aggregate(F.sequence(F.lit(0).cast("bigint"), period - 1), start, step)["slots"]).alias("at")
    )
    source = F.get("sources", F.col("at.i"))
    return folded.select(
        source["source"].alias("_source"),
        F.get("at.before", F.col("at.i")).alias("_turn"),
        F.col("at.slot").alias("_slot"),
        source["units"].alias("_units"),
        F.col("period").alias("_period"),
        # What each source has run when this slot begins: by block, in whole periods and in this one.
        F.arrays_zip(F.col("sources.rows").alias("rows"), F.col("sources.units").alias("units"), F.col("at.before").alias("before")).alias("_others"),
    )


def with_positions(rows: DataFrame, targets: dict[str | None, float] | None, period: int, block_rows: int) -> DataFrame:
    """``rows`` (with ``_source``, ``_spread`` and ``_id``) with their block's slot, release and deadline and their
    place in the whole mix."""
    sources = source_table(rows, targets)
    # A row per slot, at most MAX_PERIOD; a source may have to wait for it in several joins, so it is small.
    slots = F.broadcast(schedule(units(sources, period)))
    ranked = numbered(rows, "_source", sources.select("_source", "_rows"), [F.col("_id")], "_number")
    block = F.floor(F.col("_number") / block_rows).cast("bigint")
    blocks = ranked.withColumn("_block", block)
    # Every period runs as many blocks of a source as it has units.
    share = slots.select("_source", "_units").distinct()
    turned = blocks.join(F.broadcast(share), "_source").withColumn("_turn", F.pmod(F.col("_block"), F.col("_units")))
    placed = turned.drop("_units").join(slots, ["_source", "_turn"])
    cycle = F.floor(F.col("_block") / F.col("_units")).cast("bigint")
    before = F.aggregate(
        "_others",
        F.lit(0).cast("bigint"),
        lambda total, o: total + F.least(o["rows"], (cycle * o["units"] + o["before"]) * block_rows),
    )
    return (
        placed.withColumn("_position", before + F.pmod(F.col("_number"), F.lit(block_rows)))
        .withColumn("_slot", cycle * F.col("_period") + F.col("_slot"))
        .withColumn("_release", release(F.col("_block"), F.col("_units"), F.col("_period")))
        .withColumn("_deadline", deadline(F.col("_block"), F.col("_units"), F.col("_period")))
    )


def keyed(docs: DataFrame, doc_id: str, source: str) -> list[Column]:
    name = F.col(source).cast("string")
    return [
        F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), name)).alias("_source"),
        F.xxhash64(F.col(doc_id)).alias("_spread"),
        F.col(doc_id).alias("_id"),
    ]


def mix(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    period: int = PERIOD,
    block_rows: int = BLOCK_ROWS,
    position: str | None = None,
) -> DataFrame:
    """``docs``, all rows and columns, in the order of the mix (files in order, rows in order within); with ``position``,
    also a column of that name: each row's place in the mix, gapless from 0, for those who store the rows."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *keyed(docs, doc_id, source))
    place = [F.col("_position").alias(position)] if position else []
    return with_positions(rows, targets, period, block_rows).orderBy("_position").select("_row.*", *place)


def mix_schedule(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    period: int = PERIOD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, source, block (number in its source), slot, release, deadline and position of each row."""
    rows = docs.select(*keyed(docs, doc_id, source))
    return with_positions(rows, targets, period, block_rows).select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_source") != "-", F.expr("substring(_source, 2)")).alias("source"),
        F.col("_block").alias("block"),
        F.col("_slot").alias("slot"),
        F.col("_release").alias("release"),
        F.col("_deadline").alias("deadline"),
        F.col("_position").alias("position"),
    )


def op10(spark, sf_dir: str) -> DataFrame:
    return mix_schedule(spark.read.parquet(f"{sf_dir}/documents.parquet"))
