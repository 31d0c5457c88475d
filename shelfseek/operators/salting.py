"""Equi-join that stays even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds more than one row in HOT_SHARE. At most HOT_SHARE keys can, whatever the
# data, so the table of hot keys has a fixed bound and may be broadcast.
HOT_SHARE = 1000


def salted_left_join(
    rows: DataFrame, lookup: DataFrame, on: str, copies: str, spread_by: str
) -> DataFrame:
    """``rows`` left-joined with ``lookup``, whose ``on`` is unique and whose ``copies`` says how many
    of ``rows`` have that key.

    Rows of a hot key are split over as many salts as the key has thousandths of all rows; the lookup
    row is repeated once per salt.
    """
    total = F.col("_total")
    counted = lookup.select(on, copies).withColumn("_total", lookup.agg(F.sum(copies)).scalar())
    share = F.col(copies) * HOT_SHARE
    salts = F.ceil(share / total).cast("int")
    hot = F.broadcast(counted.filter(share > total).select(on, salts.alias("_salts")))
    salt = F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int")
    salted_rows = (
        rows.join(hot, on, "left")
        .withColumn("_salt", F.coalesce(salt, F.lit(0)))
        .drop("_salts")
    )
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_lookup = (
        lookup.join(hot, on, "left")
        .withColumn("_salt", F.explode(every_salt))
        .drop("_salts", copies)
    )
    return salted_rows.join(salted_lookup, [on, "_salt"], "left").drop("_salt")
