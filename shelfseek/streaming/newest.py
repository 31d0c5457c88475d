"""Late versions dropped from a stream before anything is made of them.

The newest version seen of each product is kept as state of the stream: three numbers for each, for good or for a time
after the last change. A message passes if it is newer than all that came before it; of one micro-batch several of a
product may pass, as they come in pieces, and the writer keeps the newest. The state is
part of the checkpoint, so a stream that starts again goes on with it. Messages without an asin pass as they are and keep
no state.

Products are dealt to a fixed number of groups by a hash of their asin, and a group's versions are one list of the state: a
micro-batch calls Python, and reads and writes the state, once for each group it touches and not for each product.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfseek.functions.records import json_field, json_text, parse_object

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Groups of products that share a list of versions; part of a checkpoint, so a fixed value. With a million products a list has
# about 250 entries.
GROUPS = 4096

VERSIONS = "asin string, micros bigint, partition int, offset bigint, changed bigint"
MESSAGES = "value string, topic string, partition int, offset bigint, micros bigint"


class NewestVersion(StatefulProcessor):
    """Passes those of a group's messages that are newer than all before of their asin."""

    def __init__(self, keep_seconds: int | None):
        self.keep_ms = keep_seconds * 1000 if keep_seconds else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", VERSIONS, self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        columns = [c.split(" ")[0] for c in MESSAGES.split(", ")]
        now = timer_values.getCurrentProcessingTimeInMs() if self.keep_ms else 0
        # A list is written as a whole, so each version says itself when it was changed last.
        best = {r[0]: tuple(r[1:]) for r in self.seen.get() if not self.keep_ms or r[4] + self.keep_ms > now}
        changed = False
        for part in rows:
            newest = {}
            versions = zip(*(part[c].tolist() for c in ("asin", "micros", "partition", "offset")), strict=True)
            for at, (asin, *version) in enumerate(versions):
                if asin is None:
                    newest[None, at] = at
                elif asin not in best or tuple(version) > best[asin][:3]:
                    newest[asin], best[asin], changed = at, (*version, now), True
            if newest:
                yield part.iloc[sorted(newest.values())][columns]
        if changed:
            self.seen.put([(asin, *version) for asin, version in best.items()])

    def close(self) -> None:
        pass


def newest_messages(messages: DataFrame, keep_seconds: int | None = None) -> DataFrame:
    """The messages of a stream that are newer than every earlier one of their asin; versions are compared by time, then
    partition, then offset. With ``keep_seconds``, for streams that run on, a product's state ends that long after its last
    change; a late version that comes after that passes, and is left out when it is merged. (Spark goes on with empty
    micro-batches while state can end, so a stream that reads what is there and stops must keep it.)"""
    spark = messages.sparkSession
    if spark.conf.get(STATE_STORE, None) != ROCKS_DB:
        raise ValueError(f"keyed state needs {STATE_STORE}={ROCKS_DB}")
    asin = json_text(json_field(parse_object(F.col("value")), "asin"))
    numbered = messages.select(
        asin.alias("asin"),
        F.pmod(F.xxhash64(F.coalesce(asin, F.col("value"))), F.lit(GROUPS)).alias("group"),
        "value",
        "topic",
        F.coalesce("partition", F.lit(0)).alias("partition"),
        F.coalesce("offset", F.lit(0).cast("bigint")).alias("offset"),
        F.unix_micros("timestamp").alias("micros"),
    )
    passed = numbered.groupBy("group").transformWithStateInPandas(
        NewestVersion(keep_seconds), MESSAGES, outputMode="Append", timeMode="ProcessingTime" if keep_seconds else "None"
    )
    return passed.select("value", "topic", "partition", "offset", F.timestamp_micros("micros").alias("timestamp"))
