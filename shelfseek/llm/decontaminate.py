"""Benchmark decontamination: find passages of test items in training texts, cut them out or drop the texts.

Test items become normalised windows of consecutive words. A hash set of the windows goes to every task, which
scans the word windows of its texts against it and compares each hit's words with the item's. No training row is
shuffled. The set is broadcast in parts of at most ``part_bytes``; a benchmark larger than that is scanned part by
part, and what the parts find is put together from a stored table.

Defined results: a null or empty text has no words, no hits and the hash of an empty list; a null item text has no
windows; a null item id counts as the empty string; repeated items and repeated rows are each handled as they
stand; an empty benchmark marks nothing. Only the named columns are read, other columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfseek.llm.text_arrays import ALPHANUMERIC, LOWER, Shared, Words, batch_map, covered, runs, text_bytes, unused
from shelfseek.scratch import stored

WINDOW = 10
#: Most text that one broadcast part of the benchmark is made of.
PART_BYTES = 16 << 20
FILTER_BITS = 20


class WindowSet:
    """Windows of test items by length in words: sorted hashes, and for each the item and the word it begins with."""

    def __init__(self, items: list[tuple[str, str | None]], size: int = WINDOW):
        self.names = [name for name, _ in items]
        data, offsets = text_bytes(pa.array([text for _, text in items], pa.string()))
        self.data = LOWER[data]
        self.words = Words(self.data, offsets, ALPHANUMERIC)
        lengths = np.minimum(self.words.counts, size)
        self.lengths = {}
        for length in sorted(set(lengths.tolist()) - {0}):
            hashes, at = self.words.windows(length)
            own = lengths[self.words.rows[at]] == length
            hashes, at = hashes[own], at[own]
            order = np.argsort(hashes, kind="stable")
            self.lengths[length] = (hashes[order], at[order], leading_bits(hashes))

    def hits(self, data: np.ndarray, words: Words) -> list[tuple[int, int, set[str]]]:
        """(first word, length, items) of each window that occurs, words compared."""
        found = []
        for length, (hashes, places, passing) in self.lengths.items():
            values, at = words.windows(length)
            near = passing[(values >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            values, at = values[near], at[near]
            lo, hi = np.searchsorted(hashes, values), np.searchsorted(hashes, values, side="right")
            for k in np.flatnonzero(hi > lo).tolist():
                text = canonical(data, words, at[k], length)
                items = {
                    self.names[self.words.rows[place]]
                    for place in places[lo[k] : hi[k]]
                    if canonical(self.data, self.words, place, length) == text
                }
                if items:
                    found.append((int(at[k]), length, items))
        return found


def leading_bits(hashes: np.ndarray) -> np.ndarray:
    """Which leading bits occur: spares most windows the search."""
    passing = np.zeros(1 << FILTER_BITS, bool)
    passing[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return passing


def canonical(data: np.ndarray, words: Words, first: int, length: int) -> bytes:
    return b" ".join(data[words.starts[i] : words.ends[i]].tobytes() for i in range(first, first + length))


def benchmark_parts(benchmark: DataFrame, id_col: str, text_col: str, part_bytes: int) -> list[DataFrame]:
    """The items in parts by hash, as many as their measured size asks for."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text")
    )
    items = items.filter(F.octet_length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 64)).first()[0] or 0
    n = int(size // part_bytes) + 1
    if n == 1:
        return [items]
    return [items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def window_sets(benchmark: DataFrame, id_col: str, text_col: str, size: int, part_bytes: int):
    """A broadcast window set for each part, one after the other."""
    context = benchmark.sparkSession.sparkContext
    for part in benchmark_parts(benchmark, id_col, text_col, part_bytes):
        items = [(row["item"], row["text"]) for row in part.collect()]
        yield Shared(context, WindowSet(items, size))


def read_words(column: pa.Array) -> tuple[np.ndarray, Words]:
    data, offsets = text_bytes(column)
    data = LOWER[data]
    return data, Words(data, offsets, ALPHANUMERIC)



def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside any occurrence of a window), hit_spans
    (first word and length of each run of hit words), items (those with occurring windows), contaminated."""
    schema = (
        f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words bigint, "
        "hit_spans array<struct<first: bigint, length: bigint>>, items array<string>"
    )
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = benchmark_parts(benchmark, item_id, item_text, part_bytes)
    if len(parts) > 1:
        # Rows need a number of their own, as ids may be null or repeated; a stored table keeps it fixed.
        narrow = stored(narrow.withColumn("_row", F.monotonically_increasing_id()), "decontaminate")
    scanned = []
    for windows in window_sets(benchmark, item_id, item_text, size, part_bytes):
        if len(parts) == 1:
            scanned.append(batch_map(narrow, scan(windows), schema))
        else:
            scanned.append(stored(batch_map(narrow, scan(windows), schema + ", _row bigint"), "decontaminate-part"))
    found = scanned[0]
    if len(parts) > 1:
        for more in scanned[1:]:
            found = found.unionByName(more)
        found = found.groupBy("_row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("hit_spans")).alias("hit_spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        found = found.drop("_row").withColumn("hit_spans", merged_spans(F.col("hit_spans")))
    hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda total, span: total + span["length"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), "hit_spans", "items", (hit > 0).alias("contaminated"))


def merged_spans(spans):
    """Spans from several parts, overlapping and touching ones joined."""
    empty = F.expr("CAST(array() AS array<struct<first: bigint, length: bigint>>)")

    def add(done, span):
        last = F.element_at(done, -1)
        end = last["first"] + last["length"]
        grown = F.struct(
            last["first"].alias("first"),
            (F.greatest(end, span["first"] + span["length"]) - last["first"]).alias("length"),
        )
        touching = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["first"] + F.try_element_at(done, F.lit(-1))["length"] >= span["first"])
        return F.when(touching, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def scan(windows):
    def work(batch: pa.RecordBatch) -> pa.Table:
        data, words = read_words(batch["text"])
        hits = windows.value.hits(data, words)
        spans: list[list] = [[] for _ in range(batch.num_rows)]
        items: list[set[str]] = [set() for _ in range(batch.num_rows)]
        first = np.array([h[0] for h in hits], np.int64)
        length = np.array([h[1] for h in hits], np.int64)
        for at, _, names in hits:
            items[words.rows[at]] |= names
        mask = covered(first, first + length, len(words.hashes))
        for start, end in zip(*runs(mask, words.rows), strict=True):
            row = words.rows[start]
            spans[row].append({"first": start - words.first[row], "length": end - start})
        columns = {
            "doc_id": batch["doc_id"],
            "n_words": pa.array(words.counts, pa.int64()),
            "hit_spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("length", pa.int64())]))),
            "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        }
        if "_row" in batch.schema.names:
            columns["_row"] = batch["_row"]
        return pa.table(columns)

    return work


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    drop: bool = True,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``docs``, all columns, without the texts that hold a window (``drop``), or with each run of hit words cut out
    of its text, from the run's first byte to its last, hits judged on the text as given."""
    schema = docs.schema
    cuts = unused("_cuts", docs.columns)
    marks = docs if drop else docs.withColumn(cuts, F.expr("CAST(array() AS array<bigint>)"))
    for k, windows in enumerate(window_sets(benchmark, item_id, item_text, size, part_bytes)):
        if k:
            marks = stored(marks, "decontaminate")
        marks = batch_map(marks, dropping(windows, text) if drop else marking(windows, text, cuts), marks.schema, text)
    return marks if drop else batch_map(marks, cutting(text, cuts), schema, text)


def dropping(windows, text: str):
    def work(batch: pa.RecordBatch) -> pa.Table:
        data, words = read_words(batch[text])
        hit = np.zeros(batch.num_rows, bool)
        hit[[words.rows[at] for at, _, _ in windows.value.hits(data, words)]] = True
        return pa.table(batch).filter(pa.array(~hit))

    return work


def marking(windows, text: str, cuts: str):
    """Adds the byte positions of each run of hit words to the column of cuts: first, end, first, end, ..."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        data, words = read_words(batch[text])
        _, offsets = text_bytes(batch[text])
        hits = windows.value.hits(data, words)
        first = np.array([h[0] for h in hits], np.int64)
        mask = covered(first, first + np.array([h[1] for h in hits], np.int64), len(words.hashes))
        found = batch[cuts].to_pylist()
        for start, end in zip(*runs(mask, words.rows), strict=True):
            row = words.rows[start]
            found[row] = found[row] + [words.starts[start] - offsets[row], words.ends[end - 1] - offsets[row]]
        place = batch.schema.get_field_index(cuts)
        return pa.table(batch).set_column(place, cuts, pa.array(found, pa.list_(pa.int64())))

    return work


def cutting(text: str, cuts: str):
    def work(batch: pa.RecordBatch) -> pa.Table:
        table = pa.table(batch)
        column = batch[text]
        texts, spans = column.to_pylist(), batch[cuts].to_pylist()
        for row, own in enumerate(spans):
            if own:
                raw = texts[row].encode()
                keep = ~covered(np.array(own[::2]), np.array(own[1::2]), len(raw))
                texts[row] = np.frombuffer(raw, np.uint8)[keep].tobytes().decode()
        place = table.schema.get_field_index(text)
        return table.set_column(place, text, pa.array(texts, column.type)).drop_columns([cuts])

    return work


def op1(spark, sf_dir: str) -> DataFrame:
    found = contamination(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    names = F.array_sort("items")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        "contaminated",
    )
