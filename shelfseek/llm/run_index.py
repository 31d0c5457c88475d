"""Removal of long repeated passages with a run-length index over the repetitive part of a corpus.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere else is removed, exactly.

1. Windows of LENGTH bytes are routed by content: a window's anchor is the gram of ``GRAM`` bytes with the smallest
   hash in it. Equal windows have equal anchors at the same place, and one anchor serves a run of windows; the bytes
   of that run are the anchor's context (less than 2 * LENGTH bytes).
2. Anchors are counted by gram and by context, combined before the shuffle. A gram found once cannot repeat. A
   context found twice or more repeats as a whole: all its windows are marked at once, whatever their number.
3. What is left are contexts found once whose gram has others: the edges of shared passages. The distinct contexts of
   a gram meet in one task, as a few MB of text of which a run-compressed Burrows-Wheeler transform is built. The
   suffixes at the ends of its runs are kept with their exact common prefix; between them the longest match
   elsewhere is one shorter from one position to the next, so the matching statistics stream along the text from one
   sampled run end to the next. Windows whose statistic reaches LENGTH are marked.
4. Grams with more than ``BUCKET_BYTES`` of distinct contexts are split before they meet: their windows' places
   before the anchor are cut into halves, and contexts of a half part ways by the bytes all windows of that half
   share. A part whose shared bytes are found once is settled, one whose contexts are equal too. After at most
   log2(2 * LENGTH) halvings a part is one window. Nothing is capped or dropped.

Defined results: null texts count as empty; texts shorter than LENGTH keep all bytes; equal rows count as occurrences
of each other; ids are passed through, null and repeated ones too; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfseek.llm.text_arrays import BASE, BASE_INVERSE, batch_map, covered, mixed, powers, rows_of, span_hashes, text_bytes
from shelfseek.scratch import stored

LENGTH = 400
GRAM = 64
BUCKET_BYTES = 4 << 20
#: Contexts indexed together, about.
INDEX_BYTES = 1 << 20
PLACES = 1 << (LENGTH - 1).bit_length()
STEP = 1 << 16

ANCHORS = "array<struct<gram: bigint, context: bigint, anchor: int, first: int, last: int>>"


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The anchors of all windows inside one text: gram hash, position, first and last window start it serves."""
    grams = LENGTH - GRAM + 1
    up, down = powers(BASE, STEP + LENGTH + grams), powers(BASE_INVERSE, STEP + LENGTH + grams)
    found: list[tuple[np.ndarray, ...]] = []
    low = np.uint64((1 << 18) - 1)
    n_starts = len(data) - LENGTH + 1
    ends = np.unique(offsets[1:])
    with np.errstate(over="ignore"):
        for lo in range(0, max(n_starts, 0), STEP):
            hi = min(lo + STEP, n_starts)
            piece = data[lo : hi + LENGTH - 1].astype(np.uint64) + np.uint64(1)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece * up[: len(piece)])])
            hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(piece) - GRAM + 1])
            # The place in the low bits: the leftmost of equal hashes is the smallest.
            keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
            place = (sliding_least(keys, grams) & low).astype(np.int64)
            # Windows that would reach into the next text.
            inside = np.ones(hi - lo, bool)
            for end in ends[np.searchsorted(ends, lo, side="right") : np.searchsorted(ends, hi + LENGTH - 1)].tolist():
                inside[max(0, end - LENGTH + 1 - lo) : max(0, end - lo)] = False
            starts, place = np.flatnonzero(inside) + lo, place[inside]
            if len(starts):
                cut = np.flatnonzero(np.diff(place)) + 1
                first = np.concatenate([[0], cut])
                last = np.concatenate([cut, [len(place)]]) - 1
                found.append((hashes[place[first]], place[first] + lo, starts[first], starts[last]))
    if not found:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    gram, at, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
    # An anchor's windows may go on in the next piece.
    new = np.concatenate([[True], np.diff(at) != 0])
    ends = np.flatnonzero(np.concatenate([new[1:], [True]]))
    return gram[new], at[new], first[new], last[ends]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def sketch(batch: pa.RecordBatch) -> pa.Table:
    """Size, hash and anchors of each text. Positions are bytes from the text's beginning."""
    data, offsets = text_bytes(batch["text"])
    gram, at, first, last = anchors(data, offsets)
    with np.errstate(over="ignore"):
        shape = ((at - first).astype(np.uint64) << np.uint64(20)) + (last - first).astype(np.uint64)
        context = mixed(span_hashes(data, first, last + LENGTH) + mixed(shape))
    row = rows_of(first, offsets)
    begins = offsets[row]
    per_row = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
    fields = {
        "gram": gram.view(np.int64),
        "context": context.view(np.int64),
        "anchor": (at - begins).astype(np.int32),
        "first": (first - begins).astype(np.int32),
        "last": (last - begins).astype(np.int32),
    }
    struct = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], names=list(fields))
    return pa.table(
        {
            "doc_id": batch["doc_id"],
            "t": batch["t"],
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "sha256": [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)],
            "anchors": pa.ListArray.from_arrays(pa.array(per_row), struct),
        }
    )


def keyed_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(content).alias("t"), content.alias("text"))


def spread_contexts(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """The bytes of each given context, (key, context, t, anchor, first, last, n, bytes), once or for several copies
    of its text."""
    wanted = classes.groupBy("t").agg(F.collect_list(F.struct("gram", "context", "anchor", "first", "last", "n")).alias("wanted"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, done = [], set()
        for t, text, spans in zip(*(batch[c].to_pylist() for c in ("t", "text", "wanted")), strict=True):
            # Copies of a text give the same contexts.
            if t in done:
                continue
            done.add(t)
            raw = text.encode()
            rows += [
                (s["gram"], s["context"], t, s["anchor"], s["first"], s["last"], s["n"], raw[s["first"] : s["last"] + LENGTH])
                for s in spans
            ]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
        names = ["key", "context", "t", "anchor", "first", "last", "n", "bytes"]
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "key bigint, context bigint, t bigint, anchor int, first int, last int, n bigint, bytes binary"
    return batch_map(texts.select("t", "text").join(wanted, "t"), work, schema)


def split_large(contexts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Contexts in groups (``key``) of at most BUCKET_BYTES, and the windows that splitting has settled as repeated.

    Each halving restricts a context to the windows that start in one half of the places before the anchor."""
    sizes = contexts.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("_size"))
    sized = contexts.join(sizes, "key")
    small = sized.filter(F.col("_size") <= BUCKET_BYTES).drop("_size")
    large = sized.filter(F.col("_size") > BUCKET_BYTES).drop("_size")
    if large.isEmpty():
        return contexts, None
    large = large.dropDuplicates(["key", "context"])
    groups, settled = small.drop("_low"), None
    large = large.withColumn("_low", F.lit(0))
    width = PLACES
    while width > 1 and not large.isEmpty():
        width //= 2
        # Windows by how far they start before the anchor: last is nearest.
        low = F.explode(F.array(F.col("_low"), F.col("_low") + width))
        halves = large.withColumn("_half", low)
        first = F.greatest(F.col("first"), F.col("anchor") - F.col("_half") - (width - 1))
        last = F.least(F.col("last"), F.col("anchor") - F.col("_half"))
        cut = halves.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
        size = F.col("_last") - F.col("_first") + LENGTH
        cut = cut.withColumn("bytes", F.substring("bytes", F.col("_first") - F.col("first") + 1, size))
        # What every window of the half holds, from its last start to its first end.
        begin = F.col("anchor") - F.col("_half") - F.col("_first") + 1
        shared = F.substring("bytes", begin, F.lit(LENGTH - (width - 1)))
        parts = cut.select(
            F.xxhash64("key", "_half", shared).alias("key"),
            F.xxhash64(F.col("anchor") - F.col("_first"), "bytes").alias("context"),
            "t", "anchor", F.col("_first").alias("first"), F.col("_last").alias("last"), "n", "bytes", F.col("_half").alias("_low"),
        )
        parts = stored(parts, "run-index-parts")
        per = parts.groupBy("key", "context").agg(F.sum("n").alias("n"), F.count("*").alias("_members"), F.first("t").alias("_t"), F.first("anchor").alias("_anchor"))
        per = stored(per, "run-index-classes")
        repeated = per.filter("_members > 1").select("key", "context")
        marks = parts.join(repeated, ["key", "context"]).select("t", "first", "last")
        settled = marks if settled is None else settled.union(marks)
        by_key = per.groupBy("key").agg(F.count("*").alias("_classes"), F.min("n").alias("_least"))
        open_keys = by_key.filter("_classes > 1 AND _least = 1").select("key")
        chosen = per.join(open_keys, "key").select("key", "context", F.col("n").alias("_n"), F.col("_t").alias("t"), F.col("_anchor").alias("anchor"))
        left = parts.join(chosen, ["key", "context", "t", "anchor"]).withColumn("n", F.col("_n")).drop("_n")
        sizes = left.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("_size"))
        sized = stored(left.join(sizes, "key"), "run-index-left")
        groups = groups.unionByName(sized.filter(F.col("_size") <= BUCKET_BYTES).drop("_size", "_low"))
        large = sized.filter(F.col("_size") > BUCKET_BYTES).drop("_size")
    return groups, settled


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of several strings, each closed by a symbol of its own.

    ``head``, ``start`` and ``length`` are the runs' symbols, first rows and lengths; ``first`` and ``last`` sample
    the text positions of the suffixes at each run's ends, ``common`` the length of the prefix that the suffix at a
    run's beginning shares with the one before it.
    """

    def __init__(self, strings: list[bytes]):
        n = len(strings)
        closing = np.cumsum([len(s) + 1 for s in strings]) - 1
        symbols = np.empty(int(closing[-1]) + 1, np.int64)
        inside = np.ones(len(symbols), bool)
        inside[closing] = False
        symbols[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + n
        symbols[closing] = np.arange(n)
        self.begins = np.concatenate([[0], closing[:-1] + 1])
        self.size = len(symbols)
        order, ranks = sorted_suffixes(symbols)
        before = symbols[order - 1]
        self.start = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.head = before[self.start]
        self.length = np.diff(np.concatenate([self.start, [self.size]]))
        self.first, self.last = order[self.start], order[self.start + self.length - 1]
        self.common = np.concatenate([[0], common_prefix(ranks, self.last[:-1], self.first[1:])])

    def matching_statistics(self) -> np.ndarray:
        """For each text position, the length of the longest match that starts elsewhere.

        A suffix inside a run keeps its neighbour when the text is read one position further, and loses one symbol of
        the match; only a suffix at a run's end finds a new neighbour, whose common prefix is sampled."""
        above = streamed(self.first, self.common, self.size)
        below = streamed(self.last, np.concatenate([self.common[1:], [0]]), self.size)
        return np.maximum(above, below)


def streamed(positions: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    sample = np.zeros(n, np.int64)
    known = np.zeros(n, np.int64)
    sample[positions] = positions
    known[positions] = lengths
    at = np.maximum.accumulate(sample)
    return np.maximum(known[at] - (np.arange(n) - at), 0)


def sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The suffixes in order, and for widths 1, 2, 4, ... the rank of each position's next symbols.

    Ranks of doubled widths come from pairs of ranks; closing symbols are unique, so all suffixes end up apart."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    ranks, width = [(1, rank.astype(np.int32))], 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - width] = rank[width:] + 1
        keys = rank.astype(np.int64) * (n + 1) + follow
        order = np.argsort(keys)
        ordered = keys[order]
        steps = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = steps
        width *= 2
        if steps[-1] == n - 1:
            return order, ranks
        ranks.append((width, rank.astype(np.int32)))


def common_prefix(ranks: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, from the ranks of widths that are powers of two."""
    total = np.zeros(len(a), np.int64)
    n = len(ranks[0][1])
    for width, rank in reversed(ranks):
        x, y = a + total, b + total
        inside = (x < n) & (y < n)
        equal = inside & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
        total[equal] += width
    return total


def index_marks(groups: DataFrame) -> DataFrame:
    """(t, begin, end) of the bytes that the index marks in contexts found once."""
    dealt = groups.select("key", "context", "t", "first", "n", "bytes").repartition("key")
    dealt = dealt.sortWithinPartitions("key", "context")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, previous = [], 0, (None, None)
        for batch in batches:
            for key, context, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, context) == previous:
                    continue
                if key != previous[0] and size >= INDEX_BYTES:
                    yield marked(held)
                    held, size = [], 0
                previous = (key, context)
                held.append(row)
                size += len(row[-1])
        if held:
            yield marked(held)

    return dealt.mapInArrow(run, "t bigint, begin int, end int")


def marked(rows: list[tuple]) -> pa.RecordBatch:
    index = RunIndex([row[-1] for row in rows])
    repeated = index.matching_statistics() >= LENGTH
    ts, begins, ends = [], [], []
    for (t, first, n, raw), begin in zip(rows, index.begins.tolist(), strict=True):
        if n == 1:
            at = np.flatnonzero(repeated[begin : begin + len(raw)])
            if len(at):
                cut = np.flatnonzero(np.diff(at) > LENGTH) + 1
                for part in np.split(at, cut):
                    ts.append(t)
                    begins.append(first + int(part[0]))
                    ends.append(first + int(part[-1]) + LENGTH)
    return pa.RecordBatch.from_arrays(
        [pa.array(ts, pa.int64()), pa.array(begins, pa.int32()), pa.array(ends, pa.int32())], names=["t", "begin", "end"]
    )


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per row doc_id, t (its text's hash), n_bytes and sha256; per t the spans of repeated bytes."""
    texts = keyed_texts(docs, doc_id, text)
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, t bigint, n_bytes bigint, sha256 string, anchors {ANCHORS}"
    rows = stored(batch_map(texts, sketch, schema), "run-index-sketches")
    # Equal texts once, with their number.
    counts = rows.groupBy("t").agg(F.count("*").alias("w"))
    once = rows.groupBy("t").agg(F.first("anchors").alias("anchors")).join(counts, "t")
    found = stored(once.select("t", "w", F.inline("anchors")), "run-index-anchors")

    classes = stored(
        found.groupBy("gram", "context").agg(
            F.sum("w").alias("n"),
            F.first("t").alias("t"),
            F.first("anchor").alias("anchor"),
            F.first("first").alias("first"),
            F.first("last").alias("last"),
        ),
        "run-index-classes",
    )
    whole = classes.filter("n > 1").select("gram", "context")
    spans = found.join(whole, ["gram", "context"]).select("t", F.col("first").alias("begin"), (F.col("last") + LENGTH).alias("end"))

    by_gram = classes.groupBy("gram").agg(F.count("*").alias("m"), F.min("n").alias("least"))
    open_grams = by_gram.filter("m > 1 AND least = 1").select("gram")
    edges = spread_contexts(texts, classes.join(open_grams, "gram"))
    groups, settled = split_large(stored(edges, "run-index-contexts"))
    spans = spans.union(index_marks(groups))
    if settled is not None:
        spans = spans.union(settled.select("t", F.col("first").alias("begin"), (F.col("last") + LENGTH).alias("end")))
    per_text = spans.groupBy("t").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return rows.drop("anchors"), per_text


def removal(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay, null where nothing was removed), sha256 of
    the whole text; one row per row of ``docs``."""
    rows, per_text = repeated_spans(docs, doc_id, text)
    per_text = stored(per_text, "run-index-spans")
    texts = keyed_texts(docs, doc_id, text).join(per_text, "t")

    def work(batch: pa.RecordBatch) -> pa.Table:
        removed, spans_, kept = [], [], []
        for raw, spans in zip(batch["text"].cast(pa.large_binary()).to_pylist(), batch["spans"], strict=True):
            begins = spans.values.field("begin").to_numpy()
            ends = spans.values.field("end").to_numpy()
            gone = covered(begins, ends, len(raw))
            removed.append(int(gone.sum()))
            spans_.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
        return pa.table(
            {
                "doc_id": batch["doc_id"],
                "n_bytes": pa.array([len(x) for x in batch["text"].cast(pa.large_binary()).to_pylist()], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans_, pa.int64()),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    cut = batch_map(texts.select("doc_id", "text", "spans"), work, schema).withColumn("sha256", F.lit(None).cast("string"))
    zero = F.lit(0).cast("bigint")
    untouched = rows.join(per_text.select("t"), "t", "left_anti").select(
        "doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.lit(None).cast("binary").alias("kept"), "sha256"
    )
    return cut.unionByName(untouched)


def op4(spark, sf_dir: str) -> DataFrame:
    found = removal(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.coalesce("sha256", F.sha2("kept", 256)).alias("kept_sha256")
    )
