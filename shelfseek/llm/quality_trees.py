"""Quality rules: counted statistics of a text, fixed rules on them, and boosted trees where the rules don't decide.

The trees are fitted on the driver from the statistics of a bounded sample of labelled rows (``MAX_LABELLED``); every
row of the corpus is counted and scored in Arrow batches, without a shuffle. Chosen features are constrained: more
symbols, repeated lines or repeated words never raise a score. Fitted trees are flat numpy arrays of nodes, walked
for all rows of a batch at once.

Defined results: a null or empty text has no words, so the base rules fail it; null ids pass through; repeated rows
are each scored; without labelled rows of both classes the trees pass everything that the base rules pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfseek.llm.text_arrays import (
    NOT_WHITE,
    Shared,
    Words,
    batch_map,
    counts_by_row,
    covered,
    found_twice,
    row_keys,
    spans,
    span_hashes,
    sums_by_row,
    text_bytes,
)

#: At most so many labelled rows are fitted, taken by the hash of their id.
MAX_LABELLED = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3


def byte_class(chars: str) -> np.ndarray:
    return np.array([chr(b) in chars and b < 0x80 for b in range(256)])


CODE_POINT = np.array([b & 0xC0 != 0x80 for b in range(256)])
SYMBOL = byte_class("#*$%&|<>")
CLASSES = {
    "upper_share": np.array([0x41 <= b <= 0x5A for b in range(256)]),
    "digit_share": np.array([0x30 <= b <= 0x39 for b in range(256)]),
    "stop_share": byte_class(".,;:"),
    "mark_share": byte_class("!?@/\\=_^~`{}[]()+\"'-"),
    "line_share": byte_class("\n"),
}
NOT_NEWLINE = ~byte_class("\n")

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("words_log", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", *CLASSES)
#: A larger value never raises (-1) the score.
MONOTONIC = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1}


def statistics(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts of each text, and the features of the trees as a matrix."""
    data, offsets = text_bytes(column)
    words = Words(data, offsets, NOT_WHITE)
    points, symbols, *classes = counts_by_row(data, offsets, CODE_POINT & NOT_WHITE, SYMBOL, *CLASSES.values())

    starts, ends = spans(data, offsets, NOT_NEWLINE)
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[worded], ends[worded]
    first_line = np.searchsorted(starts, offsets)
    n_lines = np.diff(first_line)
    line_rows = np.repeat(np.arange(len(n_lines)), n_lines)
    lines = row_keys(span_hashes(data, starts, ends), line_rows)
    _, earliest = np.unique(lines, return_index=True)
    dup_lines = n_lines - np.bincount(line_rows[earliest], minlength=len(n_lines))

    hashes, at = words.windows(WINDOW)
    at = at[found_twice(row_keys(hashes, words.rows[at]))]
    repeated = sums_by_row(covered(at, at + WINDOW, len(words.hashes)), words.first)
    again = found_twice(row_keys(words.hashes, words.rows))
    once = sums_by_row(~again, words.first)

    base = dict(zip(BASE, (words.counts, points, symbols, dup_lines, repeated), strict=True))
    n, size = np.maximum(words.counts, 1), np.maximum(np.diff(offsets), 1)
    features = [np.log1p(words.counts), points / n, symbols / n, dup_lines / np.maximum(n_lines, 1), repeated / n, once / n]
    return base, np.column_stack([*features, *(c / size for c in classes)]).astype(np.float64)


def base_failed(base: dict[str, np.ndarray]) -> np.ndarray:
    n = base["n_words"]
    return (n < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


@dataclass
class Trees:
    """All nodes of all trees: a leaf has itself as both children and adds ``value``."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the label 1 for each row."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.start)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the label 1 for each row."""
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, smooth: float = 2.0
) -> Trees:
    """Boosted trees for the logistic loss, split on histograms of at most ``bins`` quantiles a feature."""
    signs = [MONOTONIC.get(name, 0) for name in FEATURES]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(edges[f], x[:, f]) for f in range(x.shape[1])])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(y), start)
    nodes: list[list] = []
    roots = []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + smooth), low, high))

    def gain(g, h):
        return g * g / (h + smooth)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(nodes)
        here = leaf(g[rows].sum(), h[rows].sum(), low, high)
        nodes.append([0, np.inf, me, me, rate * here])
        if level == depth or len(rows) < 20:
            return me
        best = (1e-6, None)
        for f, cut in enumerate(edges):
            if not len(cut):
                continue
            gs = np.cumsum(np.bincount(binned[rows, f], g[rows], len(cut) + 1))
            hs = np.cumsum(np.bincount(binned[rows, f], h[rows], len(cut) + 1))
            gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
            won = gain(gl, hl) + gain(gr, hr) - gain(gs[-1], hs[-1])
            wl, wr = np.clip(-gl / (hl + smooth), low, high), np.clip(-gr / (hr + smooth), low, high)
            won[(hl < 1) | (hr < 1) | (signs[f] * (wr - wl) < 0)] = 0
            k = int(np.argmax(won))
            if won[k] > best[0]:
                best = (won[k], (f, k, (wl[k] + wr[k]) / 2))
        if best[1] is None:
            return me
        f, k, middle = best[1]
        goes_left = binned[rows, f] <= k
        bounds = [(low, high), (low, high)]
        if signs[f]:
            bounds = [(low, middle), (middle, high)] if signs[f] > 0 else [(middle, high), (low, middle)]
        a = grow(rows[goes_left], g, h, level + 1, *bounds[0])
        b = grow(rows[~goes_left], g, h, level + 1, *bounds[1])
        nodes[me][:4] = [f, edges[f][k], a, b]
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
        total += flat(nodes, roots[-1:], depth, 0.0).margin(x)
    return flat(nodes, roots, depth, start)


def flat(nodes: list[list], roots: list[int], depth: int, start: float) -> Trees:
    columns = list(zip(*nodes, strict=True)) if nodes else [[], [], [], [], []]
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Trees(np.array(roots, np.int64), *(np.array(c, k) for c, k in zip(columns, kinds, strict=True)), depth, start)


def labelled_statistics(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, limit: int
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``limit`` labelled rows, those whose ids hash lowest."""
    own = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
    own = own.filter("_id IS NOT NULL AND _label IS NOT NULL").dropDuplicates(["_id"])
    sample = own.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    # At most ``limit`` ids and labels: small whatever the corpus.
    joined = texts.join(F.broadcast(sample), "_id")

    def work(batch: pa.RecordBatch) -> pa.Table:
        _, x = statistics(batch["_text"])
        return pa.table({"x": pa.array(list(x), pa.list_(pa.float64())), "label": batch["_label"], "id": batch["_id"]})

    rows = batch_map(joined, work, f"x array<double>, label int, id {docs.schema[doc_id].dataType.simpleString()}", "_text")
    # Sorted, so that the fit does not depend on how the rows were dealt out; repeated ids count once.
    found = rows.dropDuplicates(["id"]).orderBy("id").toArrow()
    x = np.array(found["x"].to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return x, found["label"].to_numpy().astype(np.float64)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    limit: int = MAX_LABELLED,
) -> Trees:
    x, y = labelled_statistics(docs, labels, doc_id, text, label, limit)
    if len(y) == 0 or y.min() == y.max():
        return flat([], [], 0, 10.0)
    return fit(x, y)


def assess(docs: DataFrame, trees: Trees, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, score (probability of good quality) and kept, for each row."""
    model = Shared(docs.sparkSession.sparkContext, trees)
    schema = (
        f"doc_id {docs.schema[doc_id].dataType.simpleString()}, "
        + ", ".join(f"{name} bigint" for name in BASE)
        + ", base_failed boolean, score double, kept boolean"
    )

    def work(batch: pa.RecordBatch) -> pa.Table:
        base, x = statistics(batch["text"])
        failed, score = base_failed(base), model.value.score(x)
        return pa.table(
            {"doc_id": batch["doc_id"]}
            | {name: pa.array(values, pa.int64()) for name, values in base.items()}
            | {"base_failed": failed, "score": score, "kept": ~failed & (score >= threshold)}
        )

    return batch_map(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), work, schema)


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # A fifth of the labels stays out of the fit, for measuring it.
    labels = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    return assess(docs, fit_quality(docs, labels))
