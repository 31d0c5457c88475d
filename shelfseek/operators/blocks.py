"""Score a table of questions against the collection, block by block.

A block is some documents and some questions. Scoring a block keeps the best rows per question, so
the scored pairs never become rows. Two ways to form blocks:

* the questions' size is measured; while it is within ``broadcast_bytes`` they go to every task, and
  documents are scored where they are read, without a shuffle;
* beyond that, documents and questions meet by key (a brand, an LSH bucket). A key is cut into blocks on both
  sides, so one very frequent key is spread like any other: into as many as its rows need, but into more than its
  share of ``pieces`` only where a block's side would pass ``most_bytes``. So a row is copied, and a question has
  results, a bounded number of times, and beyond that once for each ``most_bytes`` of the other side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfseek.functions.text import row_numbers
from shelfseek.operators.salting import salted_left_join
from shelfseek.scratch import stored

Kernel = Callable[[pa.Table, pa.Table], pa.Table]

# Documents that meet broadcast questions at once.
BLOCK_BYTES = 32 << 20
# Pairs that a block holds until they are compared with its best again.
MAX_HELD = 1 << 22
# Keys that may stand in a filter as literals.
MAX_LITERAL_KEYS = 200


@dataclass(frozen=True)
class BlockSizes:
    broadcast_bytes: int = 64 << 20
    documents: int = 4096
    questions: int = 256
    pieces: int = 16
    most_bytes: int = 32 << 20


@dataclass(frozen=True)
class QuestionSize:
    rows: int
    bytes: int


def measure(queries: DataFrame, bytes_each: Column) -> QuestionSize:
    """How many queries there are and how much memory they may take, at most, as questions."""
    total = F.coalesce(F.sum(bytes_each), F.lit(0))
    return QuestionSize(*queries.agg(F.count("*"), total).first())


def score_blocks(
    documents: DataFrame,
    questions: DataFrame,
    size: QuestionSize,
    kernel: Kernel,
    result_schema: str,
    document_keys: Column,
    question_keys: Column,
    sizes: BlockSizes = BlockSizes(),
) -> DataFrame:
    """Best rows per question and block. ``document_keys`` and ``question_keys`` are arrays; a pair is
    in some block if they share a key, and in several if they share several."""
    if size.bytes <= sizes.broadcast_bytes:
        asked = questions.withColumn("_keys", question_keys).toArrow()
        possible = documents.filter(_askable(asked, document_keys))
        return _broadcast(possible, asked.drop_columns("_keys"), kernel, result_schema)
    kept = stored(questions, "questions")
    row_bytes = -(-size.bytes // max(size.rows, 1))
    return meet_by_key(documents, kept, kernel, result_schema, document_keys, question_keys, sizes, row_bytes)


def _askable(questions: pa.Table, document_keys: Column) -> Column:
    """Documents that some question may want: in the widest price range, which reaches the scan, and
    with one of the keys if those are few. The rest need not be sent to Python."""
    low, high = pc.min(questions["min_price"]).as_py(), pc.max(questions["max_price"]).as_py()
    wanted = F.col("estimated_price").between(F.lit(low), F.lit(high))
    keys = [key for key in pc.unique(pc.list_flatten(questions["_keys"])).to_pylist() if key is not None]
    if len(keys) <= MAX_LITERAL_KEYS:
        kind = "bigint" if keys and isinstance(keys[0], int) else "string"
        wanted &= F.arrays_overlap(document_keys, F.lit(keys).cast(f"array<{kind}>"))
    return wanted


def _broadcast(documents: DataFrame, questions: pa.Table, kernel: Kernel, schema: str) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(questions)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A block is as many batches as fit, so that few results leave a task.
        held, taken = [], 0
        for batch in batches:
            held.append(batch)
            taken += batch.nbytes
            if taken >= BLOCK_BYTES:
                yield from kernel(pa.Table.from_batches(held), shared.value).to_batches()
                held, taken = [], 0
        if held:
            yield from kernel(pa.Table.from_batches(held), shared.value).to_batches()

    return documents.mapInArrow(score, schema)


def meet_by_key(
    documents: DataFrame,
    questions: DataFrame,
    kernel: Kernel,
    schema: str,
    document_keys: Column,
    question_keys: Column,
    sizes: BlockSizes,
    row_bytes: int,
) -> DataFrame:
    """``kernel`` for blocks of documents and questions that share a key, each key cut into blocks on both sides, whose
    rows take about ``row_bytes``. ``questions`` is read several times."""
    keyed_documents = documents.withColumn("_key", F.explode(F.array_distinct(document_keys)))
    keyed_questions = questions.withColumn("_key", F.explode(F.array_distinct(question_keys)))
    asked = keyed_questions.groupBy("_key").agg(F.count("*").alias("_asked"))
    held = keyed_documents.groupBy("_key").agg(F.count("*").alias("_held"))
    most = max(1, sizes.most_bytes // max(row_bytes, 1))

    def parts_of(counted: DataFrame, count: str, rows: int) -> Column:
        share = F.col(count) / counted.agg(F.sum(count)).scalar()
        few = F.greatest(F.ceil(sizes.pieces * share), F.ceil(F.col(count) / max(rows, most)))
        return F.when(F.col(count).isNotNull(), F.least(F.ceil(F.col(count) / rows), few)).cast("int")

    question_parts = parts_of(asked, "_asked", sizes.questions).alias("_question_parts")
    document_parts = parts_of(held, "_held", sizes.documents).alias("_document_parts")
    counted = held.join(asked, "_key", "left")
    parts = stored(counted.select("_key", "_held", "_asked", question_parts, document_parts), "parts")
    numbers = ("_question_parts", "_document_parts")

    def part_of(row_id: str, count: str) -> Column:
        return F.pmod(F.xxhash64(row_id), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = (
        salted_left_join(keyed_documents, parts.drop("_asked"), "_key", "_held", "asin")
        .filter(F.col("_question_parts").isNotNull())
        .withColumn("_document_part", part_of("asin", "_document_parts"))
        .withColumn("_question_part", every("_question_parts"))
        .drop(*numbers)
    )
    wanted = parts.filter(F.col("_asked").isNotNull()).drop("_held")
    right = (
        salted_left_join(keyed_questions, wanted, "_key", "_asked", "query_id")
        .filter(F.col("_document_parts").isNotNull())
        .withColumn("_question_part", part_of("query_id", "_question_parts"))
        .withColumn("_document_part", every("_document_parts"))
        .drop(*numbers)
    )
    block = ("_key", "_document_part", "_question_part")
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(kernel, schema)


def best(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows per question, with their ``rank``. Spark applies the limit before the
    shuffle as well as after it."""
    window = Window.partitionBy("query_id").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= limit)


class Filters:
    """Which documents of a block pass a question's price range and brand."""

    def __init__(self, documents: pa.Table, questions: pa.Table):
        n = documents.num_rows
        self.price = documents["estimated_price"].to_numpy()
        self.low = questions["min_price"].to_numpy()
        self.high = questions["max_price"].to_numpy()
        encoded = questions["brand"].combine_chunks().dictionary_encode()
        self.brand = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        tokens = documents["brand_tokens"].combine_chunks()
        found = pc.fill_null(pc.index_in(tokens.flatten(), value_set=encoded.dictionary), -1)
        found = found.to_numpy(zero_copy_only=False)
        self.has_brand = np.zeros((n, len(encoded.dictionary)), dtype=bool)
        self.has_brand[row_numbers(tokens)[found >= 0], found[found >= 0]] = True

    def groups(self) -> list[np.ndarray]:
        """Questions of the same price range and brand."""
        order = np.lexsort((self.high, self.low, self.brand))
        alike = np.stack([self.brand, self.low, self.high])[:, order]
        return np.split(order, np.flatnonzero((alike[:, 1:] != alike[:, :-1]).any(axis=0)) + 1) if len(order) else []

    def passing(self, question: int) -> np.ndarray:
        if self.brand[question] < 0:
            return np.zeros(len(self.price), dtype=bool)
        # NULL prices read as NaN here, and NaN is in no range.
        in_range = (self.price >= self.low[question]) & (self.price <= self.high[question])
        return in_range & self.has_brand[:, self.brand[question]]


def near_best(
    documents: pa.Table,
    questions: pa.Table,
    score: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
    limit: int,
    slack: np.ndarray,
    every: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(question, document, score) of the pairs of a block that pass the filters and whose score is at most ``slack``
    below the question's ``limit``-th best; all that pass for the questions that ``every`` marks.

    ``score(start, rows, asked)`` is the matrix of the documents ``start + rows`` by the questions ``asked``; minus
    infinity is a missing score. Questions of the same filters are compared as one matrix, and each keeps its best
    scores so far, so that of later documents few are looked at.
    """
    marked = np.zeros(questions.num_rows, bool) if every is None else every
    leaders = np.full((questions.num_rows, max(limit, 1)), -np.inf)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    kept = 0
    groups = Filters(documents.slice(0, 0), questions).groups()
    for start, piece in slices(documents, questions):
        filters = Filters(piece, questions)
        for asked in groups:
            rows = np.flatnonzero(filters.passing(asked[0]))
            if not len(rows):
                continue
            scores = score(start, rows, asked)
            floor = leaders[asked].min(axis=1)
            if len(rows) > limit:
                unled = np.flatnonzero(floor == -np.inf)
                if len(unled):
                    floor[unled] = np.partition(scores[:, unled], -limit, axis=0)[-limit]
            least = np.where(marked[asked] | (floor == -np.inf), -np.inf, floor - slack[asked])
            at, to = np.nonzero(scores >= least)
            found = asked[to], start + rows[at], scores[at, to]
            held.append(found)
            kept += len(at)
            raise_leaders(leaders, *found[::2])
            if kept > MAX_HELD:
                held = [still_near(leaders, slack, marked, held)]
                kept = len(held[0][0]) // 2
    return still_near(leaders, slack, marked, held)


def raise_leaders(leaders: np.ndarray, to: np.ndarray, scores: np.ndarray) -> None:
    """Put the best of ``scores`` among the best of their questions."""
    limit = leaders.shape[1]
    to, _, scores = first_of_each(to, to, scores, np.zeros(len(to)), np.full(len(leaders), limit))
    if not len(to):
        return
    met, first, n = np.unique(to, return_index=True, return_counts=True)
    fresh = np.full((len(met), limit), -np.inf)
    fresh[np.repeat(np.arange(len(met)), n), np.arange(len(to)) - np.repeat(first, n)] = scores
    leaders[met] = np.partition(np.concatenate([leaders[met], fresh], axis=1), limit, axis=1)[:, limit:]


def still_near(leaders: np.ndarray, slack: np.ndarray, marked: np.ndarray, held: list[tuple]) -> tuple:
    to, at, scores = [np.concatenate(x) for x in zip(*held, strict=True)] if held else (np.empty(0, int), np.empty(0, int), np.empty(0))
    floor = leaders.min(axis=1)
    least = np.where(marked | (floor == -np.inf), -np.inf, floor - slack)
    near = scores >= least[to]
    return to[near], at[near], scores[near]


def first_of_each(to: np.ndarray, at: np.ndarray, scores: np.ndarray, ranks: np.ndarray, most: np.ndarray) -> tuple:
    """The first ``most`` of each question by falling score, then rank."""
    order = np.lexsort((ranks, -scores, to))
    to, at, scores = to[order], at[order], scores[order]
    begins = np.flatnonzero(np.diff(to, prepend=-1))
    place = np.arange(len(to)) - np.repeat(begins, np.diff(begins, append=len(to)))
    first = place < most[to]
    return to[first], at[first], scores[first]


def text_ranks(values: pa.ChunkedArray) -> np.ndarray:
    """Position of each string in byte order, the order Spark sorts strings by."""
    ranks = np.empty(len(values), dtype=np.int64)
    ranks[pc.sort_indices(values).to_numpy()] = np.arange(len(values))
    return ranks


def slices(
    documents: pa.Table, questions: pa.Table, cells: int = 1 << 23
) -> Iterator[tuple[int, pa.Table]]:
    """The documents of a block in pieces of at most 4096 whose score matrix has about ``cells`` numbers,
    each with the position of its first document."""
    rows = max(64, min(4096, cells // max(questions.num_rows, 1)))
    for start in range(0, documents.num_rows, rows):
        yield start, documents.slice(start, rows)
