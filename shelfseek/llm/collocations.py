"""Collocations: phrases of two to five words, counted level by level as pairs of neighbouring ids.

Words that occur often enough get ids by falling frequency, so that the frequent ones are small numbers. A text becomes a
sequence of ids, and a phrase of n + 1 words is a pair of neighbouring phrases of n words, each frequent itself: frequent
pairs are ranked again, and the sequence of their ids is the next level's. Pairs are counted in tiles of the id plane: a
tile of frequent ids is a dense matrix with a cell for each pair (a bincount), all other pairs are counted as sorted
coordinates. Counts of tasks are added up by Spark.

Ids of the commonest ``known`` entries of a level go to all tasks (that many rows at most, of short words). The others,
if there are any, are found by a join of their occurrences, none of which is frequent enough to be a hot key, or is left
to the skew join of adaptive execution if it is a very long word.

Texts are cut into rows of at most ROW_IDS ids that carry OVERLAP ids of the next row, so that every window begins in
exactly one row, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfseek.llm.text_arrays import LOWER, Shared, batch_map, sliced, spans, text_bytes
from shelfseek.scratch import stored

# Fixed values of the contract.
MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN_LANG = "und"
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b"\x20\x09"

WORD_BYTE = np.array([b not in PIECE_ENDS + SPACES for b in range(256)])
PIECE_END = np.array([b in PIECE_ENDS for b in range(256)])

#: Entries of a level whose ids every task knows, and the longest word among them in bytes.
KNOWN = 1 << 17
KNOWN_BYTES = 64
ROW_IDS = 1 << 10
#: Rows of a sequence that are worked on at once.
ROWS_AT_ONCE = 1 << 10
OVERLAP = MAX_WORDS - 1
#: Side of a tile, and how many tiles of the most frequent ids a task keeps as dense matrices (2 MB each).
TILE = 1 << 9
DENSE_SIDE = 4

CHUNKS = "chunk bigint, own int, ids array<bigint>"
PAIRS = "left bigint, right bigint, n bigint"


class Words:
    """The words of a batch's texts, in order: their bytes as an Arrow array, and where a new piece or text begins."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        data = LOWER[data]
        starts, ends = spans(data, offsets, WORD_BYTE)
        self.rows = np.searchsorted(offsets, starts, side="right") - 1
        stops = np.flatnonzero(PIECE_END[data])
        self.begins = np.ones(len(starts), bool)
        stopped = np.searchsorted(stops, starts[1:]) > np.searchsorted(stops, ends[:-1])
        self.begins[1:] = (np.diff(self.rows) > 0) | stopped
        # Words and what is between them, in turn; every second value is a word.
        borders = np.empty(2 * len(starts) + 1, np.int64)
        borders[0:-1:2], borders[1::2] = starts, ends
        borders[-1] = len(data)
        buffers = [None, pa.py_buffer(borders), pa.py_buffer(data)]
        both = pa.Array.from_buffers(pa.large_binary(), 2 * len(starts), buffers)
        self.encoded = both.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
        self.codes = self.encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = self.encoded.dictionary


def languages(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    """The language of each row as a number, and the languages."""
    encoded = batch["lang"].dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary.to_pylist()


def by_language(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), "text")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts; counts are made per slice of texts and added up."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, (lang, names) = Words(batch["text"]), languages(batch)
        width = max(len(words.distinct), 1)
        keys, n = np.unique(lang[words.rows] * width + words.codes, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()).take(pa.array(keys // width)),
                words.distinct.take(pa.array(keys % width)).cast(pa.large_string()).cast(pa.string()),
                pa.array(n, pa.int64()),
            ],
            names=["lang", "word", "n"],
        )

    counted = batch_map(docs, count, "lang string, word string, n bigint")
    return stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")


def ranked(counts: DataFrame, key: tuple[str, ...], may_know: Column, known: int) -> tuple[DataFrame, pa.Table, bool]:
    """``counts`` with an ``id``: the place by falling ``n`` for the ``known`` commonest, any greater number for the
    rest; those commonest; and whether there are others."""
    top = counts.filter(may_know).select(*key, "n").orderBy(F.desc("n"), *key).limit(known).toArrow()
    top = top.append_column("id", pa.array(np.arange(top.num_rows), pa.int64()))
    if counts.count() == top.num_rows:
        listed = counts.sparkSession.createDataFrame(top.select([*key, "id"])) if top.num_rows else None
        with_ids = counts.join(F.broadcast(listed), list(key)) if listed else counts.withColumn("id", F.lit(0).cast("bigint"))
        return with_ids, top, False
    listed = F.broadcast(counts.sparkSession.createDataFrame(top.select([*key, "id"])))
    late = F.monotonically_increasing_id() + top.num_rows
    with_ids = counts.withColumn("late", late).join(listed, list(key), "left").withColumn("id", F.coalesce("id", "late"))
    return stored(with_ids.drop("late"), "ranked"), top, True


def chunk_numbers() -> Iterator[int]:
    """Numbers that no other task gives."""
    number = TaskContext.get().partitionId() << 33
    while True:
        yield number
        number += 1


def cut_ids(ids: np.ndarray, numbers: Iterator[int]) -> pa.RecordBatch:
    """``ids`` in rows of CHUNKS, each with the first OVERLAP ids of the next."""
    starts = list(range(0, len(ids), ROW_IDS))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([next(numbers) for _ in starts], pa.int64()),
            pa.array([min(ROW_IDS, len(ids) - at) for at in starts], pa.int32()),
            pa.array([ids[at : at + ROW_IDS + OVERLAP] for at in starts], pa.list_(pa.int64())),
        ],
        names=["chunk", "own", "ids"],
    )


def squeezed(ids: np.ndarray) -> np.ndarray:
    """``ids`` without those that no frequent pair can hold: of a run of absent ones one is left."""
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] >= 0) | (ids[:-1] >= 0)
    return ids[keep]


def word_ids(docs: DataFrame, words: DataFrame, top: pa.Table, others: bool) -> DataFrame:
    """``CHUNKS`` of the ids of all texts' words, -1 for words that are not frequent and between pieces."""
    listed = Shared(docs.sparkSession.sparkContext, top.select(["lang", "word", "id"]).combine_chunks())
    lists: dict[str, tuple[pa.Array, np.ndarray]] = {}

    def known(names: list[str], words: Words, lang: np.ndarray) -> np.ndarray:
        """The id of each word of a batch, -1 where it is not one of the commonest."""
        if not lists:
            table = listed.value
            for name in pc.unique(table["lang"]).to_pylist():
                part = table.filter(pc.equal(table["lang"], name))
                entries = part["word"].cast(pa.large_string()).cast(pa.large_binary()).combine_chunks()
                lists[name] = entries, np.append(part["id"].to_numpy(), -1)
        ids = np.full(len(words.codes), -1, np.int64)
        for k, name in enumerate(names):
            if name not in lists:
                continue
            entries, numbers = lists[name]
            place = pc.fill_null(pc.index_in(words.distinct, value_set=entries), -1).to_numpy(zero_copy_only=False)
            here = lang[words.rows] == k
            ids[here] = numbers[place][words.codes[here]]
        return ids

    def with_breaks(ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return np.insert(ids, np.flatnonzero(begins), -1)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = chunk_numbers()
        for whole in batches:
            for batch in sliced(whole, "text"):
                words, (lang, names) = Words(batch["text"]), languages(batch)
                ids = with_breaks(known(names, words, lang), words.begins)
                if not others:
                    yield cut_ids(squeezed(ids), numbers)
                    continue
                # Words that no task knows are written out beside the ids, with their places.
                at = np.flatnonzero(ids < 0)
                places = np.flatnonzero(with_breaks(np.ones(len(words.codes), np.int64), words.begins) > 0)
                at = at[np.isin(at, places, assume_unique=True)]
                word = np.searchsorted(places, at)
                rest = pa.StructArray.from_arrays(
                    [
                        pa.array(at % ROW_IDS, pa.int32()),
                        pa.array(names, pa.string()).take(pa.array(lang[words.rows[word]])),
                        words.distinct.take(pa.array(words.codes[word])).cast(pa.large_string()).cast(pa.string()),
                    ],
                    names=["at", "lang", "word"],
                )
                cut = cut_ids(ids, numbers)
                edges = np.searchsorted(at, np.arange(cut.num_rows + 1) * ROW_IDS)
                lists_ = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rest)
                yield pa.RecordBatch.from_arrays([*cut.columns, lists_], names=[*cut.schema.names, "rest"])

    if not others:
        return stored(docs.mapInArrow(encode, CHUNKS), "word-ids")
    found = stored(docs.mapInArrow(encode, f"{CHUNKS}, rest array<struct<at: int, lang: string, word: string>>"), "word-ids")
    return stored(patched(found, words, ("lang", "word")), "word-ids")


def patched(chunks: DataFrame, entries: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """``chunks`` whose ``rest`` (at, and the columns of ``key``) got the ids that ``entries`` has for it.

    A place is written in the row that owns it; a row's last ids belong to the row after it and are taken from there.
    """
    rest = chunks.select("chunk", F.explode("rest").alias("r")).select("chunk", "r.*")
    found = rest.join(entries.select(*key, "id"), list(key)).groupBy("chunk").agg(F.collect_list(F.struct("at", "id")).alias("late"))
    # The first ids of a row are the last of the one before it, if both were cut from the same texts.
    head = found.select(
        (F.col("chunk") - 1).alias("chunk"), F.filter("late", lambda x: x["at"] < OVERLAP).alias("next")
    )
    both = chunks.drop("rest").join(found, "chunk", "left").join(head, "chunk", "left")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_at_once(batches):
            ids = [np.array(x, np.int64) for x in batch["ids"].to_pylist()]
            for row, own, late, following in zip(ids, batch["own"].to_pylist(), batch["late"].to_pylist(), batch["next"].to_pylist(), strict=True):
                for x in late or []:
                    row[x["at"]] = x["id"]
                for x in following or []:
                    # Rows of other texts may follow too; their ids lie beyond this row's end.
                    if own + x["at"] < len(row):
                        row[own + x["at"]] = x["id"]
            yield pa.RecordBatch.from_arrays(
                [batch["chunk"], batch["own"], pa.array(ids, pa.list_(pa.int64()))], names=["chunk", "own", "ids"]
            )

    return both.mapInArrow(fill, CHUNKS)


def rows_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of ROWS_AT_ONCE rows, so that memory does not follow the size of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


class Flat:
    """The ids of a batch of CHUNKS in one array, with the neighbours that make pairs."""

    def __init__(self, batch: pa.RecordBatch):
        lists = batch["ids"]
        self.ids = lists.flatten().to_numpy(zero_copy_only=False)
        counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        inside = np.ones(len(self.ids), bool)
        inside[self.ends[counts > 0] - 1] = False
        paired = np.zeros(len(self.ids), bool)
        paired[:-1] = (self.ids[:-1] >= 0) & (self.ids[1:] >= 0)
        self.pairs = np.flatnonzero(paired & inside)
        # A row counts the windows that begin among its own ids.
        row = np.searchsorted(self.ends, self.pairs, side="right")
        owned = self.pairs - self.starts[row] < batch["own"].to_numpy()[row]
        self.counted = self.pairs[owned]


def pair_counts(chunks: DataFrame, min_count: int) -> DataFrame:
    """``PAIRS`` of neighbouring ids that occur ``min_count`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((DENSE_SIDE * DENSE_SIDE, TILE * TILE), np.int64)
        for batch in rows_at_once(batches):
            flat = Flat(batch)
            left, right = flat.ids[flat.counted], flat.ids[flat.counted + 1]
            low = (left < DENSE_SIDE * TILE) & (right < DENSE_SIDE * TILE)
            a, b = left[low], right[low]
            tiles = (a // TILE) * DENSE_SIDE + b // TILE
            cells = (a % TILE) * TILE + b % TILE
            for tile in np.unique(tiles).tolist():
                dense[tile] += np.bincount(cells[tiles == tile], minlength=TILE * TILE)
            order = np.lexsort((right[~low], left[~low]))
            yield coordinates(left[~low][order], right[~low][order])
        for tile in range(len(dense)):
            cells = np.flatnonzero(dense[tile])
            rows, columns = divmod(tile, DENSE_SIDE)
            yield pair_batch(rows * TILE + cells // TILE, columns * TILE + cells % TILE, dense[tile][cells])

    counted = chunks.select("own", "ids").mapInArrow(count, PAIRS)
    return stored(counted.groupBy("left", "right").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "pairs")


def coordinates(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """How often each of the sorted pairs occurs."""
    new = np.ones(len(left), bool)
    new[1:] = (np.diff(left) != 0) | (np.diff(right) != 0)
    at = np.flatnonzero(new)
    return pair_batch(left[at], right[at], np.diff(np.append(at, len(left))))


def pair_batch(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(x.astype(np.int64)) for x in (left, right, n)]
    return pa.RecordBatch.from_arrays(columns, names=["left", "right", "n"])


class PairIds:
    """Ids of known pairs, by direct address of the left and the right id and a sorted list of both places."""

    def __init__(self, table: pa.Table):
        left, right = table["left"].to_numpy(), table["right"].to_numpy()
        self.lefts, self.rights = np.unique(left), np.unique(right)
        keys = self.key(np.searchsorted(self.lefts, left), np.searchsorted(self.rights, right))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], table["id"].to_numpy()[order]

    def key(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left * np.int64(max(len(self.rights), 1)) + right

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), -1, np.int64)
        a = np.minimum(np.searchsorted(self.lefts, left), len(self.lefts) - 1)
        b = np.minimum(np.searchsorted(self.rights, right), len(self.rights) - 1)
        keys = self.key(a, b)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = (self.lefts[a] == left) & (self.rights[b] == right) & (self.keys[at] == keys)
        return np.where(same, self.ids[at], -1)


def pair_ids(chunks: DataFrame, pairs: DataFrame, top: pa.Table, others: bool) -> DataFrame:
    """``chunks`` with the ids of frequent pairs in the place of their first ids."""
    listed = Shared(chunks.sparkSession.sparkContext, top.select(["left", "right", "id"]).combine_chunks())
    made: list[PairIds] = []

    def relabel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(PairIds(listed.value))
        for batch in rows_at_once(batches):
            flat = Flat(batch)
            ids = np.full(len(flat.ids), -1, np.int64)
            left, right = flat.ids[flat.pairs], flat.ids[flat.pairs + 1]
            ids[flat.pairs] = made[0].of(left, right)
            edges = np.append(flat.starts, flat.ends[-1:]) if len(flat.ends) else np.zeros(1, np.int64)
            columns = [batch["chunk"], batch["own"], pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids))]
            names = ["chunk", "own", "ids"]
            if others:
                at = np.flatnonzero(ids[flat.pairs] < 0)
                row = np.searchsorted(flat.ends, flat.pairs[at], side="right")
                inside = pa.array((flat.pairs[at] - flat.starts[row]).astype(np.int32))
                rest = pa.StructArray.from_arrays([inside, pa.array(left[at]), pa.array(right[at])], names=["at", "left", "right"])
                cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
                columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rest))
                names.append("rest")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    if not others:
        # Rows without any frequent pair are done with.
        found = chunks.mapInArrow(relabel, CHUNKS)
        return stored(found.filter(F.array_max("ids") >= 0), "pair-ids")
    found = stored(chunks.mapInArrow(relabel, f"{CHUNKS}, rest array<struct<at: int, left: bigint, right: bigint>>"), "pair-ids")
    # Pairs were looked up in the ids a row took over as well, so nothing has to come from the next row.
    return stored(patched(found, pairs, ("left", "right")).filter(F.array_max("ids") >= 0), "pair-ids")


# Phrases and their scores


def longer_phrases(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """The phrases of ``pairs`` (left, right, n, id), with the counts of all first parts and of all rests by cut."""
    first = shorter.select(
        F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), F.col("n").alias("l"), "firsts"
    )
    rest = shorter.select(F.col("id").alias("right"), "last", F.col("n").alias("r"), "rests")
    return (
        pairs.join(first, "left")
        .join(rest, "right")
        .select(
            "id",
            "left",
            "right",
            "lang",
            F.concat_ws(" ", "head", "last").alias("phrase"),
            "last",
            "n",
            F.concat("firsts", F.array("l")).alias("firsts"),
            F.concat(F.array("r"), "rests").alias("rests"),
        )
    )


def held_by_longer(phrases: DataFrame, longer: DataFrame, share: int) -> DataFrame:
    """``phrases`` without those that a phrase one word longer holds in ``share`` percent of their occurrences.

    A phrase that holds it and is longer still occurs no more often than the one between them, so one step is enough.
    """
    ends = longer.select(F.col("left").alias("id"), "n").union(longer.select(F.col("right").alias("id"), "n"))
    most = ends.groupBy("id").agg(F.max("n").alias("most"))
    found = phrases.join(most, "id", "left")
    return found.filter(F.col("most").isNull() | (100 * F.col("most") < share * F.col("n"))).drop("most")


#: For each cut, 1000 * a * total / (l * r), rounded down; in decimals of 38 digits, as 64 bits do not hold the products.
CUT_SCORES = """transform(sequence(1, size(firsts)), k ->
  (CAST(n AS DECIMAL(17, 0)) * CAST(total AS DECIMAL(17, 0)) * 1000BD)
  div (CAST(firsts[k - 1] AS DECIMAL(18, 0)) * CAST(rests[k - 1] AS DECIMAL(18, 0))))"""
#: Languages whose totals may be broadcast.
MAX_BROADCAST_LANGS = 10_000


def collocations(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    share: int = 100,
    known: int = KNOWN,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language, by the score of their weakest cut.

    ``docs`` has text and lang (null: no words; ``und``). Returns lang, rank, phrase, a, l, r, n, score. A phrase counts
    inside pieces between punctuation or line ends, overlaps included, and is a candidate if it occurs ``min_count``
    times; candidates that a longer one holds in ``share`` percent of their occurrences are dropped.
    """
    if not 2 <= max_words <= OVERLAP + 1:
        raise ValueError(f"max_words must be from 2 to {OVERLAP + 1}")
    texts = by_language(docs)
    counts = word_counts(texts)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = stored(counts.filter(F.col("n") >= min_count), "words")
    words, listed, others = ranked(frequent, ("lang", "word"), F.octet_length("word") <= KNOWN_BYTES, known)
    chunks = word_ids(texts, words, listed, others)
    none = F.array().cast("array<bigint>")
    shorter = words.select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "n", none.alias("firsts"), none.alias("rests")
    )
    levels = []
    for size in range(2, max_words + 1):
        found, listed, others = ranked(pair_counts(chunks, min_count), ("left", "right"), F.lit(True), known)
        shorter = stored(longer_phrases(found, shorter), "phrases")
        levels.append(shorter)
        if size < max_words and listed.num_rows:
            chunks = pair_ids(chunks, found, listed, others)
        elif not listed.num_rows:
            break
    columns = ("lang", "phrase", "n", "firsts", "rests")
    kept = [held_by_longer(a, b, share).select(*columns) for a, b in zip(levels[:-1], levels[1:], strict=True)]
    candidates = levels[-1].select(*columns)
    for part in kept:
        candidates = candidates.union(part)
    if totals.count() <= MAX_BROADCAST_LANGS:
        totals = F.broadcast(totals)
    scored = candidates.join(totals, "lang").withColumn("scores", F.expr(CUT_SCORES)).withColumn("score", F.array_min("scores"))
    cut = (F.array_position("scores", F.col("score")) - 1).cast("int")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.select(
            "lang",
            "phrase",
            F.col("n").alias("a"),
            F.get("firsts", cut).alias("l"),
            F.get("rests", cut).alias("r"),
            F.col("total").alias("n"),
            "score",
        )
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same result in SQL, each phrase counted as text.
OP12_SQL = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents WHERE text IS NOT NULL
), words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
phrases AS (
  SELECT lang, size, list_aggregate(w[i : i + size - 1], 'string_agg', ' ') AS phrase, count(*) AS a
  FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS size), LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT p.lang, p.size, p.phrase, p.a, k, f.a AS l, r.a AS r, n, ((1000::HUGEINT * p.a * n) // (f.a::HUGEINT * r.a))::BIGINT AS score
  FROM phrases p JOIN totals USING (lang), LATERAL (SELECT unnest(range(1, p.size)) AS k)
  JOIN phrases f ON f.lang = p.lang AND f.size = k
    AND f.phrase = array_to_string(string_split(p.phrase, ' ')[1:k], ' ')
  JOIN phrases r ON r.lang = p.lang AND r.size = p.size - k
    AND r.phrase = array_to_string(string_split(p.phrase, ' ')[k + 1:], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT DISTINCT w.lang, w.phrase FROM weakest w JOIN phrases q
  ON q.lang = w.lang AND q.size > w.size AND 100 * q.a >= 100 * w.a AND contains(' ' || q.phrase || ' ', ' ' || w.phrase || ' ')
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest ANTI JOIN held USING (lang, phrase) QUALIFY rank <= 2000"""
