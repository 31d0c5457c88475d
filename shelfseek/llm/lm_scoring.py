"""Scores of whole texts under a language model of online logistic context mixing, trained on the corpus.

Tokens are lower-cased words between white space and one end per text. A token's bytes are predicted by contexts inside it
(``mixing``), the token by the one before it as well (``following``), over the running text:

1. tokens are counted by token and class of text (``mixing.text_classes``) and combined before the shuffle. What contexts
   inside a token say depends on nothing but the token and its class, so it is worked out once for each distinct one;
2. contexts of up to 6 bytes are counted with what came next, summed up in Spark, and broadcast, 16 bytes for each
   distinct context and next byte. Longer ones are all of a token's bytes so far; tokens that begin with the same 7
   bytes meet in one task, which counts these contexts for itself. No count shares its place with another;
3. gated weights are learned online in every task, over all distinct training tokens, and averaged by how much each gate
   has seen; the adaptive map's counts are added up;
4. every distinct token, also those of held-out texts only, is scored once; texts add up their tokens' scores;
5. each token's symbol and the one before it go, with the text's place, to the task of that pair, which counts how often
   it occurs in training texts. The weights of this context are learned there, online, and averaged; then every text gets
   back what its pairs add to its score.

Scores and exact counts of the commonest tokens, at most ``COMMON_TOKENS``, are broadcast, and each is a symbol of its own; a
text's other tokens are joined with theirs, and those of a class are one symbol.

Defined results: a null or empty text is one end; a null id is the empty string for the split, so held out; rows with
equal ids are scored each; with no training rows all decisions are even.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfseek.llm import following, mixing
from shelfseek.llm.mixing import Contexts, Mixer
from shelfseek.llm.text_arrays import (
    LOWER,
    NOT_WHITE,
    Shared,
    Words,
    batch_map,
    binary_array,
    distinct_hashes,
    giving_back,
    row_keys,
    text_bytes,
)
from shelfseek.scratch import stored

FOLDS = 10
SMOOTH = 0.1
#: Most pairs of token and class whose counts and scores are broadcast, 24 bytes each.
COMMON_TOKENS = 400_000
#: The token that ends a text; words hold no line break, so no word's bytes are this.
END_HASH = 0x0E0D0A0E0D0A0E0D
#: Distinct tokens that one task learns from or scores, about.
TASK_TOKENS = 100_000
#: Bytes of texts whose tokens are found at a time: a task takes about 20 bytes of memory for each.
TEXT_BYTES = 4 << 20
#: Bytes of texts whose pairs of symbols one task counts, about.
PART_BYTES = 12 << 20


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def tokens(column: pa.Array) -> tuple[np.ndarray, Words, np.ndarray, np.ndarray]:
    """The bytes, words, class of each text and where each text begins."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    return data, Words(data, offsets, NOT_WHITE), mixing.text_classes(data, offsets), offsets


def distinct_tokens(words: Words, classes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs of class and token, ends included: their hashes, classes, the place of one occurrence, and for each
    word and then each end of a text the number of its pair."""
    hashes = np.concatenate([words.hashes, np.full(len(classes), END_HASH, np.uint64)])
    own = np.concatenate([classes[words.rows], classes])
    _, at, place, _ = distinct_hashes(row_keys(hashes, own))
    return hashes[at], own[at], at, place


def token_bytes(data: np.ndarray, words: Words, at: np.ndarray) -> pa.Array:
    """The bytes of the words ``at`` some places, a line break for each place beyond them."""
    ends = at >= len(words.starts)
    starts = np.where(ends, len(data), np.concatenate([words.starts, [0]])[np.where(ends, -1, at)])
    stops = np.where(ends, len(data) + 1, np.concatenate([words.ends, [0]])[np.where(ends, -1, at)])
    return binary_array(np.concatenate([data, np.array([0x0A], np.uint8)]), starts, stops)


def count_tokens(batch: pa.RecordBatch) -> pa.Table:
    data, words, classes, _ = tokens(batch["text"])
    hashes, own, at, place = distinct_tokens(words, classes)
    training = ~batch["held_out"].to_numpy(zero_copy_only=False)
    n = np.bincount(place, np.concatenate([training[words.rows], training]), len(at)).astype(np.int64)
    return pa.table(
        {
            "token": hashes.view(np.int64),
            "class": pa.array(own, pa.int32()),
            "word": token_bytes(data, words, at),
            "n": pa.array(n, pa.int64()),
        }
    )


def vocabulary(texts: DataFrame) -> DataFrame:
    """Every distinct pair of token and class in ``texts``, and how often it occurs in those not held out."""
    counted = batch_map(texts, count_tokens, "token bigint, class int, word binary, n bigint", size=TEXT_BYTES)
    summed = counted.groupBy("token", "class", "word").agg(F.sum("n").alias("n"))
    return stored(summed.sortWithinPartitions("token", "class"), "lm-vocabulary")


def dealt(vocabulary: DataFrame, rows: int) -> DataFrame:
    """Tokens that begin with the same WHOLE_FROM bytes in one task."""
    tasks = max(1, -(-rows // TASK_TOKENS))
    return vocabulary.repartition(tasks, "class", F.substring("word", 1, mixing.WHOLE_FROM))


def portion(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, ...]:
    data, first = mixing.joined(batch["word"])
    return data, first, batch["class"].to_numpy(), batch["n"].to_numpy()


def gathered(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of a task in a fixed order."""
    own = list(batches)
    return pa.Table.from_batches(own).sort_by([("token", "ascending"), ("class", "ascending")]) if own else None


def grams(vocabulary: DataFrame) -> list[Contexts]:
    """The counts of all contexts of up to 6 bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, (keys, n) in enumerate(mixing.gram_counts(*portion(batch))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), at, np.int32)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "key", "n"]
                )

    training = vocabulary.filter("n > 0").select("word", "class", "n")
    counted = training.mapInArrow(giving_back(count), "gram int, key bigint, n bigint")
    found = counted.groupBy("gram", "key").agg(F.sum("n").alias("n")).toArrow()
    gram, keys, n = found["gram"].to_numpy(), found["key"].to_numpy().view(np.uint64), found["n"].to_numpy()
    return [Contexts(keys[gram == at], n[gram == at]) for at in range(len(mixing.GRAMS))]


def train(tokens: DataFrame) -> Mixer:
    """The contexts, weights and adaptive map that all distinct training tokens give; ``tokens`` are dealt."""
    mixer = Mixer(grams=grams(tokens))
    shared = Shared(tokens.sparkSession.sparkContext, mixer)
    n_weights = mixer.weights.size

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gathered(batches)
        if table is None:
            return
        own, words = shared.value, mixing.Beginnings(*portion(table))
        own.whole = words.whole()
        mass, came = own.learn_beginnings(words)
        values = np.concatenate([(own.weights * mass[:, None]).reshape(-1), mass, came.reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["i", "value"])

    learned = tokens.filter("n > 0").mapInArrow(giving_back(learn), "i int, value double")
    sums = {row["i"]: row["value"] for row in learned.groupBy("i").agg(F.sum("value").alias("value")).collect()}
    shared.destroy()
    size = n_weights + mixing.GATES + 2 * mixing.SEEN * mixing.BINS
    values = np.array([sums.get(i, 0.0) for i in range(size)])
    mass = values[n_weights : n_weights + mixing.GATES]
    met = mass > 0
    mixer.weights[met] = values[:n_weights].reshape(mixer.weights.shape)[met] / mass[met, None]
    came = values[n_weights + mixing.GATES :].reshape(2, mixing.SEEN, mixing.BINS)
    mixer.refine = mixing.refinement(came)
    return mixer.prepare()


def token_scores(tokens: DataFrame, mixer: Mixer) -> DataFrame:
    """token, class, n and log: the log10 probability of each; ``tokens`` are dealt."""
    shared = Shared(tokens.sparkSession.sparkContext, mixer)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gathered(batches)
        if table is None:
            return
        own, words = shared.value, mixing.Beginnings(*portion(table))
        own.whole = words.whole()
        scored = table.select(["token", "class", "n"]).append_column("log", pa.array(own.log10_beginnings(words)))
        yield from scored.to_batches()

    return tokens.mapInArrow(giving_back(score), "token bigint, class int, n bigint, log double")


def level(c: str = "c") -> Column:
    """Counts by eighths of a doubling: a few hundred levels."""
    return F.when(F.col(c) > 0, F.floor(F.log2(c) * 8)).otherwise(-1).cast("int")


def common_scores(scores: DataFrame) -> tuple[int, following.Symbols, np.ndarray, np.ndarray]:
    """The lowest level of counts such that at most COMMON_TOKENS rows reach it, and the symbols of those rows with their
    counts and scores."""
    levels = sorted(((r[0], r[1]) for r in scores.groupBy(level()).count().collect()), reverse=True)
    total, least = 0, 1 << 20
    for at, n in levels:
        total += n
        if total > COMMON_TOKENS:
            break
        least = at
    end = F.col("token") == int(np.uint64(END_HASH).view(np.int64))
    every, texts = np.zeros(mixing.N_CLASSES), np.zeros(mixing.N_CLASSES)
    for row in scores.groupBy("class").agg(F.sum("n"), F.sum(F.when(end, F.col("n")).otherwise(0))).collect():
        every[row[0]], texts[row[0]] = row[1], row[2]
    found = scores.filter(level() >= least).select("token", "class", "c", "n", "log").toArrow()
    token, classes = found["token"].to_numpy().view(np.uint64), found["class"].to_numpy()
    keys = row_keys(token, classes)
    order = np.argsort(keys)
    n, log = found["n"].to_numpy()[order], found["log"].to_numpy()[order]
    symbols = following.Symbols(keys[order], classes[order], n, log, token[order] == END_HASH, every, texts)
    return least, symbols, found["c"].to_numpy()[order], log


def as_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def scorer(shared: Shared, total: int, distinct: int, parts: int):
    """Blocks of a batch: by part, its pairs of symbols; and with a part of ``parts`` and more, scores of its texts, with
    the tokens whose scores are not broadcast left to be joined."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        symbols, common_c, common_log = shared.value
        common = symbols.keys
        data, words, classes, offsets = tokens(batch["text"])
        hashes, own, _, place = distinct_tokens(words, classes)
        n = batch.num_rows
        ends = place[len(words.hashes) :]
        first = words.first

        def per_text(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0.0], np.cumsum(values[place[: len(words.hashes)]], dtype=np.float64)])
            return sums[first[1:]] - sums[first[:-1]] + values[ends]

        keys = row_keys(hashes, own)
        at = np.minimum(np.searchsorted(common, keys), max(len(common) - 1, 0))
        found = common[at] == keys if len(common) else np.zeros(len(keys), bool)
        c = np.where(found, common_c[at], 0) if len(common) else np.zeros(len(keys))
        base = np.where(found, np.log10((c + SMOOTH) / (total + SMOOTH * (distinct + 1))), 0.0)
        logs = np.where(found, common_log[at], 0.0) if len(common) else np.zeros(len(keys))
        # Each text's other tokens, once with their number.
        token = hashes.view(np.int64)
        rare = np.flatnonzero(~found[place])
        row = np.concatenate([words.rows, np.arange(n)])[rare]
        _, one, _, times = distinct_hashes(row_keys(hashes[place[rare]], row))
        order = np.argsort(row[one], kind="stable")
        one, times = one[order], times[order]
        edges = pa.array(np.searchsorted(row[one], np.arange(n + 1)).astype(np.int32))
        begin = batch["row"][0].as_py()
        texts = pa.table(
            {
                "doc_id": batch["doc_id"],
                "held_out": batch["held_out"],
                "row": pa.array(begin + np.arange(n)),
                "class": pa.array(classes, pa.int32()),
                "n_tokens": pa.array(words.counts + 1, pa.int64()),
                "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                "common": pa.array(per_text((c > 0).astype(np.float64)).round().astype(np.int64)),
                "base": per_text(base),
                "score": per_text(logs) - np.log10(mixing.N_CLASSES),
                "tokens": pa.ListArray.from_arrays(edges, pa.array(token[place[rare[one]]])),
                "times": pa.ListArray.from_arrays(edges, pa.array(times.astype(np.int32))),
            }
        )
        # What follows what, over the running text.
        symbol = np.where(found, at, symbols.rest + own)[place]
        training = ~batch["held_out"].to_numpy(zero_copy_only=False)
        pairs = following.followed(symbol[: len(words.hashes)], symbol[len(words.hashes) :], first, symbols.start + classes, training)
        blocks = [*(following.dealt(pairs, parts) if total else ()), (parts + hash(begin) % parts, as_bytes(texts))]
        return pa.table(
            {
                "part": pa.array([part for part, _ in blocks], pa.int32()),
                "base": pa.array([begin] * len(blocks), pa.int64()),
                "data": pa.array([data for _, data in blocks], pa.binary()),
            }
        )

    return work


def by_part(blocks: Iterator, parts: int) -> Iterator[tuple[list[int], following.Pairs]]:
    """The pairs of each part among some blocks, and the batch each of its blocks is from."""
    held = {}
    for part, base, data in blocks:
        if part < parts:
            held.setdefault(part, []).append((base, bytes(data)))
    for part in sorted(held):
        own = sorted(held.pop(part))
        yield [base for base, _ in own], following.Pairs([data for _, data in own])


def context_weights(blocks: RDD, parts: int, shared: Shared) -> np.ndarray:
    """The weights of the context of the token before, by gate."""

    def learn(rows: Iterator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, pairs in by_part(rows, parts):
            weights, mass = pairs.learn(shared.value[0])
            yield weights * mass, mass

    none = np.zeros(following.GATES)
    sums, mass = blocks.mapPartitions(giving_back(learn)).fold((none, none), lambda x, y: (x[0] + y[0], x[1] + y[1]))
    return np.where(mass > 0, sums / np.maximum(mass, 1), following.START)


def context_gains(spark: SparkSession, blocks: RDD, parts: int, shared: Shared, weights: np.ndarray) -> DataFrame:
    """row and gain: what the context of the token before adds to each text's score."""

    def gains(rows: Iterator) -> Iterator[tuple[int, bytes, bytes]]:
        for bases, pairs in by_part(rows, parts):
            for base, (texts, gain) in zip(bases, pairs.gains(shared.value[0], weights), strict=True):
                yield base, texts.astype(np.int32).tobytes(), gain.astype(np.float32).tobytes()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for base, texts, gain in zip(*(batch[name].to_pylist() for name in ("base", "texts", "gain")), strict=True):
                own = np.bincount(np.frombuffer(texts, np.int32), np.frombuffer(gain, np.float32))
                held = sums.get(base, own[:0])
                longer, shorter = (own, held) if len(own) > len(held) else (held, own)
                longer[: len(shorter)] += shorter
                sums[base] = longer
        for base, gain in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(base + np.arange(len(gain))), pa.array(gain)], names=["row", "gain"])

    found = spark.createDataFrame(blocks.mapPartitions(giving_back(gains)), "base bigint, texts binary, gain binary", verifySchema=False)
    return found.repartition("base").mapInArrow(giving_back(add), "row bigint, gain double")


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte, for each row of ``docs``.

    The model learns from the rows whose fold is not 0."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    held_out = fold(F.col("doc_id")) == 0
    found = vocabulary(texts.select("text", held_out.alias("held_out")))
    counts = found.groupBy("token").agg(F.sum("n").alias("c"))
    own = dealt(found, found.count())
    scores = stored(token_scores(own, train(own)).join(counts, "token"), "lm-scores")
    total, distinct = scores.groupBy("token").agg(F.max("c").alias("c")).filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least, *common = common_scores(scores)
    spark = docs.sparkSession
    shared = Shared(spark.sparkContext, tuple(common))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // PART_BYTES))

    schema = (
        f"doc_id {docs.schema[doc_id].dataType.simpleString()}, held_out boolean, row bigint, class int, n_tokens bigint, n_bytes bigint, "
        "common bigint, base double, score double, tokens array<bigint>, times array<int>"
    )
    numbered = texts.select("doc_id", held_out.alias("held_out"), F.monotonically_increasing_id().alias("row"), "text")
    # Texts are read once for all that follows: every pass over the blocks goes on from the same shuffle.
    blocks = batch_map(numbered, scorer(shared, total, distinct, parts), "part int, base bigint, data binary", size=TEXT_BYTES).repartition(parts, "part").rdd
    weights = context_weights(blocks, parts, shared)

    def scores_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["data"].to_pylist():
                yield from pa.ipc.open_stream(data)

    kept = blocks.filter(lambda row: row[0] >= parts).map(lambda row: (bytes(row[2]),))
    scored = stored(spark.createDataFrame(kept, "data binary", verifySchema=False).mapInArrow(giving_back(scores_of_texts), schema), "lm-scored")
    gains = context_gains(spark, blocks, parts, shared, weights)
    rare = scored.select("row", "class", F.explode(F.arrays_zip("tokens", "times")).alias("x")).select(
        "row", "class", F.col("x.tokens").alias("token"), F.col("x.times").alias("times")
    )
    c = F.col("c")
    log = F.log10((c + SMOOTH) / F.lit(total + SMOOTH * (distinct + 1)))
    joined = rare.join(scores.filter(level() < least), ["token", "class"])
    sums = joined.groupBy("row").agg(
        F.sum(F.col("times") * log).alias("rare_base"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.col("log")).alias("rare_score"),
    )
    zero = F.lit(0)
    score = F.col("score") + F.coalesce("rare_score", F.lit(0.0)) + F.coalesce("gain", F.lit(0.0))
    return scored.join(sums, "row", "left").join(gains, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("common") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        (-score / F.log10(F.lit(2.0)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )


def op2(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
