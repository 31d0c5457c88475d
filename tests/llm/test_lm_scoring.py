import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import brute
from shelfseek.llm import lm_scoring, mixing
from tables import odd_texts, sentence


def some_docs(rng):
    rows = [(i, sentence(rng, rng.randrange(1, 120))) for i in range(400)]
    return [*rows, *((500 + k, t) for k, t in enumerate(odd_texts())), (None, "the of and"), (None, None), rows[5], (600, sentence(rng, 20_000))]


@pytest.mark.parametrize("common", [lm_scoring.COMMON_TOKENS, 40, 0])
def test_base_scores(spark, monkeypatch, common):
    """With few or no broadcast counts the others are joined."""
    monkeypatch.setattr(lm_scoring, "COMMON_TOKENS", common)
    rows = some_docs(random.Random(4))
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id bigint, text string, row int, score double")
    found = lm_scoring.score_texts(docs).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    expected = sorted(brute.base_scores(rows), key=key)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5] for g in got], [e[5] for e in expected])
    if common:
        held = [r for r in found if r.held_out and r.n_tokens > 20]
        # These words are drawn evenly, so nothing can do better than their frequencies.
        assert len(held) > 20 and all(r.score > 1.03 * r.base_score for r in held)
        assert all(r.score < 0 and r.bits_per_byte > 0 for r in found)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    assert lm_scoring.score_texts(docs.limit(0)).count() == 0
    # Without training rows.
    held = docs.filter(lm_scoring.fold(docs["doc_id"]) == 0)
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in lm_scoring.score_texts(held).collect())


def test_probabilities_add_up():
    """All tokens up to some length have probabilities that add up to less than one, one-byte ones sum as they should."""
    rng = np.random.default_rng(1)
    words = [bytes(rng.choice(list(b"abcxyz"), rng.integers(1, 6)).astype(np.uint8)) for _ in range(300)]
    data, first = mixing.joined(words)
    classes, counts = np.zeros(len(words), np.int64), rng.integers(1, 9, len(words))
    zeros, ones = np.zeros(mixing.SLOTS, np.float32), np.zeros(mixing.SLOTS, np.float32)
    mixing.add_counts(zeros, ones, data, first, classes, counts)
    mixer = mixing.Mixer(zeros, ones)
    _, came = mixer.learn(data, first, classes, counts)
    mixer.refine = mixing.refinement(came)
    mixer.prepare()
    # First bytes alone: of all 256, the next byte is one of them.
    single = np.arange(256, dtype=np.uint8)
    logs = mixer.log10(single, np.arange(257), np.zeros(256, np.int64))
    total = (10.0**logs).sum()
    assert 0.9 < total <= 1 + 1e-5


def test_classes_tell_accents_apart():
    texts = ["plain words only", "é à é ç é", "ñ ñ ó", "", "é" + "x" * 500]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    found = mixing.text_classes(data, offsets).tolist()
    assert found[0] == found[3] == found[4] == 0 and found[1] > 0 and found[2] > 0


def test_rare_contexts_keep_their_own_counts(spark):
    """Far more contexts than 2^21, the most that were once told apart: every one is counted as in plain Python."""
    rng = np.random.default_rng(5)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (56_000, 14))]
    docs = spark.createDataFrame([(i, " ".join(words[i::400])) for i in range(400)], "doc_id bigint, text string")
    found = lm_scoring.vocabulary(docs.select("text", (docs["doc_id"] < 0).alias("held_out")))
    assert sum(len(w) - 6 for w in words) * mixing.DEPTH > 1 << 21
    mixer = lm_scoring.train(lm_scoring.dealt(found, 56_001))
    before = Counter(w[:k] for w in words for k in range(len(w) + 1))
    before[""] += 400  # The texts' ends.
    grams = Counter(w[k - 4 : k] for w in words for k in range(5, len(w) + 1))
    data, first = mixing.joined([w.encode() for w in words])
    mixer.whole = mixing.whole_contexts(data, first, np.zeros(len(words), np.int64), np.ones(len(words)))
    for word in [*words[:200], "qqqqqqqqzqqqqq", "zqxjvkzqxjvkzq"]:
        made = mixer.counted(*mixing.joined([word.encode()]), np.zeros(1, np.int64))
        total = (made.zeros + made.ones)[:, : mixing.DEPTH * (len(word) + 1) : mixing.DEPTH]
        assert total[4].tolist() == [before[word[:k]] for k in range(len(word) + 1)]
        assert total[2, 5:].tolist() == [grams[word[k - 4 : k]] for k in range(5, len(word) + 1)]


class Task:
    """Stands for a table: runs the work of one task on a batch here, and notes the most memory that numpy and Python took."""

    def __init__(self, batch):
        self.batch, self.rows, self.most = batch, [], 0

    def mapInArrow(self, work, schema):  # noqa: N802
        tracemalloc.start()
        self.rows = [len(made) for made in work(iter([self.batch]))]
        self.most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return self

    def __getattr__(self, name):
        return lambda *args: self


def test_memory_of_a_task_that_counts_tokens(spark, monkeypatch):
    """An executor has 3,000 MB for two tasks, its JVM and its Python workers."""
    monkeypatch.setattr(lm_scoring, "stored", lambda df, name: df)
    rng = random.Random(3)
    texts = [" ".join(f"{rng.randrange(10**5):x}" for _ in range(2000)) for _ in range(1200)]
    assert sum(map(len, texts)) > 12e6
    task = Task(pa.RecordBatch.from_pydict({"text": texts, "held_out": [i % 10 == 0 for i in range(len(texts))]}))
    lm_scoring.vocabulary(task)
    assert sum(task.rows) >= 10**5 and task.most < 130e6


def test_tokens_keep_their_bytes():
    texts = ["one two one", "", "Two \u00e9t\u00e9 " + "x" * 300_000, None, " \n "]
    made = lm_scoring.count_tokens(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "held_out": [False, False, True, False, False]}))
    found = Counter()
    for word, n in zip(made["word"].to_pylist(), made["n"].to_pylist(), strict=True):
        found[word] += n
    assert found == {b"one": 2, b"two": 1, "\u00e9t\u00e9".encode(): 0, b"x" * 300_000: 0, b"\n": 4}
    data, first = mixing.joined(made["word"])
    assert [data[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)] == [w + b" " * (w != b"\n") for w in made["word"].to_pylist()]
