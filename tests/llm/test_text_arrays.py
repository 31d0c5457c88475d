import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from shelfseek.llm import text_arrays as arrays


@pytest.fixture(params=[7, 64, 1 << 18])
def piece(request, monkeypatch):
    monkeypatch.setattr(arrays, "PIECE", request.param)
    arrays._POWERS.clear()
    yield
    arrays._POWERS.clear()


def some_texts(rng):
    return [
        None if rng.random() < 0.1 else "".join(rng.choice("aB 0\n\té-") for _ in range(rng.choice([0, 1, 3, 30, 200])))
        for _ in range(rng.randint(0, 8))
    ]


def test_words_and_hashes(piece):
    rng = random.Random(1)
    word = re.compile(rb"[^\x20\x09-\x0D]+")
    for _ in range(60):
        texts = some_texts(rng)
        data, offsets = arrays.text_bytes(pa.array(texts, pa.string()))
        words = arrays.Words(data, offsets, arrays.NOT_WHITE)
        expected = [word.findall((t or "").encode()) for t in texts]
        found = [data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
        assert found == [w for text in expected for w in text]
        assert words.counts.tolist() == [len(text) for text in expected]
        by_word = dict(zip(found, words.hashes.tolist(), strict=True))
        assert [by_word[w] for w in found] == words.hashes.tolist()
        assert len(set(by_word.values())) == len(by_word)
        hashes, at = words.windows(3)
        windows = [(r, i) for r, text in enumerate(expected) for i in range(len(text) - 2)]
        assert len(at) == len(windows)


def test_counts_by_row(piece):
    rng = random.Random(2)
    for _ in range(40):
        texts = some_texts(rng)
        data, offsets = arrays.text_bytes(pa.array(texts, pa.string()))
        spaces = ~arrays.NOT_WHITE
        found, every = arrays.counts_by_row(data, offsets, spaces, np.ones(256, bool))
        assert found.tolist() == [len(re.findall(rb"[\x20\x09-\x0D]", (t or "").encode())) for t in texts]
        assert every.tolist() == [len((t or "").encode()) for t in texts]


def test_repeated_keys():
    keys = np.array([5, 1, 5, 9, 1, 7], np.uint64)
    assert arrays.found_twice(keys).tolist() == [True, True, True, False, True, False]
    assert sorted(keys[arrays.distinct(keys)].tolist()) == [1, 5, 7, 9]
    assert arrays.distinct(keys[:0]).tolist() == []


def test_slices_cover_a_batch(monkeypatch):
    monkeypatch.setattr(arrays, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (3, 3, 3, 3, 50, 0, 0, 11)] + [None]})
    parts = list(arrays.sliced(batch, "text"))
    assert [r for p in parts for r in p["text"].to_pylist()] == batch["text"].to_pylist()
    assert max(p.num_rows for p in parts) > 1


@pytest.mark.parametrize("low", [0, 1, 64])
def test_distinct_hashes_are_those_of_unique(low):
    """Also where many hashes differ in their last bits alone."""
    rng = np.random.default_rng(low)
    for n in (0, 1, 2, 3, 1000, 40_000):
        keys = arrays.mixed(rng.integers(0, n // 3 + 1, n).astype(np.uint64))
        if low:
            keys = keys >> np.uint64(32) << np.uint64(32) | rng.integers(0, low, n).astype(np.uint64)
        expected = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        for got, wanted in zip(arrays.distinct_hashes(keys), expected, strict=True):
            assert got.tolist() == wanted.tolist()


def test_spans_as_a_column(piece):
    data = np.frombuffer(random.Random(2).randbytes(500), np.uint8)
    starts, ends = np.array([400, 3, 7, 7, 0, 499, 500]), np.array([500, 3, 90, 8, 200, 500, 500])
    assert arrays.binary_array(data, starts, ends).to_pylist() == [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert arrays.binary_array(data, starts[:0], ends[:0]).to_pylist() == []


def test_a_shared_value_is_unpacked_as_a_stream(spark):
    """Its pickled form is never whole beside it."""
    value = [np.random.default_rng(4).random(1 << 20) for _ in range(4)]
    shared = arrays.restored(arrays.Shared(spark.sparkContext, value).packed)
    assert shared.packed.value
    tracemalloc.start()
    got = shared.value
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((x == y).all() for x, y in zip(got, value, strict=True))
    assert most < 1.4 * sum(x.nbytes for x in value)


def test_tasks_give_free_memory_back():
    def held():
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024

    def work(rows):
        kept = [np.ones(1 << 13) for _ in range(4000)]
        last = np.ones(1 << 10)
        yield len(kept)
        kept.clear()
        yield held(), last

    before = held()
    assert next(run := arrays.giving_back(work)(iter(()))) == 4000 and held() > before + 200
    list(run)
    assert held() < before + 60
