"""Packing against whole texts tokenised plainly, and the plan against its bounds."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import odd_texts, sentence
from tokenizers import Tokenizer

from shelfseek.llm import packing

TEXTS = [
    *odd_texts(),
    "<|endoftext|>",
    "end<|endoftext|> of it <|endoftext|>",
    "it's  two   spaces   and  a b  c",
    "café été d'été 12 34 a1 b2 × × 3 ... ?! (a b)   x 中 文",
    "tabs\tand \n new lines \r\n a \n",
    " leading and trailing ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def plain(tokenizer, rows, capacity):
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        first = len(ids) % capacity or capacity
        borders = [0, *range(first, len(ids), capacity), len(ids)]
        for k, (lo, hi) in enumerate(zip(borders[:-1], borders[1:])):
            out.append((doc_id, k, lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], "<u4").tobytes())))
    return out


def test_spans_give_the_ids_of_whole_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SPANS_AT_ONCE", 7)
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    spans = packing.SpanTokenizer(packing.tokenizer_path())
    found = [x.tolist() for x in spans.ids(pa.array(TEXTS, pa.string()))]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert list(spans.ids(pa.array([], pa.string()))) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é .'s1\n", max_size=20), max_size=6))
def test_spans_of_any_text(texts):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    found = [x.tolist() for x in packing.span_tokenizer(packing.tokenizer_path()).ids(pa.array(texts, pa.string()))]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=12))
def test_plan_places_every_piece_once(histogram):
    counts = np.zeros(33, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    made = packing.plan(counts, 32)
    lengths = np.repeat(np.arange(33), counts)
    numbers = np.concatenate([np.arange(n) for n in counts]) if counts.sum() else np.empty(0, np.int64)
    if not len(lengths):
        assert made.total == 0
        return
    at, offset = made.place(lengths, numbers)
    filled = {}
    for s, o, n in sorted(zip(at.tolist(), offset.tolist(), lengths.tolist())):
        assert filled.get(s, 0) == o
        filled[s] = o + n
    assert max(filled.values()) <= 32 and sorted(filled) == list(range(made.total))
    # Any two neighbours of a plan that never leaves a fitting piece aside hold more than one capacity.
    assert made.total <= 2 * -(-int(lengths.sum()) // 32)


def test_exact_complements_are_found():
    counts = np.zeros(101, np.int64)
    counts[[70, 30, 60, 25, 15, 50, 20, 18, 12]] = [4, 4, 3, 3, 3, 2, 2, 2, 2]
    assert packing.plan(counts, 100).total == 4 + 3 + 2


def check_packed(rows, wanted, capacity):
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == sorted(wanted)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= capacity
    return len(ends)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else capacity) - n)
    return len(gaps)


def test_documents_in_sequences(spark, tokenizer):
    rng = random.Random(3)
    texts = [*TEXTS, *(sentence(rng, rng.randrange(1, 120)) for _ in range(300)), "same text " * 500, "same", "same"]
    rows = [(i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, 5, "z") for i, t in rows], "doc_id bigint, text string, length int, _spread string")
    found = packing.packed(packing.pieces(docs, capacity=256), 256).collect()
    used = check_packed(found, plain(tokenizer, rows, 256), 256)
    assert used <= best_fit_decreasing([r.length for r in found], 256)


def test_sequences_hold_their_ids(spark, tokenizer):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "x y " * 40)], "doc_id bigint, text string")
    whole = packing.sequences(packing.packed(packing.pieces(docs, capacity=32, with_ids=True), 32)).collect()
    ids = [x for r in whole for x in r.ids]
    expected = [x for t in ("a b c", "", "x y " * 40) for x in tokenizer.encode(t, add_special_tokens=False).ids + [0]]
    assert sorted(ids) == sorted(expected) and all(len(r.ids) == r.length <= 32 for r in whole)


def test_no_documents_and_many_equal_ones(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.packed(packing.pieces(none)).collect() == []
    same = spark.range(0, 3000, 1, 3).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'one two' AS text")
    rows = packing.packed(packing.pieces(same)).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3000
    assert len({r.sequence_id for r in rows}) == -(-3000 // (2048 // rows[0].length))
