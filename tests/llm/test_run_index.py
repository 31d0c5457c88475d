import random

import pytest

import brute
from shelfseek.llm import run_index
from tables import odd_texts, sentence


def best_elsewhere(strings, k, i):
    best = 0
    for other, text in enumerate(strings):
        for j in range(len(text)):
            if (other, j) != (k, i):
                n = 0
                while i + n < len(strings[k]) and j + n < len(text) and strings[k][i + n] == text[j + n]:
                    n += 1
                best = max(best, n)
    return best


def test_matching_statistics_are_exact():
    rng = random.Random(3)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 6))]
        index = run_index.RunIndex(strings)
        found = index.matching_statistics()
        for k, begin in enumerate(index.begins):
            for i in range(len(strings[k])):
                assert found[begin + i] == best_elsewhere(strings, k, i)
        assert index.length.sum() == index.size


def repeated_texts(rng):
    passages = [sentence(rng, n) for n in (70, 80, 100, 130, 300)]
    texts = []
    for _ in range(60):
        parts = [sentence(rng, rng.randrange(5, 60))]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            cut = rng.randrange(0, 60)
            parts += [passage[cut : len(passage) - rng.randrange(0, 60)], sentence(rng, rng.randrange(1, 40))]
        texts.append(" ".join(parts))
    return [*texts, texts[0], texts[0], passages[4], "ab" * 600, "z" * 1500, "é" * 450, sentence(rng, 9000), *odd_texts()]


@pytest.mark.parametrize("bucket", [run_index.BUCKET_BYTES, 2000])
def test_same_as_plain_python(spark, monkeypatch, bucket):
    """With small buckets every shared passage is split by the bytes around it."""
    monkeypatch.setattr(run_index, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(run_index, "INDEX_BYTES", 5000)
    docs = list(enumerate(repeated_texts(random.Random(8))))
    given = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, t int, anchors int")
    found = run_index.removal(given)
    rows = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha256 or brute.sha(bytes(r.kept))) for r in found.collect())
    assert rows == sorted(brute.removed(docs, run_index.LENGTH))
    assert sum(r[2] for r in rows) > 5000


def test_null_ids_and_empty_table(spark):
    text = "word " * 100
    given = spark.createDataFrame([(None, text), (None, text), (3, None)], "doc_id bigint, text string")
    rows = sorted((tuple(r)[:4] for r in run_index.removal(given).collect()), key=repr)
    assert rows == [(3, 0, 0, 0), (None, 500, 500, 1), (None, 500, 500, 1)]
    assert run_index.removal(given.limit(0)).count() == 0
