"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfseek.llm import collocations as c

SCHEMA = "doc_id bigint, text string, lang string, n bigint, id string"


def brute(rows, min_count, top, share=100, max_words=5):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang in f:
        found = {p: a for p, a in f[lang].items() if a >= min_count}
        rows_ = []
        for p, a in found.items():
            if len(p) < 2:
                continue
            inside = any(
                len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items()
            )
            if inside:
                continue
            cuts = [(1000 * a * n[lang] // (f[lang][p[:k]] * f[lang][p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows_.append((-score, -a, " ".join(p).encode(), f[lang][p[:k]], f[lang][p[k:]]))
        out += [(lang, i + 1, s[2].decode(), -s[1], s[3], s[4], n[lang], -s[0]) for i, s in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def texts():
    rng = random.Random(11)
    words = ["the", "of", "New", "york", "city", "é", "中文", "a", "a", "x" * 90, "b", "c"]
    fixed = ["new york city hall", "the end of the", "a a a", "b c b c b", "x" * 90 + " of", "É é the"]
    rows = []
    for i in range(120):
        parts = [rng.choice(fixed) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randrange(0, 25))]
        rows.append((rng.choice([" ", "  ", "\t", ", ", " . ", "\n", " "]).join(parts), rng.choice(["en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", None), (" \t ", "en"), ("...", "xx"), ("one", "yy"), ("a b " * 3000, "en"), ("new york " * 40, "fr")]
    return rows


@pytest.mark.parametrize("known", [4, 1 << 17])
@pytest.mark.parametrize("row_ids", [5, 1024])
def test_as_plain_counting(spark, monkeypatch, known, row_ids):
    monkeypatch.setattr(c, "ROW_IDS", row_ids)
    monkeypatch.setattr(c, "TILE", 2)
    rows = texts()
    docs = spark.createDataFrame([(i, t, l, 1, "") for i, (t, l) in enumerate(rows)], SCHEMA).repartition(3)
    for share, top in ((100, 2000), (60, 3)):
        found = c.collocations(docs, min_count=8, top=top, share=share, known=known)
        assert sorted(tuple(r) for r in found.collect()) == brute(rows, 8, top, share)


def test_no_texts_and_no_frequent_words(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert c.collocations(spark.createDataFrame([(1, "one two", "en", 1, "")], SCHEMA)).collect() == []
    same = spark.createDataFrame([(1, "one. " * 200, "en", 1, "")], SCHEMA)
    assert c.collocations(same).collect() == []


def test_scores_beyond_64_bits(spark):
    a, total, left, right = 10**12, 9 * 10**14, 3 * 10**12, 7 * 10**12
    row = spark.sql(
        f"SELECT {a}L AS n, {total}L AS total, array({left}L, {right}L) AS firsts, array({right}L, {a}L) AS rests"
    ).selectExpr(c.CUT_SCORES + " AS scores")
    assert row.first().scores == [1000 * a * total // (left * right), 1000 * a * total // (right * a)]


def test_pairs_in_dense_tiles_and_as_coordinates():
    left, right = np.array([1, 1, 5, 5, 5]), np.array([2, 2, 1, 3, 3])
    made = c.coordinates(left, right).to_pydict()
    assert made == {"left": [1, 5, 5], "right": [2, 1, 3], "n": [2, 1, 2]}
    assert c.coordinates(left[:0], right[:0]).num_rows == 0
