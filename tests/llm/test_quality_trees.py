import random

import numpy as np
import pyarrow as pa

import brute
from shelfseek.llm import quality_trees
from tables import odd_texts, sentence

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def texts(rng):
    made = [sentence(rng, rng.randrange(1, 200)) for _ in range(30)]
    made += [("a line " * 3 + "\n") * 9, "x y z " * 60, "#*$ %&| <>", sentence(rng, 20_000), "é " * 60]
    return made + odd_texts()


def test_counts_are_those_of_plain_python():
    given = texts(random.Random(1))
    base, x = quality_trees.statistics(pa.array(given, pa.string()))
    assert [tuple(int(base[c][k]) for c in COUNTS) for k in range(len(given))] == [brute.quality_counts(t) for t in given]
    assert np.isfinite(x).all()


def test_trees_follow_labels_and_constraints():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality_trees.FEATURES)))
    symbols = quality_trees.FEATURES.index("symbol_share")
    y = ((x[:, 0] > 0.5) & (x[:, symbols] < 0.7)).astype(float)
    trees = quality_trees.fit(x, y)
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.98
    for name in quality_trees.MONOTONIC:
        f = quality_trees.FEATURES.index(name)
        steps = np.repeat(rng.random((50, x.shape[1])), 40, axis=0)
        steps[:, f] = np.tile(np.linspace(0, 1, 40), 50)
        scores = trees.margin(steps).reshape(50, 40)
        assert (np.diff(scores, axis=1) <= 1e-9).all()


def test_kept_rows(spark):
    rng = random.Random(2)
    given = [(i, sentence(rng, 80) if i % 2 else " ".join(w + "%%%" for w in sentence(rng, 80).split())) for i in range(200)]
    given += [(900, None), (901, "short"), (None, sentence(rng, 80)), (902, "same words here " * 40), given[1]]
    docs = spark.createDataFrame([(*g, 1) for g in given], "doc_id bigint, text string, n_words int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] + [(None, 1), (151, None), (3, 1)], "doc_id bigint, quality int")
    found = quality_trees.assess(docs, quality_trees.fit_quality(docs, labels)).collect()
    assert len(found) == len(given)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].kept == bool(i % 2) for i in range(150, 200))
    assert by_id[None].kept and by_id[900].base_failed and by_id[901].base_failed and by_id[902].base_failed
    assert not any(r.kept for r in found if r.base_failed)
    untrained = quality_trees.fit_quality(docs, labels.limit(0))
    assert all(r.kept != r.base_failed for r in quality_trees.assess(docs, untrained).collect())
    assert quality_trees.assess(docs.limit(0), untrained).count() == 0
