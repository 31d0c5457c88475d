import random

import pytest

from shelfseek.llm import toxicity
from tables import odd_texts, sentence


@pytest.mark.parametrize(
    "text, folded",
    [
        ("Idiot!", " idiot "),
        ("1d10t", " idiot "),
        ("іԁіоt", " idiot "),
        ("ＩＤＩＯＴ", " idiot "),
        ("ïd!öt, a$$es", " idiot asses "),
        ("i​díot", " idiot "),
        ("", " "),
        ("?!", " "),
    ],
)
def test_folding(text, folded):
    assert toxicity.fold(text) == folded


def test_matching_keeps_the_heaviest_entry_and_heeds_exceptions():
    lexicon = toxicity.Lexicon({" fooi ": 2.0, " foo": 1.0}, (" no fooi ",))
    machine = lexicon.automaton()
    assert list(toxicity.matches(machine, " a fooi foox ").values()) == [2.0, 1.0]
    assert toxicity.matches(machine, " no fooi ") == {}
    assert toxicity.matches(toxicity.Lexicon().automaton(), " fooi ") == {}


def labelled(rng):
    rows = []
    for i in range(600):
        text = sentence(rng, 40).split()
        toxic = i % 5 == 0
        if toxic:
            text[3] = rng.choice(["dunce", "vexpat" + rng.choice("abcdefgh"), "lout"])
        elif i % 40 == 1:
            text[7:8] = ["proud", "dunce"]
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_learned_on_labels_and_measured_on_others(spark):
    rng = random.Random(3)
    rows = labelled(rng)
    extra = [(900 + k, t) for k, t in enumerate(odd_texts())] + [(None, "what a DUNC3"), (950, "my proud dunce"), (951, sentence(rng, 20_000))]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t, _ in rows] + [(*e, 0.1, None) for e in extra], "doc_id bigint, text string, score double, label string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (1, None), (2, 0)], "doc_id bigint, toxic int")
    lexicon = toxicity.learn(docs, toxicity.training_labels(labels))
    found = {r.doc_id: r for r in toxicity.score_texts(docs, lexicon).collect()}
    held = [(found[i].predicted, y) for i, _, y in rows if found[i].held_out]
    assert len(held) > 80 and sum(p == y for p, y in held) / len(held) > 0.97
    assert found[None].predicted == 1 and found[950].predicted == 0
    assert all(0 <= r.score <= 1 for r in found.values())
    assert all(found[900 + k].predicted == 0 for k in range(len(odd_texts())))
    kept = toxicity.clean_texts(docs, lexicon)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in found.items() if not r.predicted)


def test_rare_entries_are_learned_from_many_toxic_texts(spark):
    """A word in five toxic texts and no clean one counts among 800 toxic texts as it does among 80."""
    rng = random.Random(4)
    for n in (80, 800):
        rows = [(i, sentence(rng, 20) + (" dunce" if i < n else "") + (" zorvik" if i < 5 else ""), int(i < n)) for i in range(3 * n)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
        lexicon = toxicity.learn(docs, docs)
        assert toxicity.matches(lexicon.automaton(), toxicity.fold("a zorvik"))


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "dunce"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert [r.predicted for r in toxicity.score_texts(docs, lexicon).collect()] == [0, 0]
    assert toxicity.score_texts(docs.limit(0), lexicon).count() == 0
