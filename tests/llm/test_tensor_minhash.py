import random

import numpy as np
import pytest

import brute
from shelfseek.llm import tensor_minhash
from tables import odd_texts, sentence


def near_texts(rng):
    texts = []
    for n in (12, 40, 150):
        base = sentence(rng, n).split()
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, n // 25))):
                own[rng.randrange(n)] = "changed" + str(rng.randrange(100))
            texts.append(" ".join(own))
    shared = sentence(rng, 60)
    texts += [f"{sentence(rng, 40)} {shared} {sentence(rng, 30)}" for _ in range(30)]
    # A chain: neighbours are near, ends are not.
    words = sentence(rng, 160).split()
    texts += [" ".join(words[k * 6 : k * 6 + 100]) for k in range(10)]
    texts += [sentence(rng, 30) for _ in range(20)]
    rng.shuffle(texts)
    return [*texts, *texts[:5], texts[0].upper(), *odd_texts(), "a  b\nc d", sentence(rng, 20_000)]


@pytest.mark.parametrize("bucket", [tensor_minhash.MAX_PAIRS, 20])
def test_same_as_plain_python(spark, monkeypatch, bucket):
    """With small buckets the tables get further factors."""
    monkeypatch.setattr(tensor_minhash, "MAX_PAIRS", bucket)
    docs = list(enumerate(near_texts(random.Random(4))))
    given = spark.createDataFrame([(*d, 7, "c") for d in docs], "doc_id bigint, text string, node int, u string")
    found = tensor_minhash.near_duplicates(given)
    expected = brute.near_components(docs)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert len({row[2] for row in expected}) < len(docs) - 20
    kept = tensor_minhash.one_of_each(given)
    assert kept.schema == given.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(row[0] for row in expected if row[3])


def test_odd_ids(spark):
    text = "one two three four five six"
    rows = [(None, text), (None, text), (4, text), (4, text), (4, "quite another text here with words"), (5, None), (5, None)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((tuple(r) for r in tensor_minhash.near_duplicates(given).collect()), key=repr)
    assert found == sorted(
        [(None, 2, 4, False), (None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (4, 2, 4, True), (5, 0, 5, True), (5, 0, 5, True)],
        key=repr,
    )
    kept = tensor_minhash.one_of_each(given).collect()
    assert len(kept) == 4 and sum(r.text == text for r in kept) == 1
    assert tensor_minhash.near_duplicates(given.limit(0)).count() == 0
    assert tensor_minhash.one_of_each(given.limit(0)).count() == 0


def near_copies(n, words=200):
    rng = random.Random(n)
    base = sentence(rng, words).split()
    texts = []
    for k in range(n):
        own = list(base)
        own[rng.randrange(words)] = f"own{k}"
        texts.append(" ".join(own))
    return texts


def test_a_copy_is_confirmed_once_and_not_for_every_centre(spark, monkeypatch):
    """Texts sent to centres grow with the group, at most about one for each copy."""
    sent = []
    kept = tensor_minhash.stored

    def counting(df, name):
        held = kept(df, name)
        if name == "minhash-chosen":
            sent.append(held.count())
        return held

    monkeypatch.setattr(tensor_minhash, "stored", counting)
    for n in (60, 240):
        sent.clear()
        docs = spark.createDataFrame(list(enumerate(near_copies(n))), "doc_id bigint, text string")
        found = tensor_minhash.near_duplicates(docs).collect()
        assert {r.component_id for r in found} == {0}
        assert n // 2 <= sum(sent) <= 1.2 * n


def test_a_node_of_many_buckets_is_joined_once(spark):
    """What is known of a node meets its list of buckets, not each of them."""
    places = spark.createDataFrame([(k, n, k + n) for n in range(5) for k in range(40)], "key bigint, node bigint, label bigint")
    known = spark.createDataFrame([(n, f"text {n}") for n in (0, 1, 2, 3, 3, 9)], "node bigint, text string")
    found = tensor_minhash.met_once(places, known)
    columns = ("key", "node", "label", "text")
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(map(tuple, places.join(known, "node").select(*columns).collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Join [node") < plan.index("collect_list")


def test_rows_without_ids_are_looked_up_by_their_texts(spark):
    docs = spark.createDataFrame([(None, t) for t in near_copies(30)] + [(None, "x y")] * 3, "doc_id bigint, text string")
    nodes = tensor_minhash.node_table(tensor_minhash.sketches(docs, "doc_id", "text"))
    texts = tensor_minhash.texts_of(nodes.select("node"), nodes, docs, "doc_id", "text")
    assert texts.count() == 33
    assert len(tensor_minhash.one_of_each(docs).collect()) == 2


def edited_copies(n, words=120, edits=3):
    """Copies that are alike, but mostly not near enough to be linked."""
    rng = random.Random(n)
    base = sentence(rng, words).split()
    texts = []
    for k in range(n):
        own = list(base)
        for at in rng.sample(range(words), edits):
            own[at] = f"own{k}at{at}"
        texts.append(" ".join(own))
    return texts


def test_a_large_bucket_is_cut_once(spark, monkeypatch):
    """It was spread over more and more keys, of which one was always its own, and all texts were looked up each time."""
    monkeypatch.setattr(tensor_minhash, "MAX_PAIRS", 100)
    written = {}
    kept = tensor_minhash.stored

    def counting(df, name):
        held = kept(df, name)
        written.setdefault(name, []).append(held.count())
        return held

    monkeypatch.setattr(tensor_minhash, "stored", counting)
    docs = list(enumerate(edited_copies(60)))
    found = tensor_minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted(map(tuple, found.collect())) == sorted(brute.near_components(docs))
    assert len(written["minhash-open"]) == len(written["minhash-found"]) == 1
    # Looked up once for the stars and once for the buckets.
    assert len(written["minhash-ids"]) == 2
    assert written["minhash-open"][0] < written["minhash-met"][0] <= 12 * written["minhash-open"][0]


def test_every_pair_of_components_meets(spark, monkeypatch):
    monkeypatch.setattr(tensor_minhash, "MAX_PAIRS", 30)
    monkeypatch.setattr(tensor_minhash, "MAX_SHINGLES", 400)
    labels = [0] * 40 + [1] * 5 + list(range(2, 12))
    rows = [(key, 0, node, label, 10) for key in (7, 8) for node, label in enumerate(labels) if key == 7 or node in (0, 54)]
    buckets = spark.createDataFrame(rows, "key bigint, i int, node bigint, label bigint, n_shingles bigint")
    met = {}
    for r in tensor_minhash.cut(tensor_minhash.unresolved(buckets)).collect():
        met.setdefault(r.key, set()).add((r.node, r.label))
    pairs = {(u, v) for nodes in met.values() for u, p in nodes for v, q in nodes if u < v and p != q}
    assert pairs == {(u, v) for u, p in enumerate(labels) for v, q in enumerate(labels) if u < v and p != q}
    assert met[8] == {(0, 0), (54, 11)}
    assert max(map(len, met.values())) < 35


def test_rows_that_stay_are_not_listed(spark, monkeypatch):
    """Only keys that go or come again are looked up, not all texts that stay."""
    listed = []
    kept = tensor_minhash.stored

    def counting(df, name):
        held = kept(df, name)
        if name in ("minhash-kept", "minhash-other"):
            listed.append(held.count())
        return held

    monkeypatch.setattr(tensor_minhash, "stored", counting)
    rng = random.Random(3)
    texts = [sentence(rng, 30) for _ in range(30)]
    rows = [*enumerate([*texts, *texts[:4]]), (2, texts[2]), (50, "")]
    found = tensor_minhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in found.collect()) == [*range(30), 50]
    assert listed == [5]


def test_links_of_a_bucket():
    """Against all pairs of random sets, whose links may join in any order."""
    rng = random.Random(9)
    for _ in range(40):
        base = [rng.sample(range(2000), rng.randrange(1, 60)) for _ in range(4)]
        sets = [
            np.array(sorted({x if rng.random() > rng.choice((0, 0.1, 0.2)) else rng.randrange(2000) for x in rng.choice(base)}), np.uint64)
            for _ in range(30)
        ]
        nodes = np.array(rng.sample(range(10_000), 30))
        labels = np.array([rng.randrange(12) for _ in nodes])
        links = tensor_minhash.joining(nodes, labels, sets)
        linked = {}
        for u in range(30):
            for v in range(u):
                both = len(set(sets[u].tolist()) & set(sets[v].tolist()))
                linked[tuple(sorted((int(nodes[u]), int(nodes[v]))))] = 100 * both >= 75 * (len(sets[u]) + len(sets[v]) - both)
        assert all(linked[pair] for pair in links)

        def parts(pairs):
            label_of = dict(zip(nodes.tolist(), labels.tolist(), strict=True))
            group = {x: x for x in set(label_of.values())}
            for u, v in pairs:
                p, q = group[label_of[u]], group[label_of[v]]
                group = {x: q if g == p else g for x, g in group.items()}
            return len(set(group.values())), {frozenset(x for x in group if group[x] == g) for g in group.values()}

        assert parts(links) == parts([pair for pair, near in linked.items() if near])
        assert len(links) == len(set(labels.tolist())) - parts(links)[0]
