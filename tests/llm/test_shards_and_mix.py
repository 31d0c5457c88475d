import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from shelfseek.llm import pfair, ranks, sharding
from tables import odd_texts, sentence


@pytest.fixture(params=[ranks.ROWS_PER_BLOCK, 5])
def blocks(request, monkeypatch):
    monkeypatch.setattr(ranks, "ROWS_PER_BLOCK", request.param)


def some_docs(rng):
    rows = [(i, sentence(rng, rng.randrange(1, 60))) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(120)]
    rows += [(600 + k, t) for k, t in enumerate(odd_texts())]
    return [*rows, (None, "x"), (None, "x"), rows[3], rows[3]]


def test_shards(spark, blocks):
    rows = some_docs(random.Random(1))
    docs = spark.createDataFrame([(*r, 9, "s") for r in rows], "doc_id bigint, text string, shard int, size string")
    found = sharding.shard(docs, 7).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows if i is not None
    )
    shards = defaultdict(list)
    for r in found:
        shards[r.shard].append(r)
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert set(shards) <= set(range(7)) and len({(r.text_crc32, r.shard) for r in found}) == len({r.text_crc32 for r in found})
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}


def test_largest_shard_is_smallest_possible(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BINS", 40)
    rows = some_docs(random.Random(2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    groups = sharding.measured(docs).groupBy("_text").agg(F.sum("size").alias("_bytes")).collect()
    total = sum(r._bytes for r in groups)
    atoms = defaultdict(int)
    for r in groups:
        place = (r._text % sharding.RANGE) * 40 // sharding.RANGE
        atoms[(place, r._text if r._bytes * 40 > total else -(1 << 63) - 1)] += r._bytes
    best = brute.greedy_capacity([atoms[k] for k in sorted(atoms)], 7)
    sizes = [r[0] for r in sharding.shard(docs, 7).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert sum(sizes) == total and max(sizes) == best


def test_empty_and_single(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert [(r.shard, r.slot, r.size, r.text_crc32) for r in sharding.shard(docs).collect()] == [(0, 0, 16, 0)]
    assert sharding.shard(docs.limit(0)).count() == 0
    assert pfair.mix_schedule(docs.withColumn("source", F.lit(None).cast("string")).limit(0)).count() == 0


def test_mix_stays_within_a_block_of_the_weights(spark, blocks):
    rng = random.Random(3)
    counts = {"a": 500, "b": 230, "c": 120, None: 75}
    rows = [(rng.randrange(10**6), s, f"text {s}", 1) for s, n in counts.items() for _ in range(n)]
    rows += [(None, "a", None, 1), (None, "a", None, 1), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, position int")
    targets = {"a": 0.5, "b": 0.2, "c": 0.2, None: 0.1, "absent": 3.0}
    found = sorted(pfair.mix_schedule(docs, targets, period=100, block_rows=10).collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(len(rows)))
    assert Counter((r.doc_id, r.source) for r in found) == Counter((r[0], r[1]) for r in rows)
    assert all(r.release <= r.slot < r.deadline for r in found)
    slots = {r.slot: r.source for r in found}
    assert len(slots) == len({(r.source, r.block) for r in found})
    total = sum(w for s, w in targets.items() if s != "absent")
    ran, last = Counter(), {s: max(k for k, v in slots.items() if v == s) for s in counts}
    for slot in range(min(last.values())):
        ran[slots[slot]] += 1
        for s in counts:
            # Weights become whole units of the period: one hundredth at most beside the target.
            assert abs(ran[s] - (slot + 1) * targets[s] / total) < 1 + 0.02 * (slot + 1)
    mixed = pfair.mix(docs, targets, period=100, block_rows=10)
    assert mixed.schema == docs.schema
    assert [(r.doc_id, r.source) for r in mixed.collect()] == [(r.doc_id, r.source) for r in found]


def test_slots_of_the_pipelines_shards_follow_the_mix(spark, blocks):
    rng = random.Random(4)
    rows = [(i, rng.choice("aaab"), None if i % 50 == 0 else sentence(rng, 20)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    place = {r.doc_id: r.position for r in mixed.collect()}
    expected = {r.doc_id: r.position for r in pfair.mix_schedule(docs).collect()}
    assert place == expected and mixed.columns == [*docs.columns, "position"]
    shards = defaultdict(list)
    for r in corpus_pipeline.cut_shards(spark, mixed, "").collect():
        shards[r.shard].append((r.slot, place[r.doc_id]))
    for own in shards.values():
        assert [slot for slot, _ in sorted(own)] == list(range(len(own)))
        assert [at for _, at in sorted(own)] == sorted(at for _, at in own)


def test_schedule_is_pfair(spark):
    sources = spark.createDataFrame([(f"+{k}", 1000, w) for k, w in enumerate([5.0, 3.0, 1.0, 1.0, 0.3])], "_source string, _rows bigint, _weight double")
    rows = pfair.schedule(pfair.units(sources, 200)).orderBy("_slot").collect()
    assert [r._slot for r in rows] == list(range(200))
    ran = Counter()
    for t, r in enumerate(rows):
        assert r._turn == ran[r._source]
        ran[r._source] += 1
        for name, units in {x._source: x._units for x in rows}.items():
            assert abs(ran[name] - (t + 1) * units / 200) < 1
    assert sum({r._source: r._units for r in rows}.values()) == 200
    assert math.isclose(ran["+0"] / 200, 5 / 10.3, abs_tol=0.02)


def test_too_many_sources_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(pfair, "MAX_SOURCES", 2)
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id bigint, source string")
    with pytest.raises(Exception, match="more than 2 sources"):
        pfair.mix_schedule(docs).collect()
