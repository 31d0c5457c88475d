import random

import pytest
from pyspark.sql import functions as F

import brute
from shelfseek.llm import decontaminate
from tables import odd_texts, sentence

DOCS = "doc_id bigint, text string, items string, _cuts string"


def cases(rng):
    items = [(i, sentence(rng, rng.choice([3, 9, 10, 12, 40]))) for i in range(8)] + [(8, None), (9, ""), (10, "..."), (None, "zebra")]
    items.append((3, items[3][1]))
    docs = []
    for i in range(40):
        text = sentence(rng, 60)
        if i % 3 == 0:
            text += " " + rng.choice(items[:8])[1].upper().replace(" ", "-") + ". " + sentence(rng, 20)
        docs.append((i, text))
    docs += [(100 + k, t) for k, t in enumerate(odd_texts())]
    return docs + [(200, items[2][1]), (201, "a Zebra!"), (None, items[3][1]), (202, sentence(rng, 30_000) + " zebra"), docs[0], docs[0]], items


@pytest.mark.parametrize("part_bytes", [1 << 20, 1500])
def test_same_as_plain_python(spark, part_bytes):
    docs, items = cases(random.Random(5))
    given = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contamination(given, benchmark, part_bytes=part_bytes)
    found = found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint"), F.sha2(F.array_join(F.array_sort("items"), ","), 256), "contaminated"
    )
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute.contamination(docs, items), key=repr)


@pytest.mark.parametrize("part_bytes", [1 << 20, 1500])
def test_drop_and_cut(spark, part_bytes):
    docs, items = cases(random.Random(6))
    given = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    dirty = [row[-1] for row in brute.contamination(docs, items)]
    kept = decontaminate.decontaminate(given, benchmark, part_bytes=part_bytes)
    assert kept.schema == given.schema
    expected = [(*d, "x", "y") for d, hit in zip(docs, dirty, strict=True) if not hit]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(expected, key=repr)
    cut = decontaminate.decontaminate(given, benchmark, drop=False, part_bytes=part_bytes)
    assert cut.schema == given.schema and cut.count() == len(docs)
    by_id = {r.doc_id: r.text for r in cut.collect()}
    assert by_id[201] == "a !" and by_id[200] == ""
    assert by_id[1] == docs[1][1]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert [tuple(r)[:3] for r in decontaminate.contamination(docs, nothing).collect()] == [(1, 2, 0)]
    assert decontaminate.contamination(docs.limit(0), nothing).count() == 0
    assert decontaminate.decontaminate(docs, nothing).count() == 1
