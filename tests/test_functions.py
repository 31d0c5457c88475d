import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import values
from shelfseek.functions import (
    dot_product,
    dot_product_columns,
    has_term,
    json_field,
    json_text,
    match_terms,
    parse_object,
    term_counts,
    tokenize,
    vector_enforce,
    with_property,
)
from shelfseek.functions import text
from shelfseek.functions.embedding import Caller, HashEmbedder, ModelEmbedder, Patience, Refused
from shelfseek.functions.vectors import vector_parameter


def test_vector_enforce(spark):
    rows = [([1.0, 2.0],), ([1.0],), ([1.0, 2.0, 3.0],), ([],), (None,), ([1.0, None],), ([1.0, math.nan],)]
    df = spark.createDataFrame(rows, "v array<double>")
    assert values(df.select(vector_enforce(F.col("v"), 2).alias("v")), "v") == [[1.0, 2.0]] + [None] * 6


def test_vector_enforce_reads_numeric_text_only(spark):
    df = spark.createDataFrame([(["1", "2.5"],), (["1", "x"],)], "v array<string>")
    assert values(df.select(vector_enforce(F.col("v"), 2).alias("v")), "v") == [[1.0, 2.5], None]


def test_dot_products(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, None), (3, [1.0, None]), (4, []), (5, [0.5, -1.0])]
    df = spark.createDataFrame(rows, "id int, v array<float>").coalesce(1)
    found = df.select("id", dot_product(F.col("v"), [3.0, 4.0]).alias("s")).orderBy("id")
    assert values(found, "s") == [11.0, None, None, None, None, -2.5]
    query = F.array(F.lit(3.0), F.lit(4.0))
    found = df.select("id", dot_product_columns(F.col("v"), query).alias("s")).orderBy("id")
    assert values(found, "s") == [11.0, None, None, None, None, -2.5]


def test_dot_product_sums_left_to_right(spark):
    rng = np.random.default_rng(1)
    matrix = rng.standard_normal((50, 1536)).astype(np.float32)
    query = rng.standard_normal(1536).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "id int, v array<float>")
    found = dict(values(df.select("id", dot_product(F.col("v"), query).alias("s")), "id", "s"))
    for i, row in enumerate(matrix):
        total = 0.0
        for x, y in zip(row, query):
            total += float(x) * float(y)
        assert found[i] == total


def test_vector_parameter():
    assert vector_parameter("[1, 2.5]", 2) == [1.0, 2.5]
    for bad in ("[]", "[1, null]", "{}", "[1, 2", [float("nan")], "5"):
        with pytest.raises((ValueError, TypeError)):
            vector_parameter(bad)
    with pytest.raises(ValueError):
        vector_parameter([1.0], 2)


def test_tokenize(spark):
    rows = [("By Sony PlayStation®-2!",), ("",), (None,), ("...",), ("Éçole ÄÖ ß 日本 x1",)]
    df = spark.createDataFrame(rows, "t string")
    assert values(df.select(tokenize(F.col("t")).alias("k")), "k") == [
        ["by", "sony", "playstation", "2"], [], None, [], ["éçole", "äö", "ß", "日本", "x1"],
    ]


def test_term_predicates(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), ([],), (None,)], "k array<string>")
    tokens = F.col("k")
    found = df.select(
        has_term(tokens, "a").alias("has"),
        match_terms(tokens, ["a", "b", "a"]).alias("any"),
        match_terms(tokens, ["a", "b", "a"], match_all=True).alias("every"),
        match_terms(tokens, ["A"]).alias("upper"),
    )
    assert values(found, "has", "any", "every", "upper") == [
        (True, True, True, False), (True, True, False, False), (False,) * 4, (False,) * 4,
    ]


def test_term_counts(spark):
    rows = [(0, ["a", "b", "a"]), (1, []), (2, None), (3, ["c", None, "c"]), (4, ["b"])]
    df = spark.createDataFrame(rows, "id int, k array<string>").coalesce(1)
    found = df.select("id", term_counts(F.col("k")).alias("c")).orderBy("id")
    assert [sorted((t.term, t.tf) for t in c or []) for c in values(found, "c")] == [
        [("a", 2), ("b", 1)], [], [], [("c", 2)], [("b", 1)],
    ]


RECORDS = [
    ('{"asin":"1","description":"he said \\"hi\\"","n":{"b":1.5,"a":null}}', 'he said "hi"'),
    ('{"asin":"2","description":null}', None),
    ('{"asin":"3"}', None),
    ('{"asin":"4","description":{"x":1}}', '{"x":1}'),
    ("not json", None),
    ("[1]", None),
    ("null", None),
    (None, None),
]


def test_parse_and_read_fields(spark):
    df = spark.createDataFrame([(v,) for v, _ in RECORDS], "value string")
    record = parse_object(F.col("value"))
    found = df.select(
        record.isNotNull().alias("ok"), json_text(json_field(record, "description")).alias("d")
    )
    assert values(found, "ok") == [True] * 4 + [False] * 4
    assert values(found, "d") == [d for _, d in RECORDS]
    encoded = df.select(json_text(json_field(record, "description"), encoded=True).alias("d"))
    assert values(encoded, "d")[0] == '"he said \\"hi\\""'


def test_with_property_keeps_other_fields(spark):
    df = spark.createDataFrame([('{"z":{"b":[1,null]},"e":0,"a":null}',), ("[1]",)], "value string")
    added = with_property(parse_object(F.col("value")), "e", F.array(F.array(F.lit(0.5))))
    assert values(df.select(added.alias("j")), "j") == ['{"a":null,"z":{"b":[1,null]},"e":[[0.5]]}', None]


def test_hash_embedder(spark):
    df = spark.createDataFrame([("a a b",), ("",), (None,), ("!!",), ("b",)], "t string").coalesce(1)
    found = values(df.select(HashEmbedder(16)(F.col("t")).alias("v")), "v")
    assert [v is None for v in found] == [False, True, True, True, False]
    assert sorted(x for x in found[0] if x) == [1 / math.sqrt(5), 2 / math.sqrt(5)]
    assert max(found[4]) == 1.0 and len(found[4]) == 16


QUICK = Patience(calls_per_second=1000, attempts=4, first_wait=0.001, longest_wait=0.01)


def test_refused_calls_are_tried_again():
    calls = []

    def client(texts):
        calls.append(list(texts))
        if len(calls) % 3:
            raise [Refused("busy", after=0.002), TimeoutError()][len(calls) % 2]
        return [[float(len(t))] for t in texts]

    caller = Caller(client, QUICK)
    assert caller.vectors(["a", "bb"]) == [[1.0], [2.0]] and caller.vectors(["ccc"]) == [[3.0]]
    assert calls == [["a", "bb"]] * 3 + [["ccc"]] * 3


def test_a_model_that_stays_away_is_an_error_and_a_bad_text_is_not():
    def away(texts):
        raise ConnectionError("nobody there")

    with pytest.raises(ConnectionError):
        Caller(away, QUICK).vectors(["a", "b"])
    calls = []

    def picky(texts):
        calls.append(len(texts))
        if "bad" in texts:
            raise KeyError("bad")
        return [[1.0] for _ in texts]

    texts = [f"t{i}" for i in range(64)]
    texts[37] = "bad"
    found = Caller(picky, QUICK).vectors(texts)
    assert found == [None if t == "bad" else [1.0] for t in texts] and len(calls) == 13

    class Overloaded(Exception):
        pass

    with pytest.raises(Overloaded):
        Caller(lambda texts: (_ for _ in ()).throw(Overloaded()), QUICK, (Overloaded,)).vectors(["a"])


def test_calls_are_spaced_and_waits_grow():
    times = []
    caller = Caller(lambda texts: times.append(time.monotonic()) or [[0.0]], Patience(calls_per_second=50))
    for _ in range(5):
        caller.vectors(["x"])
    assert min(b - a for a, b in zip(times, times[1:])) > 0.015
    waits = list(Patience(attempts=8, first_wait=1, longest_wait=10).waits(random.Random(1)))
    assert len(waits) == 7 and all(0.5 * min(10, 2**k) <= w <= min(10, 2**k) for k, w in enumerate(waits))


def test_model_embedder_fails_record_by_record(spark):
    def make_client():
        def client(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("refused")
            return [[float(len(t)), 1.0] for t in texts]

        return client

    df = spark.createDataFrame([("x",), ("bad",), (None,), ("xyz",)], "t string").coalesce(1)
    found = values(df.select(ModelEmbedder(make_client, 2, texts_per_call=2)(F.col("t")).alias("v")), "v")
    assert found == [[1.0, 1.0], None, None, [3.0, 1.0]]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=6), min_size=1, max_size=12))
def test_term_counts_add_up(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "id int, k array<string>").coalesce(2)
    found = dict(values(df.select("id", term_counts(F.col("k")).alias("c")), "id", "c"))
    for i, tokens in enumerate(lists):
        assert {t.term: t.tf for t in found[i]} == {t: tokens.count(t) for t in tokens}


def test_terms_are_counted_in_bounded_slices(monkeypatch):
    """However many rows a batch has, no more than so many tokens (or one row) are counted at a time."""
    lists = [["a", "b", "a"], None, [], ["b"] * 5, ["c", None], ["a"]] * 50
    whole = text.counted_rows(pa.array(lists, pa.list_(pa.string()))).to_pylist()
    sizes, counted_rows = [], text.counted_rows
    monkeypatch.setattr(text, "COUNTED_AT_ONCE", 7)
    monkeypatch.setattr(text, "counted_rows", lambda rows: sizes.append(len(rows.flatten())) or counted_rows(rows))
    ordered = lambda rows: [sorted((d["term"], d["tf"]) for d in row) for row in rows]
    for given in (lists, [*lists, ["z"] * 20, ["y"]], []):
        sizes.clear()
        found = text.term_counts.func(pa.array(given, pa.list_(pa.string())))
        assert ordered(found.to_pylist())[: len(lists)] == ordered(whole)[: len(given)]
        assert len(found) == len(given) and sum(n > 7 for n in sizes) == (len(given) > len(lists))
