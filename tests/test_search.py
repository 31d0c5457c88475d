import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from frames import products, values
from shelfseek.functions.embedding import HashEmbedder
from shelfseek.operators import ann, batch_search, collection as store, text_index as text_index_module
from shelfseek.operators.batch_search import batch_full_text_search, batch_vector_search
from shelfseek.operators.blocks import BlockSizes, meet_by_key
from shelfseek.operators.compare import compare_searches
from shelfseek.operators.search import full_text_search, vector_search
from shelfseek.operators.text_index import save_index, text_index
from shelfseek.plans.sql_forms import create_search_functions
from shelfseek.plans.named import run_named, typed_parameters, vector_search_sql
from shelfseek.scratch import new_folder

BY_KEY = BlockSizes(broadcast_bytes=0, documents=7, questions=3)
QUERY_SCHEMA = "query_id int, min_price double, max_price double, brand string"
SHELF = [
    ("a", "by Sony PlayStation", "space wars and space", 10.0, [1.0, 0.0]),
    ("b", "Sony PlayStation", "wars", 0.0, [0.6, 0.8]),
    ("c", "PLAYSTATION", "space", 50.0, [0.0, 1.0]),
    ("d", "by", "space wars", 20.0, [1.0, 0.0]),
    ("e", None, "space wars", 20.0, [1.0, 0.0]),
    ("f", "play.station playstation!", "space opera", None, None),
    ("g", "playstation", None, 50.01, [1.0, 0.0]),
    ("h", "playstation", None, 5.0, [1.0]),
    ("i", "playstation", "Space wars", 30.0, [0.6, 0.8]),
]


@pytest.fixture(scope="module")
def shelf(spark):
    return products(spark, SHELF).cache()


def test_vector_search_filters_ranks_and_breaks_ties(shelf):
    found = values(vector_search(shelf, [1.0, 0.0]), "asin", "similarity")
    assert [a for a, _ in found] == ["a", "b", "i", "c", "f", "h"]
    assert [s for _, s in found][-2:] == [None, None]
    assert found[0][1] == 1.0 and found[1][1] == found[2][1]


def test_price_range_is_closed_and_default_price_counts(shelf):
    assert values(vector_search(shelf, [1.0, 0.0], 0, 0), "asin") == ["b"]
    assert values(vector_search(shelf, [1.0, 0.0], "30", "30", "PlayStation"), "asin") == ["i", "f"]
    assert values(vector_search(shelf, [1.0, 0.0], 50, 50.01), "asin") == ["g", "c"]


def test_top_k_is_a_prefix_of_top_k_plus_one(shelf):
    longest = values(vector_search(shelf, [0.3, 0.7], limit=9), "asin")
    by_text = values(full_text_search(shelf, limit=9), "asin")
    for k in range(1, 6):
        assert values(vector_search(shelf, [0.3, 0.7], limit=k), "asin") == longest[:k]
        assert values(full_text_search(shelf, limit=k), "asin") == by_text[:k]


def bm25(rows, terms, asin):
    docs = {r[0]: (r[2] or "").lower().split() for r in rows}
    n, average = len(docs), sum(map(len, docs.values())) / len(docs)
    score = 0.0
    for t in terms:
        df, tf, dl = sum(t in d for d in docs.values()), docs[asin].count(t), len(docs[asin])
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        score += idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / average))
    return score


def test_full_text_search_scores(shelf):
    found = dict(values(full_text_search(shelf), "asin", "text_search_score"))
    assert set(found) == {"a", "b", "c", "f", "i"}
    for asin, score in found.items():
        assert score == pytest.approx(bm25(SHELF, ["space", "wars"], asin), abs=1e-12)


@pytest.mark.parametrize("indexed", [False, True])
def test_match_all_terms_and_case(spark, shelf, indexed):
    index = save_index(text_index(shelf), new_folder(spark, "index")) if indexed else None
    every = values(full_text_search(shelf, match_all=True, index=index), "asin")
    some = values(full_text_search(shelf, index=index), "asin")
    assert sorted(every) == ["a", "i"] and set(every) <= set(some)
    assert some == values(full_text_search(shelf), "asin")
    assert values(full_text_search(shelf, ["Space"], index=index), "asin") == []
    lowered = full_text_search(shelf, ["Space"], normalize_terms=True, index=index)
    assert set(values(lowered, "asin")) == {"a", "c", "f", "i"}
    repeated = full_text_search(shelf, ["space", "space", "absent"], index=index)
    once = full_text_search(shelf, ["space"], index=index)
    assert values(repeated, "asin", "text_search_score") == values(once, "asin", "text_search_score")
    three = full_text_search(shelf, ["space", "opera", "wars"], match_all=True, index=index)
    assert values(three, "asin") == []


def test_text_ties_go_by_price_then_asin(spark):
    shelf = products(
        spark, [(a, "x", "same words", p, None) for a, p in [("3", 2.0), ("1", 2.0), ("2", 1.0), ("0", None)]]
    )
    assert values(full_text_search(shelf, ["same"], brand="x"), "asin") == ["2", "1", "3", "0"]


def test_a_search_needs_terms_and_numbers(shelf):
    with pytest.raises(ValueError):
        full_text_search(shelf, [])
    with pytest.raises(ValueError):
        vector_search(shelf, [1.0, 0.0], "cheap")
    with pytest.raises(ValueError):
        vector_search(shelf, [1.0], dims=2)


def random_shelf(spark, n=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vector = [rng.choice([-1.0, 0.25, 0.5, 1.0]) for _ in range(4)] if i % 5 else None
        text = " ".join(rng.choice("one two three four five".split()) for _ in range(rng.randrange(6)))
        brand = "hot" if i % 3 else f"cold{i % 4}"
        rows.append((f"{i:03}", f"by {brand}", text, None if i % 7 == 0 else float(rng.randrange(60)), vector))
    return products(spark, rows, dims=4)


@pytest.mark.parametrize("sizes", [BlockSizes(), BY_KEY])
def test_batch_searches_equal_single_searches(spark, sizes):
    shelf = random_shelf(spark).cache()
    rng = random.Random(5)
    asked = []
    for q in range(10):
        vector = [rng.choice([-1.0, 0.5, 1.0]) for _ in range(4)]
        brand = ["HOT", "cold1", "none"][q % 3]
        asked.append((q, float(q), 45.0, brand, vector, "two  five two" if q % 2 else "three Two"))
    queries = spark.createDataFrame(asked, QUERY_SCHEMA + ", embedding array<double>, text string")
    by_vector = batch_vector_search(shelf, queries, 4, 5, sizes).orderBy("query_id", "rank").collect()
    by_text = batch_full_text_search(shelf, queries, 5).orderBy("query_id", "rank").collect()
    for q, low, high, brand, vector, text in asked:
        single = vector_search(shelf, vector, low, high, brand, 5)
        assert [(r.asin, r.similarity) for r in by_vector if r.query_id == q] == values(single, "asin", "similarity")
        single = full_text_search(shelf, text.split(), low, high, brand, 5)
        assert [(r.asin, r.text_search_score) for r in by_text if r.query_id == q] == values(
            single, "asin", "text_search_score"
        )


def test_batch_match_all_and_index(spark):
    shelf = random_shelf(spark).cache()
    index = text_index(shelf)
    saved = save_index(index, new_folder(spark, "index"))
    queries = spark.createDataFrame([(1, 0.0, 60.0, "hot", "two five"), (2, 0.0, 60.0, "hot", " ")], QUERY_SCHEMA + ", text string")
    for chosen in (None, index, saved):
        found = batch_full_text_search(shelf, queries, 4, match_all=True, index=chosen)
        single = full_text_search(shelf, ["two", "five"], 0, 60, "hot", 4, match_all=True)
        assert values(found.orderBy("rank"), "asin", "text_search_score") == values(single, "asin", "text_search_score")
        assert set(values(found, "query_id")) == {1}


@pytest.mark.parametrize("sizes", [BlockSizes(), BlockSizes(broadcast_bytes=0, documents=20, questions=4)])
def test_one_brand_and_many_copies(spark, sizes):
    """A third of all rows are copies of one product; all rows have the same brand."""
    copies = [(f"c{i:03}", "x", "same text here", 5.0, [1.0, 0.0]) for i in range(100)]
    others = [(f"o{i:03}", "x", f"word{i} text", 5.0, [0.9, 0.1]) for i in range(200)]
    shelf = products(spark, copies + others).cache()
    queries = spark.createDataFrame(
        [(q, 0.0, 9.0, "x", [1.0, 0.0], "same word7") for q in range(9)],
        QUERY_SCHEMA + ", embedding array<double>, text string",
    )
    found = batch_vector_search(shelf, queries, 2, 110, sizes)
    assert found.count() == 9 * 110
    assert found.filter("asin LIKE 'c%'").count() == 9 * 100
    by_text = batch_full_text_search(shelf, queries, 101)
    assert by_text.filter("rank = 1").select("asin").distinct().collect() == [("o007",)]
    assert by_text.count() == 9 * 101


def worded_shelf(spark):
    """Documents of words that are the more frequent the smaller their number is."""
    rng = random.Random(9)
    rows = []
    for i in range(400):
        words = [f"w{min(int(rng.expovariate(0.12)), 60)}" for _ in range(rng.randrange(1, 30))]
        rows.append((f"{i:03}", "by hot" if i % 4 else "cold", " ".join(words), float(i % 40), None))
    return products(spark, rows)


@pytest.mark.parametrize("match_all", [False, True])
def test_bounds_lose_no_result(spark, monkeypatch, match_all):
    monkeypatch.setattr(text_index_module, "BLOCK_BITS", 2)
    monkeypatch.setattr(batch_search, "QUESTIONS_AT_BLOCK", 3)
    monkeypatch.setattr(batch_search, "FIRST_POSTINGS", 1)
    shelf = worded_shelf(spark).cache()
    index = save_index(text_index(shelf), new_folder(spark, "index"))
    texts = ["w0 w1 w2 w30 w45", "w0", "w50 w51 w0 w1 w2 w3", "w60 w0", "unheard of", "w0 unheard", "w2 w2 w3", ""]
    asked = [(q, 2.0, 35.0, "hot", t) for q, t in enumerate(texts)] + [(9, 0.0, 40.0, None, "w0"), (10, 0.0, 40.0, "hot", None)]
    queries = spark.createDataFrame(asked, QUERY_SCHEMA + ", text string")
    found = batch_full_text_search(shelf, queries, 3, match_all, index=index).orderBy("query_id", "rank").collect()
    for q, text in enumerate(texts[:-1]):
        single = full_text_search(shelf, text.split(), 2, 35, "hot", 3, match_all)
        expected = values(single, "asin", "text_search_score")
        assert [(r.asin, r.text_search_score) for r in found if r.query_id == q] == expected
    assert {r.query_id for r in found} <= set(range(len(texts) - 1))


def test_blocks_and_terms_below_the_threshold_are_not_joined(spark, monkeypatch):
    """A question of one rare and many common words: most postings of the common ones never become pairs."""
    monkeypatch.setattr(text_index_module, "BLOCK_BITS", 3)
    rng = random.Random(2)
    rows = [(f"{i:03}", "x", "the of and " + " ".join(f"f{rng.randrange(9)}" for _ in range(i % 40)), 1.0, None) for i in range(600)]
    rows += [(f"r{i}", "x", "rare the", 1.0, None) for i in range(5)]
    shelf = products(spark, rows).cache()
    index = save_index(text_index(shelf), new_folder(spark, "index"))
    queries = spark.createDataFrame([(1, 0.0, 9.0, "x", "the rare of and")], QUERY_SCHEMA + ", text string")
    terms = batch_search.bounded_terms(batch_search.question_terms(queries, False), index)
    floor = batch_search.thresholds(terms, index, 3).first().floor
    # The three common words cannot reach what five documents have by the rare one.
    assert sum(r.top for r in terms.collect() if r.term != "rare") < floor
    found = batch_full_text_search(shelf, queries, 3, index=index)
    assert values(found.orderBy("rank"), "asin") == ["r0", "r1", "r2"]


def test_late_versions_are_neither_counted_nor_joined_with_old_terms(spark, monkeypatch):
    """Versions are compared without the rows: a batch that is too late writes no document and shuffles no tokens."""
    shelf, path = worded_shelf(spark), new_folder(spark, "late")
    first = with_time(shelf, 2).cache()
    assert text_index_module.update_index(first, 0, path)
    held = text_index_module.current_documents(spark, path, first)
    assert "terms" not in str(held.columns) and "counted" not in held._jdf.queryExecution().executedPlan().toString()
    kept = {}
    stored_ = text_index_module.stored
    monkeypatch.setattr(text_index_module, "stored", lambda df, name: kept.setdefault(name, stored_(df, name)))
    assert text_index_module.update_index(with_time(shelf, 1), 1, path)
    assert kept["newer"].columns == ["asin", "_old_segment", "_old_dl"] and kept["newer"].isEmpty()
    assert index_rows(text_index_module.read_index(spark, path)) == index_rows(text_index(shelf))


@pytest.mark.parametrize("match_all", [False, True])
def test_few_questions_shuffle_no_pairs_and_find_the_same(spark, monkeypatch, match_all):
    shelf = worded_shelf(spark)
    shelf = shelf.unionByName(shelf.withColumn("asin", F.concat(F.lit("copy"), "asin"))).cache()
    texts = ["w0 w1 w2 w30 w45", "w0", "w50 w51 w0 w1 w2 w3", "unheard of", "w0 unheard", ""]
    queries = spark.createDataFrame([(q, 2.0, 35.0, "hot", t) for q, t in enumerate(texts)], QUERY_SCHEMA + ", text string")
    made = []
    stored_ = batch_search.stored
    monkeypatch.setattr(batch_search, "stored", lambda df, name: made.append((name, df)) or stored_(df, name))
    with monkeypatch.context() as few:
        # Nothing is indexed and no term is looked up in blocks.
        few.setattr(batch_search, "save_index", None)
        found = batch_full_text_search(shelf, queries, 7, match_all).orderBy("query_id", "rank").collect()
    plan = dict(made)["text-possible"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(asin" in plan and "hashpartitioning(query_id" not in plan
    monkeypatch.setattr(batch_search, "QUESTIONS_AT_BLOCK", 1)
    assert found == batch_full_text_search(shelf, queries, 7, match_all).orderBy("query_id", "rank").collect()
    assert len({r.query_id for r in found}) >= (1 if match_all else 4)


def test_text_search_without_broadcasts(spark):
    shelf = worded_shelf(spark).cache()
    index = save_index(text_index(shelf), new_folder(spark, "index"))
    queries = spark.createDataFrame([(q, 0.0, 40.0, "hot", f"w{q} w1 w{3 * q}") for q in range(8)], QUERY_SCHEMA + ", text string")
    expected = batch_full_text_search(shelf, queries, 4, index=index).orderBy("query_id", "rank").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        known = batch_search.bounded_terms(batch_search.question_terms(queries, False), index)
        pairs = batch_search.term_pairs(known, index, F.lit(True))
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan and "Python" not in plan and "Arrow" not in plan
        assert batch_full_text_search(shelf, queries, 4, index=index).orderBy("query_id", "rank").collect() == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def with_time(rows, second):
    return store.with_version(rows.withColumn("ts", F.timestamp_seconds(F.lit(second))), "ts").drop("ts")


def index_rows(index):
    return (
        sorted(values(index.postings, "asin", "term", "tf", "dl", "estimated_price")),
        sorted(values(index.terms, "term", "df")),
        values(index.corpus, "documents", "avgdl"),
    )


def test_an_index_follows_its_collection(spark):
    path = new_folder(spark, "followed")
    first = [("a", "x", "one two two", 1.0, None), ("b", "x", "one", 2.0, None), ("c", "x", None, 3.0, None), ("d", "x", "", 4.0, None)]
    second = [("b", "x", "two three", 5.0, None), ("c", "y", "one four", 6.0, None), ("e", "x", "five", 7.0, None)]
    late = [("a", "x", "late words", 9.0, None), ("f", "x", "one", 8.0, None)]
    batches = [with_time(products(spark, first), 5), with_time(products(spark, second), 6), with_time(products(spark, late), 4)]
    for number, batch in enumerate(batches):
        assert text_index_module.update_index(batch, number, path)
        assert not text_index_module.update_index(batch, number, path)
    current = products(spark, [first[0], first[3], *second, late[1]])
    expected = index_rows(text_index(current))
    assert index_rows(text_index_module.read_index(spark, path)) == expected
    assert text_index_module.compact_index(spark, path) == 0
    index = text_index_module.read_index(spark, path)
    assert index_rows(index) == expected
    found = full_text_search(current, ["one", "four"], 0, 9, "y", 3, index=index)
    assert values(found, "asin") == ["c"]
    third = products(spark, [("c", "x", "one one", 1.0, None)])
    text_index_module.update_index(with_time(third, 9), 3, path)
    now = products(spark, [first[0], first[3], second[0], second[2], late[1], ("c", "x", "one one", 1.0, None)])
    assert index_rows(text_index_module.read_index(spark, path)) == index_rows(text_index(now))


def test_an_unfinished_segment_is_not_read(spark):
    path = new_folder(spark, "unfinished")
    with pytest.raises(ValueError):
        text_index_module.read_index(spark, path)
    shelf = products(spark, [("a", "x", "one", 1.0, None)])
    text_index_module.update_index(with_time(shelf, 1), 0, path)
    text_index_module.write_postings(text_index_module.postings(shelf).withColumn("_segment", F.lit(1).cast("bigint")), f"{path}/segments/lost/postings")
    assert index_rows(text_index_module.read_index(spark, path)) == index_rows(text_index(shelf))


def test_many_winners_are_joined_without_broadcast(spark, monkeypatch):
    shelf = random_shelf(spark).cache()
    asked = [(q, 0.0, 60.0, "hot", [1.0, 0.5, 0.25, float(q % 2)]) for q in range(40)]
    queries = spark.createDataFrame(asked, QUERY_SCHEMA + ", embedding array<double>")
    columns = ("query_id", "rank", "asin", "title", "similarity")
    few = batch_vector_search(shelf, queries, 4, 5).select(*columns).collect()
    monkeypatch.setattr("shelfseek.operators.batch_search.MAX_BROADCAST_WINNERS", 10)
    many = batch_vector_search(shelf, queries, 4, 5).select(*columns).collect()
    assert len(few) == 200 and sorted(few) == sorted(many)


def test_score_does_not_depend_on_row_order(spark, shelf):
    shuffled = products(spark, random.Random(1).sample(SHELF, len(SHELF))).repartition(5)
    for search in (lambda s: vector_search(s, [0.6, 0.8]), full_text_search):
        assert search(shelf).collect() == search(shuffled).collect()


def test_named_searches(spark, shelf):
    assert typed_parameters("vector_search", {"limit": "3"}) == {
        "embedding": None, "min_price": 0.0, "max_price": 50.0, "brand": "playstation", "limit": 3,
    }
    found = run_named("vector_search", shelf, embedding="[1, 0]", max_price="20", limit="2")
    assert values(found, "asin") == ["a", "b"]
    assert run_named("full_text_search", shelf).collect() == full_text_search(shelf).collect()
    with pytest.raises(ValueError):
        run_named("vector_search", shelf, embedding="[1, 0]", limit="many")
    with pytest.raises(ValueError):
        run_named("vector_search", shelf, colour="red")
    with pytest.raises(ValueError):
        run_named("vector_search", shelf)
    as_sql = vector_search_sql(shelf, embedding=[1.0, 0.0])
    assert as_sql.collect() == vector_search(shelf, [1.0, 0.0]).collect()


def test_searches_as_sql_functions(spark, shelf):
    shelf.createOrReplaceTempView("sql_shelf")
    create_search_functions(spark, "sql_shelf")
    by_vector = spark.sql("SELECT * FROM vector_search(embedding => array(1F, 0F)) ORDER BY similarity DESC NULLS LAST, asin")
    assert by_vector.collect() == vector_search(shelf, [1.0, 0.0]).collect()
    few = spark.sql("SELECT asin FROM vector_search(array(1F, 0F), limit_to => 2, min_price => 1, brand => 'PlayStation') ORDER BY asin")
    assert values(few, "asin") == sorted(values(vector_search(shelf, [1.0, 0.0], 1, limit=2), "asin"))
    with pytest.raises(Exception, match="another length"):
        spark.sql("SELECT * FROM vector_search(array(1F))").collect()
    order = "ORDER BY text_search_score DESC, estimated_price, asin"
    assert spark.sql(f"SELECT * FROM full_text_search() {order}").collect() == full_text_search(shelf).collect()
    for terms in (["wars"], ["space", "opera", "wars", "and", "space"], ["absent"]):
        for match_all in (False, True):
            query = f"SELECT * FROM full_text_search(terms => :terms, max_price => 60, match_all => {match_all}) {order}"
            found = spark.sql(query, args={"terms": terms})
            assert found.collect() == full_text_search(shelf, terms, max_price=60, match_all=match_all).collect()


def test_default_vector_search_asks_for_the_default_terms(spark):
    embedder = HashEmbedder(8)
    rows = [("1", "playstation", "space wars", 1.0), ("2", "playstation", "cooking", 1.0)]
    df = spark.createDataFrame(rows, "asin string, brand string, description string, price double")
    raw = df.select("*", F.lit("t").alias("title"), F.array(embedder(F.col("description"))).alias("embedding"))
    from shelfseek.operators.ingest import ingest_transform

    found = run_named("vector_search", ingest_transform(raw, 8), embedder)
    assert values(found, "asin")[0] == "1"
    assert found.first().similarity == pytest.approx(1.0, abs=1e-6)


def test_compare_searches(shelf):
    found = compare_searches(shelf, "space wars", embedding=[0.0, 1.0], limit=3)
    rows = {r.asin: (r.vs_rank, r.fts_rank, r.in_both) for r in found.collect()}
    by_vector = values(vector_search(shelf, [0.0, 1.0], limit=3), "asin")
    by_text = values(full_text_search(shelf, limit=3), "asin")
    assert set(rows) == set(by_vector) | set(by_text)
    for asin, (vs, fts, both) in rows.items():
        assert vs == (by_vector.index(asin) + 1 if asin in by_vector else None)
        assert fts == (by_text.index(asin) + 1 if asin in by_text else None)
        assert both == (asin in by_vector and asin in by_text)
    with pytest.raises(ValueError):
        compare_searches(shelf, "space wars")


def test_a_large_key_is_cut_into_few_blocks_until_they_fill(spark):
    documents = spark.range(3000).select(F.col("id").cast("string").alias("asin"), F.lit("k").alias("key"))
    questions = spark.range(500).select(F.col("id").alias("query_id"), F.lit("k").alias("key"))

    def count(left, right):
        return pa.table({"d": [left.num_rows], "q": [right.num_rows]})

    for most_bytes, least, most in ((1 << 20, 1, 4), (100 * 100, 30 * 5, 30 * 5)):
        sizes = BlockSizes(0, 10, 10, pieces=2, most_bytes=most_bytes)
        keys = F.array("key")
        blocks = meet_by_key(documents, questions, count, "d bigint, q bigint", keys, keys, sizes, 100).collect()
        # Every document meets every question once, in whatever blocks.
        assert least <= len(blocks) <= most and sum(r.d * r.q for r in blocks) == 3000 * 500


def celled(spark, tmp_path, cells=6, **fit):
    shelf = random_shelf(spark).cache()
    fitted = ann.fit_cells(shelf, 4, cells, **fit)
    return shelf, ann.save_cell_index(ann.cell_index(shelf, fitted), str(tmp_path / "index"))


@pytest.mark.parametrize("reach", [ann.Reach(0.4, 2, 0), ann.Reach(0.4, 2, 15), ann.Reach(1.0, 50, 0)])
def test_ann_search_is_exact_inside_the_cells_it_looks_into(spark, tmp_path, reach):
    shelf, index = celled(spark, tmp_path)
    asked = [(q, 0.0, 60.0, ["hot", "cold0"][q % 2], [0.5, -1.0, 1.0, 0.25 * q]) for q in range(6)]
    asked += [(6, 0.0, 60.0, "hot", None), (7, 0.0, 60.0, "absent", [1.0, 0.0, 0.0, 0.0]), (8, 0.0, 60.0, None, [1.0, 0.0, 0.0, 0.0])]
    queries = spark.createDataFrame(asked, QUERY_SCHEMA + ", embedding array<float>")
    batch = ann.batch_ann_search(index, shelf, queries, 5, reach).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in batch} <= set(range(6))
    cell_of = {r.asin: r.cell for r in index.rows.collect()}
    for q, low, high, brand, vector in asked[:6]:
        cells, _ = ann.probes(index, vector, brand, reach)
        exact = values(vector_search(shelf, vector, low, high, brand, 60), "asin", "similarity")
        near = [(a, s) for a, s in exact if cell_of.get(a) in cells][:5]
        one = values(ann.ann_search(index, shelf, vector, low, high, brand, 5, reach), "asin", "similarity")
        # Codes of one byte may order near rows otherwise, so only the best few are certain where not all are scored.
        assert one[:2] == near[:2] and [(r.asin, r.similarity) for r in batch if r.query_id == q] == one
        if reach.share == 1.0:
            assert one == [(a, s) for a, s in exact if a in cell_of][:5]


def test_cells_are_fitted_on_a_bounded_sample_and_loaded_as_saved(spark, tmp_path):
    shelf, index = celled(spark, tmp_path, cells=3, sample=10, rounds=2)
    again = ann.load_cell_index(spark, str(tmp_path / "index"))
    assert again.cells == index.cells and len(again.cells.centres) == 3
    vectors = {r.asin: np.array(r.embedding, float) for r in index.rows.collect()}
    centres = np.array(index.cells.centres)
    for row in index.rows.collect():
        distances = ((centres - vectors[row.asin]) ** 2).sum(axis=1)
        assert distances[row.cell] == pytest.approx(distances.min())
        numbers = np.frombuffer(row.code, np.int8) * row.scale
        assert np.abs(numbers - vectors[row.asin]).max() <= row.scale / 2 + 1e-9
    held = sum(r.rows for r in index.brands.filter("brand = 'hot'").collect())
    assert held == index.rows.filter(F.array_contains("brand_tokens", "hot")).count()


def test_cells_are_fitted_on_all_rows_without_a_sample(spark):
    # More rows than any sample held before; the far ones have the largest md5, so a sample would miss them.
    asins = sorted((str(i) for i in range(9000)), key=lambda a: hashlib.md5(a.encode()).hexdigest())
    rows = [(a, [1.0, 0.0] if place < 2 else [0.0, 1.0 + place % 2] if place < 8500 else [4.0, 0.0]) for place, a in enumerate(asins)]
    shelf = spark.createDataFrame(rows, "asin string, embedding array<float>").repartition(3)
    centres = ann.fit_cells(shelf, 2, 3, rounds=1).centres
    # Of two equal centres the first takes all, the other stays.
    assert centres[0] == pytest.approx(((2 + 500 * 4) / 502, 0.0), abs=1e-4)
    assert centres[1] == (1.0, 0.0)


def test_rows_whose_codes_are_alike_are_all_scored_exactly(spark):
    # Fifty copies look nearer by their codes than the one that is nearest; refine would stop at two rows.
    vectors = {"z": [1.0, 0.5035, 0.0]} | {f"a{i:02}": [1.0, 0.5034, 0.0] for i in range(50)}
    shelf = products(spark, [(a, "b", "text", 1.0, v) for a, v in vectors.items()], 3)
    index = ann.cell_index(shelf, ann.fit_cells(shelf, 3, 2))
    reach = ann.Reach(1.0, 2, 0)
    assert values(ann.ann_search(index, shelf, [1.0, 1.0, 0.0], brand="b", limit=1, reach=reach), "asin") == ["z"]
    queries = spark.createDataFrame([(1, 0.0, 50.0, "b", [1.0, 1.0, 0.0])], QUERY_SCHEMA + ", embedding array<float>")
    assert values(ann.batch_ann_search(index, shelf, queries, 1, reach), "asin") == ["z"]


def test_no_vectors_make_one_empty_cell(spark):
    shelf = products(spark, [("a", "b", "c", 1.0, None)])
    index = ann.cell_index(shelf, ann.fit_cells(shelf, 2))
    assert len(index.cells.centres) == 1
    assert ann.ann_search(index, shelf, [1.0, 0.0], brand="b").collect() == []


def test_a_lookup_reads_the_cells_asked_for(spark, tmp_path):
    shelf, index = celled(spark, tmp_path)
    found = ann.ann_search(index, shelf, [1.0, 0.0, 0.0, 0.0], 0, 60, "hot", 3, ann.Reach(0.3, 2, 0))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(cell, [" in plan and "In(asin, [" in plan and "_code" not in plan


@pytest.mark.parametrize("vector", [[1.0], [1.0, 0.0, 0.0]])
def test_every_form_refuses_a_vector_of_another_length(shelf, vector):
    for search in (
        lambda: vector_search(shelf, vector),
        lambda: vector_search(shelf, vector, dims=2),
        lambda: vector_search_sql(shelf, embedding=vector),
        lambda: run_named("vector_search", shelf, embedding=str(vector)),
        lambda: ann.ann_search(ann.cell_index(shelf, ann.fit_cells(shelf, 2)), shelf, vector),
    ):
        with pytest.raises(Exception, match="numbers|another length"):
            search().collect()
