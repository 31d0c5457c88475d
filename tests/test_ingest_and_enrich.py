from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from frames import PRODUCT, values
from shelfseek.functions.embedding import HashEmbedder, ModelEmbedder
from shelfseek.operators.enrich import accepted, embed_distinct, enrich, rejected
from shelfseek.operators.ingest import ingest_problems, ingest_transform, parse_products
from shelfseek.operators.salting import salted_left_join
from shelfseek.scratch import new_folder
from shelfseek.sources import topics
from shelfseek.streaming import jobs

RECORDS = [
    ('{"asin":"1","description":"a \\"b\\"","price":"12.5","x":{"k":[1,null]}}', None),
    ('{"asin":"2","description":null}', "null_description"),
    ('{"asin":"3","price":1}', "no_description"),
    ('{"asin":"4","description":{"a":1}}', None),
    ('{"asin":"5","description":"?!"}', "not_embedded"),
    ("{not json", "not_json"),
    ('[{"asin":"6"}]', "not_an_object"),
]


def test_enrich_accepts_and_rejects(spark):
    records = spark.createDataFrame([(v,) for v, _ in RECORDS], "value string")
    done = enrich(records, HashEmbedder(8))
    assert Counter(values(rejected(done), "value", "reject_reason")) == Counter(
        (v, r) for v, r in RECORDS if r
    )
    rows = {r.asin: r for r in parse_products(accepted(done)).collect()}
    assert set(rows) == {"1", "4"}
    assert rows["1"].description == 'a "b"' and rows["1"].price == 12.5
    assert rows["1"].other_fields == '{"x":{"k":[1,null]}}'
    assert len(rows["1"].embedding) == 1 and len(rows["1"].embedding[0]) == 8
    assert rows["4"].description == '{"a":1}'


def test_enrich_can_embed_the_json_text(spark):
    seen = ModelEmbedder(lambda: lambda texts: [[float(len(t))] for t in texts], 1)
    records = spark.createDataFrame([('{"asin":"1","description":"a\\"b"}',)], "value string")
    assert values(enrich(records, seen), "embedding") == [[3.0]]
    assert values(enrich(records, seen, raw_json_text=True), "embedding") == [[6.0]]


def test_enrich_replaces_an_old_embedding(spark):
    records = spark.createDataFrame([('{"asin":"1","description":"a","embedding":[[9]]}',)], "value string")
    assert values(parse_products(accepted(enrich(records, HashEmbedder(2)))), "embedding")[0][0] != [9.0]


def test_ingest_transform(spark):
    rows = [
        ("1", "t", "by Sony PlayStation", "Space wars, space!", 0.0, [[1.0, 2.0], [3.0, 4.0]]),
        ("2", "t", "by", "", None, [[1.0]]),
        ("3", "t", None, None, 5.0, []),
        ("4", "t", "BY x-by", "d", 5.0, None),
        ("5", "t", "", "d", 5.0, [[1.0, None]]),
    ]
    df = spark.createDataFrame(rows, PRODUCT).withColumn("_meta", F.struct(F.lit(1).alias("offset")))
    done = ingest_transform(df, 2, "shop")
    assert "_meta" not in done.columns and dict(done.dtypes)["embedding"] == "array<float>"
    assert values(done.orderBy("asin"), "_id", "estimated_price", "embedding", "brand_tokens", "origin") == [
        ("1", 0.0, [1.0, 2.0], ["sony", "playstation"], "shop"),
        ("2", 30.0, None, [], "shop"),
        ("3", 5.0, None, None, "shop"),
        ("4", 5.0, None, ["x"], "shop"),
        ("5", 5.0, None, [], "shop"),
    ]
    assert values(done.filter("asin = '1'"), "description_tokens") == [["space", "wars", "space"]]


def test_prices_that_are_no_numbers_are_kept_and_reported(spark):
    records = spark.createDataFrame(
        [(f'{{"asin":"{i}","price":{p}}}',) for i, p in enumerate(['"7"', '"free"', "null", "3"])]
        + [('{"asin":"4"}',), ("broken",)],
        "value string",
    )
    parsed = parse_products(records).orderBy("asin")
    assert values(parsed, "asin", "price") == [
        (None, None), ("0", 7.0), ("1", None), ("2", None), ("3", 3.0), ("4", None),
    ]
    assert values(parsed.filter("unread_price IS NOT NULL"), "asin", "unread_price") == [("1", '"free"')]
    kept = ingest_transform(parsed, 2).filter("asin = '1'").first()
    assert kept.unread_price == '"free"' and kept.estimated_price == 30.0
    vectors = spark.createDataFrame(
        [('{"asin":"a","embedding":[[1,2]]}',), ('{"asin":"b","embedding":[[1]]}',), ('{"asin":"c","embedding":"x","price":[1]}',)], "value string"
    )
    assert sorted(values(ingest_problems(parse_products(vectors), 2), "asin", "reason", "value")) == [
        ("b", "embedding_unusable", "[[1.0]]"), ("c", "embedding_unusable", '"x"'), ("c", "price_not_a_number", "[1]"),
    ]


def test_each_text_is_embedded_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def make_client():
        def client(texts):
            calls.add(len(texts))
            return [[float(len(t))] for t in texts]

        return client

    rows = [(i, "copy" if i % 3 == 0 else f"text {i % 20}") for i in range(300)] + [(300, None)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(4)
    found = embed_distinct(df, "text", "id", ModelEmbedder(make_client, 1), parallelism=3)
    result = dict(values(found, "id", "embedding"))
    assert result == {i: None if t is None else [float(len(t))] for i, t in rows}
    assert calls.value == len({t for _, t in rows if t})


def test_salted_join_spreads_a_hot_key_and_keeps_every_row(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"))
    lookup = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top")).filter("top % 2 = 0 OR n > 1")
    found = salted_left_join(rows, lookup, "key", "n", "id")
    plain = rows.join(lookup.drop("n"), "key", "left")
    assert found.select("id", "key", "top").exceptAll(plain.select("id", "key", "top")).count() == 0
    assert found.count() == 5000


def test_the_enrichment_stream_keeps_one_text_for_each_record(spark):
    """What a micro-batch keeps for its two writers holds neither the record beside its enriched text nor the vector beside
    its JSON."""
    path, plans, rows = new_folder(spark, "kept"), [], []
    records = [("k", v, "t", 0, i, datetime(2024, 1, 1)) for i, (v, _) in enumerate(RECORDS)]
    spark.createDataFrame(records, topics.MESSAGE_SCHEMA).write.parquet(f"{path}/raw")

    def write(batch, batch_id):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        rows.append(batch.collect())

    jobs.start_enrichment(topics.read_topic_files(spark, f"{path}/raw"), HashEmbedder(8), write, write, f"{path}/checkpoint").awaitTermination()
    scans = [line for plan in plans for line in plan.splitlines() if "InMemoryTableScan" in line or "InMemoryRelation" in line]
    assert scans and not any("enriched#" in line or "embedding#" in line for line in scans)
    done = enrich(spark.read.parquet(f"{path}/raw"), HashEmbedder(8))
    assert sorted(rows[0]) == sorted(accepted(done).collect()) and rows[0][0].__fields__ == accepted(done).columns
    assert sorted(rows[1]) == sorted(rejected(done).collect()) and rows[1][0].__fields__ == rejected(done).columns
