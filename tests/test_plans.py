"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import pytest
from pyspark.sql import functions as F

from shelfseek.operators import collection as store
from shelfseek.operators.batch_search import batch_vector_search
from shelfseek.operators.search import full_text_search, vector_search
from shelfseek.operators.text_index import postings, save_index, text_index
from shelfseek.plans.products import DIMS, collection, query_vector
from shelfseek.plans.registered import FILTERS, QUERIES, vector_queries
from shelfseek.scratch import new_folder, stored

SF_DIR = "/root/testdata/sf0.001"
# Queries that run streams or write tables before they return; their last plan only reads a table back.
WRITING = {"json_array_scan", "ndjson_scan", "stream_enrich", "stream_rejects", "stream_ingest", "update_replay", "text_index_updates", "json_array_elements", "file_to_topic", "stream_ingest_newest"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan(text: str, column: str) -> str:
    return next(line for line in text.splitlines() if "FileScan" in line and column in line)


@pytest.fixture(scope="module")
def shelf(spark):
    return stored(collection(spark, SF_DIR), "shelf")


def test_vector_search_reads_what_it_needs_and_shuffles_nothing(spark, shelf):
    text = plan(vector_search(shelf, query_vector(spark, SF_DIR), **FILTERS))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    read = scan(text, "embedding")
    assert "GreaterThanOrEqual(estimated_price,0.0)" in read and "description_tokens" not in read
    assert text.count("ArrowEvalPython") == 1


def test_text_search_does_not_read_vectors(shelf):
    text = plan(full_text_search(shelf, ["the"], **FILTERS))
    assert "embedding" not in text
    assert "LessThanOrEqual(estimated_price,950.0)" in scan(text, "title")
    assert "hashpartitioning" not in text


def test_indexed_search_reads_the_terms_postings(spark, shelf):
    index = save_index(text_index(shelf), new_folder(spark, "index"))
    text = plan(full_text_search(shelf, ["the", "worthless"], **FILTERS, index=index))
    assert "In(term, [the,worthless])" in text
    assert "BroadcastHashJoin" in text


def test_postings_are_built_without_a_shuffle_and_counted_once(shelf):
    text = plan(postings(shelf))
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1


def test_batch_search_limits_before_the_shuffle(spark, shelf):
    text = plan(batch_vector_search(shelf, vector_queries(spark, SF_DIR), DIMS))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("WindowGroupLimit", text.index("Exchange")) > text.index("Exchange")
    assert "MapInArrow" in text and "estimated_price" in scan(text, "embedding")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_query_crosses_tables(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_sql_text_search_shuffles_neither_tokens_nor_by_term(spark):
    """Every product may hold a term; however large the tables, the terms' counts go to the products."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["full_text_search_sql"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in text.splitlines() if "Join" in line and "term#" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)


def test_few_changes_are_merged_without_shuffling_or_rereading_the_snapshot(spark, shelf):
    path = new_folder(spark, "merged")
    rows = store.with_version(shelf.withColumn("ts", F.timestamp_seconds(F.lit(1))), "ts").drop("ts")
    store.append_changes(rows, 0, path)
    store.compact(spark, path)
    store.append_changes(rows.limit(3), 1, path)
    text = plan(store.read_collection(spark, path).filter(F.col("estimated_price").between(10, 20)))
    anti = [line for line in text.splitlines() if "LeftAnti" in line]
    assert anti and all("BroadcastHashJoin" in line for line in anti)
    scans = [line for line in text.splitlines() if "FileScan" in line and "snapshot/" in line]
    # Whole rows are read inside the price range alone; of changed buckets, keys and versions are read beside them.
    wide = [line for line in scans if "description" in line.split("ReadSchema")[1]]
    assert len(wide) == 2 and all("GreaterThanOrEqual(estimated_price,10.0)" in line for line in wide)
    assert all("description" not in line.split("ReadSchema")[1] for line in scans if line not in wide)
