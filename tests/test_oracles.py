"""Every registered query against SQL on the same tables."""

from collections import Counter

import duckdb
import pytest

from shelfseek.plans.oracles import ORACLES
from shelfseek.plans.registered import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents part embeddings events benchmark".split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sql, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = sql.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    rows = sql.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert rows
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(rows)


@pytest.mark.parametrize("odd", [0, 1])
def test_recall_of_wide_and_of_rare_brands(spark, odd):
    """Even questions ask for a brand that all products have, odd ones for one of a few products."""
    rows = [r.recall for r in QUERIES["ann_recall"](spark, SF_DIR).collect() if r.query_id % 2 == odd]
    mean = sum(rows) / len(rows)
    print(f"mean recall@10 over {len(rows)} questions: {mean:.3f}")
    assert len(rows) == 100 and mean >= 0.9


def test_few_products_are_scored_exactly(spark):
    rows = QUERIES["ann_candidate_share"](spark, SF_DIR).collect()
    assert len(rows) == 200 and max(r.share for r in rows) < 0.2
