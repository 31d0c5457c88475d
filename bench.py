"""Time the registered queries on $BENCH_SF_DIR with $BENCH_CPUS cores and print one JSON line.

Two kinds of numbers: ``queries`` are the headline registered queries, derived frames, index builds and streams
included; ``prepared`` are searches on a collection and an index that were stored beforehand, as a service
would run them. Each is the median of $BENCH_RUNS runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from shelfseek.operators import ann, batch_search, text_index  # noqa: E402
from shelfseek.operators.search import full_text_search, vector_search  # noqa: E402
from shelfseek.plans.products import DIMS, LIMIT, TERMS, collection, query_vector  # noqa: E402
from shelfseek.plans.registered import FILTERS, QUERIES, text_queries, vector_queries  # noqa: E402
from shelfseek.scratch import new_folder, stored  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
ONLY = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]

HEADLINES = (
    "vector_search",
    "full_text_search",
    "full_text_search_indexed",
    "batch_vector_search",
    "batch_full_text_search",
    "compare_searches",
    "compare_batch",
    "ann_search",
    "ann_recall",
    "dot_product",
    "tokenize_terms",
    "postings",
    "term_statistics",
    "hash_embed",
    "embed_distinct",
    "enrich_documents",
    "ingest_transform",
    "parse_events_json",
    "upsert_latest",
    "update_replay",
    "json_array_scan",
    "ndjson_scan",
    "stream_enrich",
    "stream_ingest",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(query: Callable[[], DataFrame]) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 4)


def prepared(spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
    """Searches over a stored collection, text index and cells."""
    products = stored(collection(spark, SF_DIR).drop("_version"), "bench-collection")
    index = text_index.save_index(text_index.text_index(products), new_folder(spark, "bench-index"))
    cells = ann.fit_cells(products, DIMS)
    celled = ann.save_cell_index(ann.cell_index(products, cells), new_folder(spark, "bench-cells"))
    query = query_vector(spark, SF_DIR)
    questions, texts = vector_queries(spark, SF_DIR), text_queries(spark, SF_DIR)
    return {
        "vector_search": lambda: vector_search(products, query, **FILTERS),
        "full_text_search": lambda: full_text_search(products, TERMS, **FILTERS),
        "full_text_search_indexed": lambda: full_text_search(products, TERMS, **FILTERS, index=index),
        "ann_search": lambda: ann.ann_search(celled, products, query, **FILTERS),
        "batch_vector_search": lambda: batch_search.batch_vector_search(products, questions, DIMS, LIMIT),
        "batch_full_text_search": lambda: batch_search.batch_full_text_search(
            products, texts, LIMIT, normalize_terms=True, index=index
        ),
    }


def main() -> None:
    spark = session()
    chosen = ONLY or HEADLINES
    times = {name: seconds(lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in chosen}
    stored_times = {} if ONLY else {name: seconds(q) for name, q in prepared(spark).items()}
    report = {
        "metric": "total seconds of the headline queries, median of warm runs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "prepared": stored_times,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
