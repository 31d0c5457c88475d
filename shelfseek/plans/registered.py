"""Every operator as a query over the given tables: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfseek.functions.embedding import HashEmbedder
from shelfseek.functions.records import json_field, parse_object
from shelfseek.functions.text import match_terms
from shelfseek.functions.vectors import dot_product, dot_product_columns, vector_enforce
from shelfseek.operators import ann, batch_search, collection as store, text_index
from shelfseek.operators.blocks import BlockSizes
from shelfseek.operators.compare import compare_results, compare_searches
from shelfseek.operators.enrich import accepted, embed_distinct, enrich, rejected
from shelfseek.operators.ingest import ingest_problems, ingest_transform, parse_products
from shelfseek.operators.search import (
    PRODUCT_COLUMNS,
    full_text_search,
    metadata_filter,
    similarity_order,
    text_order,
    vector_search,
)
from shelfseek.plans import sql_forms
from shelfseek.plans.named import run_named, vector_search_sql
from shelfseek.plans.products import (
    BRAND,
    DIMS,
    LIMIT,
    MAX_PRICE,
    MIN_PRICE,
    TERMS,
    collection,
    documents,
    query_vector,
    raw_products,
    table,
)
from shelfseek.scratch import new_folder, stored
from shelfseek.sources import files, topics
from shelfseek.sources.arrays import read_array_elements, stream_array_elements
from shelfseek.streaming import jobs, newest

FILTERS = {"min_price": MIN_PRICE, "max_price": MAX_PRICE, "brand": BRAND, "limit": LIMIT}

# Small enough that the questions are never broadcast and every key is cut into several blocks.
BY_KEY = BlockSizes(broadcast_bytes=0, documents=512, questions=100)


def rounded(name: str) -> Column:
    """A score to six places, as results are compared; adding zero turns -0.0 into 0.0."""
    return (F.round(F.col(name), 6) + F.lit(0.0)).alias(name)


def joined(name: str) -> Column:
    return F.array_join(name, " ").alias(name)


def product_rows(results: DataFrame, *scores: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Search results with token lists as text and scores rounded."""
    plain = [c for c in PRODUCT_COLUMNS if c != "brand_tokens"]
    return results.select(*keys, *plain, joined("brand_tokens"), *[rounded(s) for s in scores])


def vector_entries(df: DataFrame, key: str) -> DataFrame:
    """(key, bucket, weight) for the numbers of ``embedding`` that are not 0."""
    return (
        df.select(key, F.posexplode_outer("embedding").alias("bucket", "weight"))
        .filter(F.col("weight") != 0)
        .select(key, "bucket", rounded("weight"))
    )


# Searches


def ranked(results: DataFrame, order: list[Column]) -> DataFrame:
    """The few rows of a search's result with their places, so that their order can be checked."""
    return results.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def q_vector_search(spark: SparkSession, sf: str) -> DataFrame:
    found = vector_search(collection(spark, sf), query_vector(spark, sf), **FILTERS, dims=DIMS)
    return product_rows(ranked(found, similarity_order()), "similarity", keys=("rank",))


def q_vector_search_named(spark: SparkSession, sf: str) -> DataFrame:
    """Parameters as text, the vector as JSON, as a client of the named search sends them."""
    text = {name: str(value) for name, value in FILTERS.items()}
    found = run_named(
        "vector_search", collection(spark, sf), embedding=str(query_vector(spark, sf)), **text
    )
    return product_rows(found, "similarity")


def q_vector_search_sql(spark: SparkSession, sf: str) -> DataFrame:
    found = vector_search_sql(
        collection(spark, sf), embedding=query_vector(spark, sf), **FILTERS
    )
    return product_rows(found, "similarity")


def q_full_text_search(spark: SparkSession, sf: str) -> DataFrame:
    found = full_text_search(collection(spark, sf), TERMS, **FILTERS)
    return product_rows(ranked(found, text_order()), "text_search_score", keys=("rank",))


def q_full_text_search_all(spark: SparkSession, sf: str) -> DataFrame:
    found = full_text_search(collection(spark, sf), TERMS, **FILTERS, match_all=True)
    return product_rows(found, "text_search_score")


def q_full_text_search_named(spark: SparkSession, sf: str) -> DataFrame:
    text = {name: str(value) for name, value in FILTERS.items()}
    found = run_named(
        "full_text_search", collection(spark, sf), term1=TERMS[0], term2=TERMS[1], **text
    )
    return product_rows(found, "text_search_score")


def q_full_text_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same search over a stored collection and index."""
    products = stored(collection(spark, sf), "collection")
    index = text_index.save_index(text_index.text_index(products), new_folder(spark, "index"))
    return product_rows(full_text_search(products, TERMS, **FILTERS, index=index), "text_search_score")


def search_view(spark: SparkSession, sf: str) -> str:
    """The stored collection as a view of its own name, with both searches as SQL functions over it."""
    view = "shelf_" + new_folder(spark, "view")[-32:]
    stored(collection(spark, sf), "collection").createOrReplaceTempView(view)
    sql_forms.create_search_functions(spark, view, f"{view}_by_vector", f"{view}_by_text")
    return view


SQL_FILTERS = f"min_price => {MIN_PRICE}D, max_price => {MAX_PRICE}D, brand => '{BRAND}', limit_to => {LIMIT}"


def q_vector_search_function(spark: SparkSession, sf: str) -> DataFrame:
    query = f"SELECT * FROM {search_view(spark, sf)}_by_vector(embedding => :vector, {SQL_FILTERS})"
    return product_rows(spark.sql(query, args={"vector": query_vector(spark, sf)}), "similarity")


def q_full_text_search_sql(spark: SparkSession, sf: str) -> DataFrame:
    query = f"SELECT * FROM {search_view(spark, sf)}_by_text(terms => :terms, {SQL_FILTERS})"
    return product_rows(spark.sql(query, args={"terms": list(TERMS)}), "text_search_score")


def vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Each stored vector as a question; odd ones ask for one brand number, the others for all brands."""
    number = F.regexp_extract("p_brand", "[0-9]+", 0)
    return (
        table(spark, sf, "embeddings")
        .join(table(spark, sf, "part"), F.col("vec_id") == F.col("p_partkey"))
        .select(
            F.col("vec_id").alias("query_id"),
            "embedding",
            F.lit(MIN_PRICE).alias("min_price"),
            F.lit(MAX_PRICE).alias("max_price"),
            F.when(F.col("vec_id") % 2 == 1, number).otherwise(F.lit(BRAND)).alias("brand"),
        )
    )


def text_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Each benchmark text as a question."""
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"),
        "text",
        F.lit(MIN_PRICE).alias("min_price"),
        F.lit(MAX_PRICE).alias("max_price"),
        F.lit(BRAND).alias("brand"),
    )


def batch_rows(results: DataFrame, score: str) -> DataFrame:
    return results.select("query_id", "rank", "asin", "title", "estimated_price", rounded(score))


def q_batch_vector_search(spark: SparkSession, sf: str, sizes: BlockSizes = BlockSizes()) -> DataFrame:
    found = batch_search.batch_vector_search(
        collection(spark, sf), vector_queries(spark, sf), DIMS, LIMIT, sizes
    )
    return batch_rows(found, "similarity")


def q_batch_vector_search_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return q_batch_vector_search(spark, sf, BY_KEY)


def q_batch_full_text_search(spark: SparkSession, sf: str) -> DataFrame:
    products = stored(collection(spark, sf), "collection")
    found = batch_search.batch_full_text_search(products, text_queries(spark, sf), LIMIT, normalize_terms=True)
    return batch_rows(found, "text_search_score")


def q_batch_full_text_search_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a stored index of all terms."""
    products = stored(collection(spark, sf), "collection")
    index = text_index.save_index(text_index.text_index(products), new_folder(spark, "index"))
    found = batch_search.batch_full_text_search(products, text_queries(spark, sf), LIMIT, normalize_terms=True, index=index)
    return batch_rows(found, "text_search_score")


def q_text_index_updates(spark: SparkSession, sf: str) -> DataFrame:
    """A collection and its index through three micro-batches: all products, every third one rewritten, and the first
    versions of all once more, too late. The indexed search finds what the last versions say."""
    path = new_folder(spark, "followed")
    products = collection(spark, sf)
    third = raw_products(spark, sf).filter(F.col("asin").cast("bigint") % 3 == 0)
    rewritten = ingest_transform(
        third.withColumn("description", F.concat(F.lit("worthless the "), F.substring("description", 1, 200))), DIMS
    )
    for number, (rows, second) in enumerate([(products, 1), (rewritten, 2), (None, 1)]):
        if rows is None:
            batch = store.read_changes(spark, f"{path}/collection", 0)
        else:
            batch = store.with_version(rows.withColumn("ts", F.timestamp_seconds(F.lit(second))), "ts").drop("ts")
        store.write_changes(batch, number, f"{path}/collection")
        text_index.update_index(store.read_changes(spark, f"{path}/collection", number), number, f"{path}/index")
    current, index = store.read_collection(spark, f"{path}/collection"), text_index.read_index(spark, f"{path}/index")
    return product_rows(full_text_search(current, TERMS, **FILTERS, index=index), "text_search_score")


def q_compare_searches(spark: SparkSession, sf: str) -> DataFrame:
    filters = FILTERS | {"limit": 5 * LIMIT}
    return compare_searches(
        collection(spark, sf), " ".join(TERMS), embedding=query_vector(spark, sf), **filters
    )


def hashed_collection(spark: SparkSession, sf: str) -> DataFrame:
    """The collection with vectors made from the descriptions, stored so that they are made once."""
    embedded = HashEmbedder(DIMS)(F.col("description")).cast("array<float>")
    return stored(collection(spark, sf).withColumn("embedding", embedded), "hashed")


def q_compare_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Both searches for each benchmark text, which one embedder turns into a vector."""
    products, queries = hashed_collection(spark, sf), text_queries(spark, sf)
    embedded = queries.withColumn("embedding", HashEmbedder(DIMS)(F.col("text")))
    by_vector = batch_search.batch_vector_search(products, embedded, DIMS, LIMIT)
    by_text = batch_search.batch_full_text_search(products, queries, LIMIT, normalize_terms=True)
    return compare_results(by_vector, by_text, keys=("query_id", "asin"))


# Cells of the given tables' vectors.
CELLS = 32


def celled(spark: SparkSession, sf: str) -> tuple[DataFrame, ann.CellIndex]:
    """The stored collection and its index by cell."""
    products = stored(collection(spark, sf), "collection")
    cells = ann.fit_cells(products, DIMS, CELLS)
    return products, ann.save_cell_index(ann.cell_index(products, cells), new_folder(spark, "cells"))


def q_ann_search(spark: SparkSession, sf: str) -> DataFrame:
    products, index = celled(spark, sf)
    return product_rows(ann.ann_search(index, products, query_vector(spark, sf), **FILTERS), "similarity")


def q_ann_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the exact results found, per question."""
    products, index = celled(spark, sf)
    queries = vector_queries(spark, sf)
    found = ann.batch_ann_search(index, products, queries, LIMIT)
    with_vectors = products.filter(F.col("embedding").isNotNull())
    exact = batch_search.batch_vector_search(with_vectors, queries, DIMS, LIMIT)
    return ann.recall(found, exact)


def q_ann_candidate_share(spark: SparkSession, sf: str) -> DataFrame:
    """Which share of the products with a vector is scored exactly, per question."""
    _, index = celled(spark, sf)
    found = ann.candidates(index, vector_queries(spark, sf), LIMIT, ann.Reach())
    return ann.candidate_share(found, index).select("query_id", "candidates", rounded("share"))


# Filters, scores, tokens


def q_metadata_filter(spark: SparkSession, sf: str) -> DataFrame:
    passing = collection(spark, sf).filter(metadata_filter(MIN_PRICE, MAX_PRICE, BRAND.upper()))
    return passing.select("asin", "estimated_price", joined("brand_tokens"))


def q_term_filters(spark: SparkSession, sf: str) -> DataFrame:
    tokens = F.col("description_tokens")
    return collection(spark, sf).select(
        "asin",
        match_terms(tokens, TERMS).alias("any_term"),
        match_terms(tokens, TERMS, match_all=True).alias("every_term"),
    )


def q_dot_product(spark: SparkSession, sf: str) -> DataFrame:
    query = query_vector(spark, sf)
    return (
        table(spark, sf, "embeddings")
        .select(
            "vec_id",
            dot_product(F.col("embedding"), query).alias("similarity"),
            dot_product_columns(F.col("embedding"), F.col("embedding")).alias("self_similarity"),
        )
        .select("vec_id", rounded("similarity"), rounded("self_similarity"))
    )


def q_vector_enforce(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors cut to 61..64 numbers, of which only the whole ones pass; every fifth has a hole."""
    cut = F.slice("embedding", 1, F.lit(DIMS) - (F.col("vec_id") % 4).cast("int"))
    holed = F.transform(cut, lambda x, i: F.when((i != 3) | (F.col("vec_id") % 5 != 0), x))
    enforced = vector_enforce(holed, DIMS)
    return table(spark, sf, "embeddings").select(
        "vec_id", enforced.isNotNull().alias("kept"), F.size(enforced).alias("dims")
    )


def q_tokenize_terms(spark: SparkSession, sf: str) -> DataFrame:
    return text_index.postings(collection(spark, sf)).select("asin", "term", "tf")


def q_postings(spark: SparkSession, sf: str) -> DataFrame:
    rows = text_index.postings(collection(spark, sf))
    return rows.select("asin", "term", "tf", "dl", "estimated_price", joined("brand_tokens"))


def q_term_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return text_index.text_index(collection(spark, sf)).terms


def q_corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return text_index.corpus_statistics(collection(spark, sf)).select("documents", rounded("avgdl"))


def q_query_terms(spark: SparkSession, sf: str) -> DataFrame:
    terms = batch_search.query_terms(F.col("text"))
    return table(spark, sf, "benchmark").select("item_id", F.posexplode(terms).alias("pos", "term"))


# Embedding and ingest


def q_hash_embed(spark: SparkSession, sf: str) -> DataFrame:
    return vector_entries(
        documents(spark, sf).select("doc_id", HashEmbedder(DIMS)(F.col("text")).alias("embedding")), "doc_id"
    )


def q_embed_distinct(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf).select("doc_id", "text")
    embedded = embed_distinct(rows, "text", "doc_id", HashEmbedder(DIMS), parallelism=8)
    return vector_entries(embedded, "doc_id")


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Products as JSON text, before enrichment."""
    return topics.keyed_records(raw_products(spark, sf).drop("embedding"))


def q_publish_records(spark: SparkSession, sf: str) -> DataFrame:
    """What is sent to the topic: key, and the fields of the JSON value."""
    record = parse_object(F.col("value"))
    fields = [
        json_field(record, name).try_cast("string").alias(name)
        for name in ("asin", "title", "brand", "description")
    ]
    price = json_field(record, "price").try_cast("double").alias("price")
    return raw_records(spark, sf).select("key", *fields, price)


def enriched_entries(messages: DataFrame) -> DataFrame:
    """Fields and vector entries read back from enriched JSON."""
    parsed = parse_products(messages).withColumn("embedding", F.col("embedding")[0])
    return (
        parsed.select("asin", "title", "brand", "price", F.posexplode_outer("embedding").alias("bucket", "weight"))
        .filter(F.col("weight") != 0)
        .select("asin", "title", "brand", "price", "bucket", rounded("weight"))
    )


def q_enrich_documents(spark: SparkSession, sf: str) -> DataFrame:
    return enriched_entries(accepted(enrich(raw_records(spark, sf), HashEmbedder(DIMS))))


def damaged_records(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as a JSON record, most of them damaged in one of six ways by doc_id."""
    field = F.to_json(F.struct("text"))
    whole = F.concat(F.lit('{"asin":"'), F.col("doc_id"), F.lit('","description":'), F.substring(field, 9, 1 << 30))
    damaged = (
        F.when(F.col("doc_id") % 7 == 1, F.concat(F.lit("{"), whole))
        .when(F.col("doc_id") % 7 == 2, F.concat(F.lit("["), whole, F.lit("]")))
        .when(F.col("doc_id") % 7 == 3, F.concat(F.lit('{"asin":"'), F.col("doc_id"), F.lit('"}')))
        .when(F.col("doc_id") % 7 == 4, F.concat(F.lit('{"asin":"'), F.col("doc_id"), F.lit('","description":null}')))
        .when(F.col("doc_id") % 7 == 5, F.concat(F.lit('{"asin":"'), F.col("doc_id"), F.lit('","description":"?!"}')))
        .when(F.col("doc_id") % 7 == 6, F.lit("null"))
        .otherwise(whole)
    )
    return documents(spark, sf).select("doc_id", damaged.alias("value"))


def q_reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return rejected(enrich(damaged_records(spark, sf), HashEmbedder(DIMS))).select("doc_id", "reject_reason")


def q_parse_events_json(spark: SparkSession, sf: str) -> DataFrame:
    record = parse_object(F.col("props"))
    return table(spark, sf, "events").select(
        "event_id",
        json_field(record, "k").try_cast("bigint").alias("k"),
        json_field(record, "missing").isNull().alias("missing"),
    )


def ingest_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "_id",
        "asin",
        "title",
        "brand",
        F.md5("description").alias("description"),
        "price",
        "estimated_price",
        F.size("embedding").alias("dims"),
        F.round(F.try_element_at("embedding", F.lit(1)).cast("double"), 6).alias("first_number"),
        joined("brand_tokens"),
        F.md5(F.array_join("description_tokens", " ")).alias("description_tokens"),
        "origin",
    )


def q_ingest_transform(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_rows(collection(spark, sf))


def q_ingest_transform_sql(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_rows(sql_forms.ingest_transform_sql(raw_products(spark, sf), DIMS))


def q_ingest_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Records of which every fifth has a price with a currency sign, and three of four a vector that is too short."""
    price = F.col("p_retailprice").cast("string")
    cut = F.slice("embedding", 1, F.lit(DIMS) - (F.col("vec_id") % 4).cast("int"))
    record = F.struct(
        F.col("p_partkey").cast("string").alias("asin"),
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("$"), price)).otherwise(price).alias("price"),
        F.when(F.col("vec_id").isNotNull(), F.array(cut)).alias("embedding"),
    )
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    parts = table(spark, sf, "part").join(vectors, F.col("p_partkey") == F.col("vec_id"), "left")
    return ingest_problems(parse_products(parts.select(F.to_json(record).alias("value"))), DIMS).select("asin", "reason")


# Collection


def event_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as versions of one record per user."""
    events = table(spark, sf, "events").withColumn("_id", F.col("user_id").cast("string"))
    return store.with_version(events, "ts", offset="event_id")


def event_rows(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "event_id", "event_type", "value")


def q_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    return event_rows(store.latest(event_versions(spark, sf)))


def q_update_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Events stored, then snapshot, then an update of each event an hour later, then the first ones
    again. The collection holds the last update of each user."""
    path = new_folder(spark, "replay")
    events = table(spark, sf, "events").withColumn("_id", F.col("user_id").cast("string"))
    updated = events.withColumns(
        {"ts": F.expr("ts + INTERVAL 1 HOUR"), "event_type": F.lit("updated"), "value": F.col("value") + 1}
    )
    originals = store.with_version(events, "ts", offset="event_id")
    store.append_changes(originals, 0, path)
    store.compact(spark, path)
    store.append_changes(store.with_version(updated, "ts", offset="event_id"), 1, path)
    store.append_changes(originals, 2, path)
    return event_rows(store.read_collection(spark, path))


def q_collection_status(spark: SparkSession, sf: str) -> DataFrame:
    return store.collection_status(collection(spark, sf))


# Sources and streams: the products are written to a new folder first, then read back.


def product_fields(records: DataFrame) -> DataFrame:
    parsed = parse_products(records)
    return parsed.select("asin", "title", "brand", F.md5("description").alias("description"), "price")


def q_json_array_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Products as gzipped JSON arrays of about a thousand, one array per file."""
    path = new_folder(spark, "arrays")
    records = raw_records(spark, sf)
    chunks = F.ceil(F.lit(records.count()) / 1000).cast("int")
    arrays = records.groupBy(F.pmod(F.xxhash64("key"), chunks).alias("chunk")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path, compression="gzip")
    return product_fields(files.good(files.read_json_array(spark, path, partitions=8)))


# Bytes of one of the large arrays, at most about.
ARRAY_BYTES = 64 << 20


def array_files(size: int) -> int:
    """How many files hold so many bytes of arrays: a file is read by one task, so none grows with the input."""
    return max(8, -(-size // ARRAY_BYTES))


def damaged_arrays(spark: SparkSession, sf: str) -> str:
    """A folder of products as large gzipped arrays, every seventh product damaged."""
    path = new_folder(spark, "arrays")
    size = raw_records(spark, sf).agg(F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).first()[0]
    damaged = F.when(F.col("key").cast("bigint") % 7 == 1, F.regexp_replace("value", r"^\{", "{bad ")).otherwise(F.col("value"))
    lists = F.array_join(F.collect_list(damaged), ",\n")
    arrays = raw_records(spark, sf).groupBy(F.pmod(F.xxhash64("key"), F.lit(array_files(size))).alias("chunk")).agg(
        F.concat(F.lit("["), lists, F.lit("]")).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path, compression="gzip")
    return path


def damaged_asin() -> Column:
    return F.regexp_extract("value", '"asin":"([0-9]+)"', 1).alias("asin")


def q_json_array_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Each element is read by itself, and only the damaged ones are rejected."""
    return read_array_elements(spark, damaged_arrays(spark, sf)).select(damaged_asin(), "reject_reason")


def q_file_to_topic(spark: SparkSession, sf: str) -> DataFrame:
    """The same files through the publishing stream: what it sends to the topic by key, and what it rejects."""
    path = new_folder(spark, "published")
    jobs.start_publishing(
        stream_array_elements(spark, damaged_arrays(spark, sf), files_per_batch=3),
        jobs.keyed_files_writer(f"{path}/topic"),
        jobs.files_writer(f"{path}/rejected"),
        checkpoint=f"{path}/checkpoint",
    ).awaitTermination()
    sent = spark.read.parquet(f"{path}/topic")
    fields = product_fields(sent).select("asin", "title", "brand", "description", "price", F.lit(None).cast("string").alias("reject_reason"))
    keys = sent.select("key").distinct()
    rejects = spark.read.parquet(f"{path}/rejected").select(damaged_asin(), "reject_reason")
    return fields.join(keys, fields["asin"] == keys["key"]).drop("key").unionByName(rejects, allowMissingColumns=True)


def q_ndjson_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "lines")
    raw_records(spark, sf).select("value").write.text(path, compression="gzip")
    return product_fields(files.good(files.read_ndjson(spark, path, partitions=8)))


def write_messages(records: DataFrame, path: str, day: int = 1) -> None:
    """Add (key, value) records of one day to a folder of files with a topic's columns."""
    records.select(
        F.col("key").cast("string"),
        "value",
        F.lit(topics.RAW_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.xxhash64("key").alias("offset"),
        F.lit(f"2024-01-{day:02} 00:00:00").cast("timestamp").alias("timestamp"),
    ).write.mode("append").parquet(path, compression="zstd")


def run_enrichment(messages: DataFrame, path: str) -> None:
    jobs.start_enrichment(
        messages,
        HashEmbedder(DIMS),
        jobs.files_writer(f"{path}/accepted"),
        jobs.files_writer(f"{path}/rejected"),
        checkpoint=f"{path}/checkpoint",
    ).awaitTermination()


def q_stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Products through the enrichment stream, read back from its sink."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "enriched")
    write_messages(raw_records(spark, sf), topic)
    run_enrichment(topics.read_topic_files(spark, topic), path)
    return enriched_entries(spark.read.parquet(f"{path}/accepted"))


def q_stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    topic, path = new_folder(spark, "topic"), new_folder(spark, "rejects")
    records = damaged_records(spark, sf).withColumn("key", F.col("doc_id").cast("string"))
    write_messages(records, topic)
    run_enrichment(topics.read_topic_files(spark, topic), path)
    rejects = spark.read.parquet(f"{path}/rejected")
    return rejects.select(F.col("key").cast("bigint").alias("doc_id"), "reject_reason")


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched products, then a version of each that is a day older, through the ingest stream in
    several micro-batches. The collection holds the newer ones."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "collection")
    products = raw_products(spark, sf)
    write_messages(topics.keyed_records(products), topic, day=2)
    write_messages(topics.keyed_records(products.withColumn("title", F.lit("older"))), topic, day=1)
    jobs.start_ingest(
        topics.read_topic_files(spark, topic, files_per_batch=4),
        path,
        checkpoint=f"{path}-checkpoint",
        dims=DIMS,
    ).awaitTermination()
    return ingest_rows(store.read_collection(spark, path))


def q_stream_ingest_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The same with keyed state: the newer products are stored first, and the older versions that come later are dropped
    before they are written. The rows are those the micro-batches wrote, unmerged."""
    topic, path = new_folder(spark, "topic"), new_folder(spark, "collection")
    products = raw_products(spark, sf)
    write_messages(topics.keyed_records(products), topic, day=2)
    before = spark.conf.get(newest.STATE_STORE, None)
    spark.conf.set(newest.STATE_STORE, newest.ROCKS_DB)
    try:
        for title in (None, "older"):
            if title:
                write_messages(topics.keyed_records(products.withColumn("title", F.lit(title))), topic, day=1)
            jobs.start_ingest(
                topics.read_topic_files(spark, topic), path, f"{path}-checkpoint", DIMS, drop_late=True
            ).awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(newest.STATE_STORE)
        else:
            spark.conf.set(newest.STATE_STORE, before)
    return ingest_rows(spark.read.parquet(f"{path}/changes/*"))


QUERIES = {
    name[2:]: function for name, function in list(globals().items()) if name.startswith("q_")
}
