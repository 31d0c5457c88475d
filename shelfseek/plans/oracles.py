"""The same queries as plain SQL over the given tables, to check results against."""

from __future__ import annotations

from shelfseek.plans.products import BRAND, DIMS, LIMIT, MAX_PRICE, MIN_PRICE, TERMS


# The rules' constants, written out here so that the check does not read them from what it checks.
K1, B = 1.2, 0.75
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
BRAND_NOISE, DEFAULT_ORIGIN, DEFAULT_PRICE = "by", "product_stream", 30.0


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{TOKEN_PATTERN}')"


def rounded(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0::DOUBLE AS {name}"


def sql_list(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


PRODUCTS = f"""products AS (
  SELECT CAST(doc_id AS VARCHAR) AS asin, p_name AS title, 'by ' || p_brand AS brand,
         text AS description,
         CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS price, embedding
  FROM documents JOIN part ON p_partkey = doc_id LEFT JOIN embeddings ON vec_id = doc_id
), collection AS (
  SELECT *, CASE WHEN price IS NULL THEN {DEFAULT_PRICE} ELSE price END AS estimated_price,
         [x for x in {tokens('brand')} if x <> '{BRAND_NOISE}'] AS brand_tokens,
         {tokens('description')} AS description_tokens
  FROM products
)"""

PASSES = f"estimated_price BETWEEN {MIN_PRICE} AND {MAX_PRICE} AND list_contains(brand_tokens, '{BRAND}')"
SHOWN = "asin, title, brand, description, estimated_price, array_to_string(brand_tokens, ' ') AS brand_tokens"


def dot(left: str, right: str) -> str:
    return f"list_inner_product({left}::DOUBLE[], {right}::DOUBLE[])"


VECTOR_RANKED = f"""question AS (SELECT embedding AS q FROM embeddings WHERE vec_id = 0),
vector_scored AS (
  SELECT c.*, {dot('embedding', 'q')} AS similarity FROM collection c, question WHERE {PASSES}
)"""

VECTOR_SEARCH = f"""WITH {PRODUCTS}, {VECTOR_RANKED}
SELECT {SHOWN}, {rounded('similarity', 'similarity')}
FROM (SELECT * FROM vector_scored ORDER BY similarity DESC NULLS LAST, asin LIMIT {LIMIT})"""

# Fixed values of the approximate search: cells, rounds of k-means, and how far a question looks.
CELLS, ROUNDS, REACH, REFINE, EXACT_ROWS = 32, 4, 0.7, 3, 100


def cell_of(vectors: str, centres: str) -> str:
    """Each vector's nearest centre; of equally near ones, the first."""
    near = f"{dot('v', 'centre')} - {dot('centre', 'centre')} / 2"
    return f"""SELECT asin, v, cell FROM {vectors} CROSS JOIN {centres}
  QUALIFY row_number() OVER (PARTITION BY asin ORDER BY {near} DESC, cell) = 1"""


def fitted_cells() -> str:
    """k-means round by round, centres rounded to four decimals."""
    parts = [
        f"""known AS (SELECT asin, embedding::DOUBLE[] AS v FROM collection WHERE embedding IS NOT NULL),
centres0 AS (
  SELECT (row_number() OVER (ORDER BY md5(asin), asin) - 1)::INTEGER AS cell, list_transform(v, lambda x: round(x, 4)) AS centre
  FROM known QUALIFY cell < {CELLS}
)"""
    ]
    for k in range(ROUNDS):
        parts.append(f"""placed{k} AS ({cell_of('known', f'centres{k}')}),
means{k} AS (
  SELECT cell, list(round(mean, 4) ORDER BY place) AS centre FROM (
    SELECT cell, place, avg(v[place]) AS mean FROM placed{k}, (SELECT unnest(range(1, {DIMS + 1})) AS place) GROUP BY ALL)
  GROUP BY cell
), centres{k + 1} AS (
  SELECT cell, coalesce(m.centre, c.centre) AS centre FROM centres{k} c LEFT JOIN means{k} m USING (cell)
)""")
    parts.append(f"celled AS ({cell_of('known', f'centres{ROUNDS}')})")
    return ",\n".join(parts)


def probed(questions: str) -> str:
    """CTEs ``rows_of``, ``asked`` and ``chosen``: the cells each question of (query_id, q, wanted) looks into."""
    return f"""rows_of AS (
  SELECT brand, cell, count(*) AS rows
  FROM (SELECT unnest(list_distinct(brand_tokens)) AS brand, cell FROM collection JOIN celled USING (asin)) GROUP BY ALL
), asked AS (
  SELECT query_id, cell, rows, {dot('centre', 'q')} AS near, sum(rows) OVER (PARTITION BY query_id) AS total
  FROM {questions} JOIN rows_of ON brand = wanted JOIN centres{ROUNDS} USING (cell)
), chosen AS (
  SELECT query_id, cell, total <= {EXACT_ROWS} AS exact FROM asked
  QUALIFY total <= {EXACT_ROWS} OR coalesce(sum(rows) OVER (
    PARTITION BY query_id ORDER BY near DESC, cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < {REACH} * total
)"""


ANN_SEARCH = f"""WITH {PRODUCTS}, {fitted_cells()},
question AS (SELECT 0 AS query_id, embedding AS q, '{BRAND}' AS wanted FROM embeddings WHERE vec_id = 0),
{probed('question')}, near AS (
  SELECT c.*, {dot('embedding', 'q')} AS similarity
  FROM collection c JOIN celled USING (asin) JOIN chosen USING (cell), question WHERE {PASSES}
)
SELECT {SHOWN}, {rounded('similarity', 'similarity')}
FROM (SELECT * FROM near ORDER BY similarity DESC, asin LIMIT {LIMIT})"""

ANN_PAIRS = f"""{PRODUCTS}, {fitted_cells()}, queries AS (
  SELECT vec_id AS query_id, embedding AS q,
         CASE WHEN vec_id % 2 = 1 THEN regexp_extract(p_brand, '[0-9]+') ELSE '{BRAND}' END AS wanted
  FROM embeddings JOIN part ON p_partkey = vec_id
), {probed('queries')}, pairs AS (
  SELECT query_id, asin, {dot('embedding', 'q')} AS similarity, exact
  FROM queries JOIN collection ON list_contains(brand_tokens, wanted) JOIN celled USING (asin)
  LEFT JOIN chosen USING (query_id, cell)
  WHERE estimated_price BETWEEN {MIN_PRICE} AND {MAX_PRICE}
)"""

ANN_RECALL = f"""WITH {ANN_PAIRS}, best AS (
  SELECT query_id, asin FROM pairs
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, asin) <= {LIMIT}
), found AS (
  SELECT query_id, asin FROM pairs WHERE exact IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, asin) <= {LIMIT}
)
SELECT query_id, count(found.asin) / count(*)::DOUBLE AS recall
FROM best LEFT JOIN found USING (query_id, asin) GROUP BY query_id"""

ANN_CANDIDATE_SHARE = f"""WITH {ANN_PAIRS}, counted AS (
  SELECT query_id, least(count(*), CASE WHEN any_value(exact) THEN {EXACT_ROWS} ELSE {REFINE * LIMIT} END) AS candidates
  FROM pairs WHERE exact IS NOT NULL GROUP BY query_id
)
SELECT query_id, candidates, {rounded('candidates / (SELECT count(*) FROM known)::DOUBLE', 'share')} FROM counted"""

VECTOR_SEARCH_RANKED = VECTOR_SEARCH.replace(
    f"SELECT {SHOWN}", f"SELECT row_number() OVER (ORDER BY similarity DESC NULLS LAST, asin)::INTEGER AS rank, {SHOWN}", 1
)

INGEST_REJECTS = f"""SELECT CAST(p_partkey AS VARCHAR) AS asin, 'price_not_a_number' AS reason FROM part WHERE p_partkey % 5 = 0
UNION ALL
SELECT CAST(vec_id AS VARCHAR), 'embedding_unusable' FROM embeddings JOIN part ON p_partkey = vec_id WHERE vec_id % 4 <> 0"""

POSTINGS = """tok AS (SELECT asin, unnest(description_tokens) AS term FROM collection),
tf AS (SELECT asin, term, count(*) AS tf FROM tok GROUP BY asin, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
stats AS (SELECT count(*) AS documents, avg(len(description_tokens)) AS avgdl FROM collection)"""

WEIGHT = f"""ln(1 + (documents - df + 0.5) / (df + 0.5)) * (tf * ({K1} + 1)::DOUBLE)
  / (tf + {K1}::DOUBLE * (1 - {B}::DOUBLE + {B}::DOUBLE * len(description_tokens) / avgdl))"""


def scored(terms: tuple[str, ...], needed: int) -> str:
    return f"""{POSTINGS},
scored AS (
  SELECT asin, sum({WEIGHT} ORDER BY term) AS text_search_score
  FROM tf JOIN df USING (term) JOIN collection USING (asin), stats
  WHERE term IN ({sql_list(terms)})
  GROUP BY asin HAVING count(*) >= {needed}
), matching AS (
  SELECT c.*, text_search_score FROM collection c JOIN scored USING (asin) WHERE {PASSES}
)"""


def full_text_search(needed: int, ranked: bool = False) -> str:
    place = "row_number() OVER (ORDER BY text_search_score DESC, estimated_price, asin)::INTEGER AS rank, " if ranked else ""
    return f"""WITH {PRODUCTS}, {scored(TERMS, needed)}
SELECT {place}{SHOWN}, {rounded('text_search_score', 'text_search_score')}
FROM (SELECT * FROM matching ORDER BY text_search_score DESC, estimated_price, asin LIMIT {LIMIT})"""


REWRITTEN = full_text_search(1).replace(
    "text AS description,",
    "CASE WHEN doc_id % 3 = 0 THEN 'worthless the ' || substr(text, 1, 200) ELSE text END AS description,",
)

BATCH_VECTOR_SEARCH = f"""WITH {PRODUCTS}, queries AS (
  SELECT vec_id AS query_id, embedding AS q,
         CASE WHEN vec_id % 2 = 1 THEN regexp_extract(p_brand, '[0-9]+') ELSE '{BRAND}' END AS wanted
  FROM embeddings JOIN part ON p_partkey = vec_id
), vector_scored AS (
  SELECT query_id, asin, title, estimated_price, {dot('embedding', 'q')} AS similarity
  FROM queries JOIN collection ON list_contains(brand_tokens, wanted)
  WHERE estimated_price BETWEEN {MIN_PRICE} AND {MAX_PRICE}
)
SELECT query_id, rank::INTEGER AS rank, asin, title, estimated_price,
       {rounded('similarity', 'similarity')} FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC NULLS LAST, asin) AS rank
  FROM vector_scored) WHERE rank <= {LIMIT}"""

QUERY_TERMS = """words AS (
  SELECT item_id, [w for w in regexp_split_to_array(text, '\\s+') if w <> ''] AS words FROM benchmark
), placed AS (
  SELECT item_id, word, min(place) AS place
  FROM (SELECT item_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM words)
  GROUP BY item_id, word
)"""

BATCH_TEXT = f"""{POSTINGS}, {QUERY_TERMS},
wanted AS (SELECT item_id AS query_id, lower(word) AS term, min(place) AS place FROM placed GROUP BY ALL),
scored AS (
  SELECT query_id, asin, sum({WEIGHT} ORDER BY place) AS text_search_score
  FROM wanted JOIN tf USING (term) JOIN df USING (term) JOIN collection USING (asin), stats
  WHERE {PASSES}
  GROUP BY query_id, asin
), text_ranked AS (
  SELECT query_id, asin, title, estimated_price, text_search_score,
         row_number() OVER (PARTITION BY query_id
                            ORDER BY text_search_score DESC, estimated_price, asin) AS rank
  FROM scored JOIN collection USING (asin)
)"""

BATCH_FULL_TEXT_SEARCH = f"""WITH {PRODUCTS}, {BATCH_TEXT}
SELECT query_id, rank::INTEGER AS rank, asin, title, estimated_price,
       {rounded('text_search_score', 'text_search_score')}
FROM text_ranked WHERE rank <= {LIMIT}"""

COMPARE_SEARCHES = f"""WITH {PRODUCTS}, {VECTOR_RANKED}, {scored(TERMS, 1)},
vs AS (SELECT asin, title, row_number() OVER (ORDER BY similarity DESC NULLS LAST, asin) AS vs_rank FROM vector_scored),
fts AS (SELECT asin, title, row_number() OVER (
          ORDER BY text_search_score DESC, estimated_price, asin) AS fts_rank FROM matching)
SELECT asin, coalesce(v.title, f.title) AS title,
       vs_rank::INTEGER AS vs_rank, fts_rank::INTEGER AS fts_rank,
       vs_rank IS NOT NULL AND fts_rank IS NOT NULL AS in_both
FROM (SELECT * FROM vs WHERE vs_rank <= {5 * LIMIT}) v
FULL OUTER JOIN (SELECT * FROM fts WHERE fts_rank <= {5 * LIMIT}) f USING (asin)"""


def hashed(source: str, key: str, text: str) -> str:
    """CTE ``hashed``: the non-zero numbers of the hash embedding of ``text``, per ``key``."""
    return f"""hash_tok AS (SELECT {key}, unnest({tokens(text)}) AS token FROM {source}),
hash_count AS (
  SELECT {key}, (('0x' || substr(md5(token), 1, 8))::BIGINT % {DIMS})::INTEGER AS bucket, count(*) AS n
  FROM hash_tok GROUP BY ALL
), hashed AS (
  SELECT {key}, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS weight FROM hash_count
)"""


COMPARE_BATCH = f"""WITH {PRODUCTS}, {BATCH_TEXT},
{hashed('collection', 'asin', 'description')},
q_tok AS (SELECT item_id, unnest({tokens('text')}) AS token FROM benchmark),
q_count AS (
  SELECT item_id, (('0x' || substr(md5(token), 1, 8))::BIGINT % {DIMS})::INTEGER AS bucket, count(*) AS n
  FROM q_tok GROUP BY ALL
), q_hashed AS (
  SELECT item_id, bucket, (n / sqrt(sum(n * n) OVER (PARTITION BY item_id)))::FLOAT AS weight FROM q_count
), buckets AS (SELECT unnest(range({DIMS}))::INTEGER AS bucket),
doc_vectors AS (
  SELECT asin, list(coalesce(weight, 0)::FLOAT::DOUBLE ORDER BY bucket) AS v
  FROM (SELECT DISTINCT asin FROM hashed) CROSS JOIN buckets LEFT JOIN hashed USING (asin, bucket)
  GROUP BY asin
), q_vectors AS (
  SELECT item_id, list(coalesce(weight, 0)::DOUBLE ORDER BY bucket) AS q
  FROM (SELECT DISTINCT item_id FROM q_hashed) CROSS JOIN buckets LEFT JOIN q_hashed USING (item_id, bucket)
  GROUP BY item_id
), vs AS (
  SELECT item_id AS query_id, asin, title, row_number() OVER (
           PARTITION BY item_id ORDER BY list_inner_product(v, q) DESC NULLS LAST, asin) AS vs_rank
  FROM q_vectors, collection LEFT JOIN doc_vectors USING (asin) WHERE {PASSES}
)
SELECT query_id, asin, coalesce(v.title, f.title) AS title,
       vs_rank::INTEGER AS vs_rank, fts_rank::INTEGER AS fts_rank,
       vs_rank IS NOT NULL AND fts_rank IS NOT NULL AS in_both
FROM (SELECT * FROM vs WHERE vs_rank <= {LIMIT}) v
FULL OUTER JOIN (SELECT query_id, asin, title, rank AS fts_rank FROM text_ranked WHERE rank <= {LIMIT}) f
USING (query_id, asin)"""

HASH_EMBED = f"""WITH {hashed('documents', 'doc_id', 'text')}
SELECT doc_id, bucket, {rounded('weight', 'weight')} FROM hashed"""

ENRICHED = f"""WITH {PRODUCTS}, {hashed('products', 'asin', 'description')}
SELECT asin, title, brand, price, bucket, {rounded('weight', 'weight')}
FROM products JOIN hashed USING (asin)"""

REJECTS = f"""SELECT doc_id, reject_reason FROM (
  SELECT doc_id, CASE doc_id % 7 WHEN 1 THEN 'not_json' WHEN 2 THEN 'not_an_object'
         WHEN 3 THEN 'no_description' WHEN 4 THEN 'null_description' WHEN 5 THEN 'not_embedded'
         WHEN 6 THEN 'not_an_object'
         ELSE CASE WHEN len({tokens('text')}) = 0 THEN 'not_embedded' END END AS reject_reason
  FROM documents) WHERE reject_reason IS NOT NULL"""

INGEST = f"""WITH {PRODUCTS}
SELECT asin AS _id, asin, title, brand, md5(description) AS description, price, estimated_price,
       len(embedding)::INTEGER AS dims, round(embedding[1]::DOUBLE, 6) AS first_number,
       array_to_string(brand_tokens, ' ') AS brand_tokens,
       md5(array_to_string(description_tokens, ' ')) AS description_tokens,
       '{DEFAULT_ORIGIN}' AS origin
FROM collection"""

SCANNED = f"""WITH {PRODUCTS}
SELECT asin, title, brand, md5(description) AS description, price FROM products"""

LATEST = """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM {events}
) WHERE place = 1"""

REPLAYED = """(SELECT * FROM events UNION ALL
   SELECT event_id, ts + INTERVAL 1 HOUR, user_id, 'updated', value + 1, props FROM events UNION ALL
   SELECT * FROM events)"""

ORACLES = {
    "vector_search": VECTOR_SEARCH_RANKED,
    "ann_search": ANN_SEARCH,
    "ann_recall": ANN_RECALL,
    "ann_candidate_share": ANN_CANDIDATE_SHARE,
    "vector_search_named": VECTOR_SEARCH,
    "vector_search_sql": VECTOR_SEARCH,
    "vector_search_function": VECTOR_SEARCH,
    "full_text_search_sql": full_text_search(1),
    "full_text_search": full_text_search(1, ranked=True),
    "full_text_search_named": full_text_search(1),
    "full_text_search_indexed": full_text_search(1),
    "text_index_updates": REWRITTEN,
    "full_text_search_all": full_text_search(len(TERMS)),
    "batch_vector_search": BATCH_VECTOR_SEARCH,
    "batch_vector_search_by_key": BATCH_VECTOR_SEARCH,
    "batch_full_text_search": BATCH_FULL_TEXT_SEARCH,
    "batch_full_text_search_by_key": BATCH_FULL_TEXT_SEARCH,
    "compare_searches": COMPARE_SEARCHES,
    "compare_batch": COMPARE_BATCH,
    "metadata_filter": f"""WITH {PRODUCTS} SELECT asin, estimated_price,
        array_to_string(brand_tokens, ' ') AS brand_tokens FROM collection WHERE {PASSES}""",
    "term_filters": f"""WITH {PRODUCTS} SELECT asin,
        list_has_any(description_tokens, [{sql_list(TERMS)}]) AS any_term,
        list_has_all(description_tokens, [{sql_list(TERMS)}]) AS every_term FROM collection""",
    "dot_product": f"""SELECT vec_id, {rounded(dot('embedding', 'q'), 'similarity')},
        {rounded(dot('embedding', 'embedding'), 'self_similarity')}
        FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = 0)""",
    "vector_enforce": f"""SELECT vec_id, vec_id % 4 = 0 AND vec_id % 5 <> 0 AS kept,
        CASE WHEN vec_id % 4 = 0 AND vec_id % 5 <> 0 THEN {DIMS} END AS dims FROM embeddings""",
    "tokenize_terms": f"WITH {PRODUCTS}, {POSTINGS} SELECT asin, term, tf::INTEGER AS tf FROM tf",
    "postings": f"""WITH {PRODUCTS}, {POSTINGS}
        SELECT asin, term, tf::INTEGER AS tf, len(description_tokens)::INTEGER AS dl, estimated_price,
               array_to_string(brand_tokens, ' ') AS brand_tokens FROM tf JOIN collection USING (asin)""",
    "term_statistics": f"WITH {PRODUCTS}, {POSTINGS} SELECT term, df FROM df",
    "corpus_stats": f"WITH {PRODUCTS}, {POSTINGS} SELECT documents, {rounded('avgdl', 'avgdl')} FROM stats",
    "query_terms": f"""WITH {QUERY_TERMS} SELECT item_id, word AS term,
        (row_number() OVER (PARTITION BY item_id ORDER BY place) - 1)::INTEGER AS pos FROM placed""",
    "hash_embed": HASH_EMBED,
    "embed_distinct": HASH_EMBED,
    "publish_records": f"""WITH {PRODUCTS}
        SELECT asin AS key, asin, title, brand, description, price FROM products""",
    "enrich_documents": ENRICHED,
    "reject_reasons": REJECTS,
    "parse_events_json": """SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k,
        (props::JSON ->> 'missing') IS NULL AS missing FROM events""",
    "ingest_transform": INGEST,
    "ingest_transform_sql": INGEST,
    "ingest_rejects": INGEST_REJECTS,
    "upsert_latest": LATEST.format(events="events"),
    "update_replay": LATEST.format(events=REPLAYED),
    "collection_status": f"""WITH {PRODUCTS}
        SELECT count(*) AS documents, count(embedding) AS with_embedding FROM collection""",
    "json_array_scan": SCANNED,
    "json_array_elements": f"""WITH {PRODUCTS}
        SELECT asin, CASE WHEN asin::BIGINT % 7 = 1 THEN 'not_json' END AS reject_reason FROM products""",
    "file_to_topic": f"""WITH {PRODUCTS}
        SELECT asin, title, brand, md5(description) AS description, price, NULL::VARCHAR AS reject_reason
        FROM products WHERE asin::BIGINT % 7 <> 1
        UNION ALL SELECT asin, NULL, NULL, NULL, NULL, 'not_json' FROM products WHERE asin::BIGINT % 7 = 1""",
    "ndjson_scan": SCANNED,
    "stream_enrich": ENRICHED,
    "stream_rejects": REJECTS,
    "stream_ingest": INGEST,
    "stream_ingest_newest": INGEST,
}
