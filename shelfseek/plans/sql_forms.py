"""Both searches as SQL table functions, and the ingest transform as one SQL statement.

A client that speaks SQL calls a search by name, gives its parameters by name, and leaves out those that keep their
defaults::

    create_search_functions(spark, "products")
    spark.sql("SELECT * FROM vector_search(embedding => array(0.1D, 0.2D), brand => 'playstation')")
    spark.sql("SELECT * FROM full_text_search(terms => array('space', 'wars', 'ships'), max_price => 20)")

Terms, filters and limits become literals of the plan, so a price range reaches the scan as in the DataFrame forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfseek.functions.text import K1, TOKEN_PATTERN, B
from shelfseek.functions.embedding import DEFAULT_DIMS
from shelfseek.operators.ingest import BRAND_NOISE, DEFAULT_ORIGIN, DEFAULT_PRICE
from shelfseek.operators.search import DEFAULT_BRAND, DEFAULT_LIMIT, DEFAULT_MAX_PRICE, DEFAULT_MIN_PRICE, DEFAULT_TERMS

RESULT = "asin STRING, title STRING, brand STRING, description STRING, estimated_price DOUBLE, brand_tokens ARRAY<STRING>"
SHOWN = "asin, title, brand, description, estimated_price, brand_tokens"


def first_rows(rows: str, order: str, columns: str, limit: str) -> str:
    """The first rows by place, which Spark plans as a top-k of each task: LIMIT takes no parameter of a function."""
    return f"""SELECT {columns} FROM (
  SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM {rows}
) WHERE place <= {limit}"""


def filters(name: str) -> str:
    """The parameters both searches share, and what they ask of a product ``c``."""
    return (
        f"c.estimated_price BETWEEN {name}.min_price AND {name}.max_price "
        f"AND array_contains(c.brand_tokens, lower({name}.brand))"
    )


FILTER_PARAMETERS = f"""min_price DOUBLE DEFAULT {DEFAULT_MIN_PRICE}D,
  max_price DOUBLE DEFAULT {DEFAULT_MAX_PRICE}D,
  brand STRING DEFAULT '{DEFAULT_BRAND}',
  limit_to INT DEFAULT {DEFAULT_LIMIT}"""


def vector_search_function(collection: str, name: str) -> str:
    similarity = f"""CASE WHEN size(c.embedding) <> size({name}.embedding)
           THEN raise_error('the query vector has another length')
           ELSE aggregate(zip_with(c.embedding, {name}.embedding, (x, y) -> double(x) * double(y)),
                          0D, (total, x) -> total + x) END AS similarity"""
    rows = f"(SELECT c.*, {similarity} FROM {collection} c WHERE {filters(name)})"
    order = "similarity DESC NULLS LAST, asin"
    return f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(
  embedding ARRAY<FLOAT>,
  {FILTER_PARAMETERS}
) RETURNS TABLE ({RESULT}, similarity DOUBLE)
RETURN {first_rows(rows, order, f"{SHOWN}, similarity", f"{name}.limit_to")}"""


def full_text_search_function(collection: str, name: str) -> str:
    """Any number of terms; each counts once. Statistics are those of the whole collection; a row for each term that a
    passing product holds, with how often it does, meets the term's count where it arises, and only the winners are looked
    up again. The counts, a row for each term, go to all tasks: a term is no key to shuffle by, as every product may hold it."""
    asked = f"array_distinct({name}.terms)"
    corpus = f"(SELECT struct(count(*) AS documents, avg(coalesce(size(description_tokens), 0)) AS avgdl) FROM {collection})"
    held = f"""(SELECT term, count(*) AS df
      FROM (SELECT explode(array_intersect({asked}, description_tokens)) AS term FROM {collection}) GROUP BY term)"""
    hits = f"""(SELECT asin, estimated_price, dl, asked, pos, hit.term, hit.tf
      FROM (SELECT asin, estimated_price, size(description_tokens) AS dl, asked, posexplode(transform(
          array_intersect({asked}, description_tokens),
          t -> struct(t AS term, size(filter(description_tokens, w -> w = t)) AS tf))) AS (pos, hit)
        FROM (SELECT c.*, size({asked}) AS asked FROM {collection} c WHERE {filters(name)})))"""
    weight = f"""ln(1 + (corpus.documents - df + 0.5D) / (df + 0.5D))
          * (tf * ({K1}D + 1) / (tf + {K1}D * (1 - {B}D + {B}D * dl / corpus.avgdl)))"""
    scored = f"""(SELECT asin AS found, estimated_price AS price,
        aggregate(sort_array(collect_list(struct(pos, weight))), 0D, (total, x) -> total + x.weight) AS text_search_score
      FROM (SELECT *, {weight} AS weight FROM (
        SELECT /*+ BROADCAST(held) */ *, {corpus} AS corpus FROM {hits} JOIN {held} AS held USING (term)))
      GROUP BY asin, estimated_price, asked
      HAVING count(*) >= CASE WHEN {name}.match_all THEN asked ELSE 1 END)"""
    winners = first_rows(scored, "text_search_score DESC, price, found", "found, text_search_score", f"{name}.limit_to")
    terms = ", ".join(f"'{t}'" for t in DEFAULT_TERMS)
    return f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(
  terms ARRAY<STRING> DEFAULT array({terms}),
  {FILTER_PARAMETERS},
  match_all BOOLEAN DEFAULT false
) RETURNS TABLE ({RESULT}, text_search_score DOUBLE)
RETURN SELECT {SHOWN}, text_search_score FROM {collection} JOIN ({winners}) ON asin = found"""


def create_search_functions(
    spark: SparkSession, collection: str, vector_name: str = "vector_search", text_name: str = "full_text_search"
) -> None:
    """Create both functions in the session, over the table or view ``collection``."""
    spark.sql(vector_search_function(collection, vector_name))
    spark.sql(full_text_search_function(collection, text_name))


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), :tokens, 0)"


INGEST_SQL = f"""
SELECT * EXCEPT (embedding), asin AS _id,
       coalesce(try_cast(price AS DOUBLE), {DEFAULT_PRICE}D) AS estimated_price,
       CASE WHEN size(try_cast(try_element_at(embedding, 1) AS ARRAY<FLOAT>)) = :dims
             AND NOT exists(try_cast(try_element_at(embedding, 1) AS ARRAY<FLOAT>), x -> x IS NULL OR isnan(x))
            THEN try_cast(try_element_at(embedding, 1) AS ARRAY<FLOAT>) END AS embedding,
       array_remove({tokens('brand')}, '{BRAND_NOISE}') AS brand_tokens,
       {tokens('description')} AS description_tokens,
       :origin AS origin
FROM {{products}}
"""


def ingest_transform_sql(products: DataFrame, dims: int = DEFAULT_DIMS, origin: str = DEFAULT_ORIGIN) -> DataFrame:
    """``ingest_transform`` as one parameterised statement; no view of the session is touched."""
    kept = products.drop("_meta")
    values = {"dims": dims, "origin": origin, "tokens": TOKEN_PATTERN}
    return products.sparkSession.sql(INGEST_SQL, args=values, products=kept)
