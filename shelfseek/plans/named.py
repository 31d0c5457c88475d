"""Searches by name, with parameters given as text and typed defaults for those left out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfseek.functions.embedding import Embedder
from shelfseek.functions.vectors import vector_parameter
from shelfseek.operators.search import (
    DEFAULT_BRAND,
    DEFAULT_LIMIT,
    DEFAULT_MAX_PRICE,
    DEFAULT_MIN_PRICE,
    DEFAULT_TERMS,
    embed_query,
    full_text_search,
    vector_search,
)

TYPES: dict[str, Callable] = {"string": str, "int": int, "float": float, "array": vector_parameter}


@dataclass(frozen=True)
class Parameter:
    type: str
    default: object = None

    def read(self, value: object) -> object:
        return TYPES[self.type](value)


FILTERS = {
    "min_price": Parameter("float", DEFAULT_MIN_PRICE),
    "max_price": Parameter("float", DEFAULT_MAX_PRICE),
    "brand": Parameter("string", DEFAULT_BRAND),
    "limit": Parameter("int", DEFAULT_LIMIT),
}
PARAMETERS = {
    "vector_search": {"embedding": Parameter("array"), **FILTERS},
    "full_text_search": {
        "term1": Parameter("string", DEFAULT_TERMS[0]),
        "term2": Parameter("string", DEFAULT_TERMS[1]),
        **FILTERS,
    },
}

VECTOR_SEARCH_SQL = """
SELECT asin, title, brand, description, estimated_price, brand_tokens,
       CASE WHEN size(embedding) <> size(:embedding) THEN raise_error('the query vector has another length')
            ELSE aggregate(zip_with(embedding, :embedding, (x, y) -> double(x) * double(y)),
                           0D, (total, x) -> total + x) END AS similarity
FROM {collection}
WHERE estimated_price BETWEEN :min_price AND :max_price
  AND array_contains(brand_tokens, lower(:brand))
ORDER BY similarity DESC NULLS LAST, asin
LIMIT :limit
"""


def typed_parameters(name: str, given: Mapping[str, object]) -> dict[str, object]:
    """The parameters of a named search: defaults replaced by what is given, each read as its type."""
    known = PARAMETERS[name]
    unknown = set(given) - set(known)
    if unknown:
        raise ValueError(f"{name} has no parameter {', '.join(sorted(unknown))}")
    values = {key: p.default for key, p in known.items()} | dict(given)
    return {key: known[key].read(v) if v is not None else None for key, v in values.items()}


def run_named(
    name: str, collection: DataFrame, embedder: Embedder | None = None, **given: object
) -> DataFrame:
    """Run ``vector_search`` or ``full_text_search``. Without an embedding, the vector search asks for
    the default terms through ``embedder``."""
    values = typed_parameters(name, given)
    if name == "full_text_search":
        terms = (values.pop("term1"), values.pop("term2"))
        return full_text_search(collection, terms, **values)
    if values["embedding"] is None:
        if embedder is None:
            raise ValueError("give an embedding or an embedder")
        values["embedding"] = embed_query(collection, " ".join(DEFAULT_TERMS), embedder)
    return vector_search(collection, **values)


def vector_search_sql(collection: DataFrame, **given: object) -> DataFrame:
    """The vector search as one parameterised SQL statement over a collection; no view of the session is touched."""
    values = typed_parameters("vector_search", given)
    return collection.sparkSession.sql(VECTOR_SEARCH_SQL, args=values, collection=collection)
