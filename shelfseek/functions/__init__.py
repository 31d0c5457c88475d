from shelfseek.functions.records import json_field, parse_object, json_text, with_property
from shelfseek.functions.text import (
    bm25_idf,
    bm25_weight,
    has_term,
    match_terms,
    term_counts,
    tokenize,
)
from shelfseek.functions.vectors import dot_product, dot_product_columns, vector_enforce

__all__ = [
    "bm25_idf",
    "bm25_weight",
    "dot_product",
    "dot_product_columns",
    "has_term",
    "json_field",
    "json_text",
    "match_terms",
    "parse_object",
    "term_counts",
    "tokenize",
    "vector_enforce",
    "with_property",
]
