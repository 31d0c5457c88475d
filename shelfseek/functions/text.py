"""Tokens, term predicates and BM25."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runs of letters or digits in any script; BM25 constants of Robertson & Zaragoza (2009).
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
K1 = 1.2
B = 0.75


def tokenize(text: Column) -> Column:
    """Lower-case tokens of ``text`` in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def has_term(tokens: Column, term: str | Column) -> Column:
    """Whether ``term`` is one of ``tokens``; a NULL list has no terms."""
    term = F.lit(term) if isinstance(term, str) else term
    return F.coalesce(F.array_contains(tokens, term), F.lit(False))


def match_terms(tokens: Column, terms: Sequence[str], match_all: bool = False) -> Column:
    """Whether any of ``terms`` is present, or every one with ``match_all``."""
    wanted = F.lit(list(dict.fromkeys(terms)))
    if match_all:
        hit = F.size(F.array_except(wanted, tokens)) == 0
    else:
        hit = F.arrays_overlap(tokens, wanted)
    return F.coalesce(hit, F.lit(False))


def occurrences(tokens: Column, term: str) -> Column:
    """How often ``term`` stands in ``tokens``."""
    return F.size(tokens) - F.size(F.array_remove(tokens, term))


def bm25_idf(documents: Column, containing: Column) -> Column:
    """Weight of a term held by ``containing`` of ``documents`` documents (never negative)."""
    return F.ln(1 + (documents - containing + 0.5) / (containing + 0.5))


def bm25_weight(tf: Column, length: Column, average_length: Column) -> Column:
    """Saturated term frequency, normalised by document length; 0 when the term is absent."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average_length))


def row_numbers(lists: pa.Array) -> np.ndarray:
    """For each flattened list element, the row it came from."""
    return pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)


COUNTED_TERMS = T.ArrayType(T.StructType().add("term", T.StringType()).add("tf", T.IntegerType()))


# Tokens counted at a time, about: what a task holds beside its batch does not grow with the batch.
COUNTED_AT_ONCE = 1 << 17


@F.arrow_udf(COUNTED_TERMS)
def term_counts(tokens: pa.Array) -> pa.Array:
    """Distinct terms of each row's tokens with their counts.

    Counting stays inside the row's own task: exploding first and grouping by (document, term)
    would shuffle every token of the corpus.
    """
    ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
    parts, lo = [], 0
    while lo < len(tokens):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + COUNTED_AT_ONCE, side="right")))
        parts.append(counted_rows(tokens.slice(lo, hi - lo)))
        lo = hi
    return pa.concat_arrays(parts) if parts else counted_rows(tokens)


def counted_rows(tokens: pa.Array) -> pa.Array:
    rows, flat = row_numbers(tokens), tokens.flatten()
    encoded = flat.dictionary_encode()
    known = encoded.is_valid().to_numpy(zero_copy_only=False)
    codes = encoded.indices.filter(pa.array(known)).to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(encoded.dictionary), 1)
    pairs, tf = np.unique(rows[known].astype(np.int64) * width + codes, return_counts=True)
    starts = np.searchsorted(pairs // width, np.arange(len(tokens) + 1))
    terms = encoded.dictionary.take(pa.array(pairs % width)).cast(pa.string())
    counted = pa.StructArray.from_arrays([terms, pa.array(tf.astype(np.int32))], names=["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), counted)
