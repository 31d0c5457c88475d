"""Packing tokenised documents into sequences of a fixed capacity, by exact complements and then best fit.

Only the number of pieces of each length matters to the plan, so the plan is made from a histogram that has at most
``capacity`` rows however many documents there are. Sequences are opened with the longest length that is left; a gap is
filled exactly by one, two or three lengths that sum to it, looked up in hashes of sums and taken as often as all of
them are available, and else by the longest length that fits. The plan says, for ranges of pieces of each length, which
sequences they go to; pieces are numbered within their length by a shuffle of narrow rows.
"""

from __future__ import annotations

import functools
import json
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfseek.llm.ranks import numbered
from shelfseek.llm.text_arrays import batch_map, text_bytes
from shelfseek.scratch import stored

#: Fixed values of the contract: tokens of a sequence, and the id that ends a document.
CAPACITY = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
#: Pieces of text that are looked up at once, and distinct ones that a task remembers.
SPANS_AT_ONCE = 1 << 20
REMEMBERED = 1 << 19

LETTER = np.array([0x41 <= (b & 0xDF) <= 0x5A and b < 0x80 for b in range(256)])
SIGN = np.array([0x21 <= b < 0x7F and not chr(b).isalnum() for b in range(256)])

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: printable Latin-1 as it is, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class SpanTokenizer:
    """Ids of whole texts, from a tokenizer that is asked once for each distinct span between certain token borders.

    A byte-level tokenizer splits texts into words of letters with one space before, numbers, signs and white space
    before it merges. So a border is certain before a single space between two characters that are not white space, and
    between an ASCII letter and an ASCII sign. Spans of letters alone are one word each, and go to the merging model
    itself; all others go through the whole tokenizer. A tokenizer of another make gets whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        made = json.loads(self.tokenizer.to_str())
        splitter, model = made["pre_tokenizer"] or {}, made["model"]
        self.splits = (
            made["normalizer"] is None
            and (splitter.get("type"), splitter.get("use_regex", True)) == ("ByteLevel", True)
            and not splitter.get("add_prefix_space", True)
            and model["type"] == "BPE"
        )
        self.special = [t["content"].encode() for t in made["added_tokens"]]
        if self.splits:
            # No cache of the model's own: what is asked for is new.
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            self.model = BPE(model["vocab"], merges, cache_capacity=0)
            self.letters = byte_letters()

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Where certain borders are."""
        if not self.splits or len(data) < 3:
            return np.empty(0, np.int64)
        at = np.flatnonzero(data[1:-1] == 0x20) + 1
        before, after = data[at - 1], data[at + 1]
        latin = (before >= 0x80) & (data[at - 2] == 0xC3) & (at >= 2)
        known_before = ((before > 0x20) & (before < 0x7F)) | latin
        spaces = at[known_before & (((after > 0x20) & (after < 0x7F)) | (after == 0xC3))]
        whole = data.tobytes()
        if any(token in whole for token in self.special):
            return spaces
        signs = np.flatnonzero(LETTER[data[:-1]] & SIGN[data[1:]]) + 1
        return np.sort(np.concatenate([spaces, signs]))

    def is_word(self, text: str) -> bool:
        letters = text[1:] if text[:1] == " " else text
        return self.splits and letters.isalpha() and max(letters) < "\u0100"

    def learn(self, spans: list[bytes]) -> None:
        """Remember the ids of ``spans``, as bytes of 32-bit numbers."""
        others = []
        for span in spans:
            text = span.decode()
            if self.is_word(text):
                word = "".join([self.letters[b] for b in span])
                self.known[span] = array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
            else:
                others.append((span, text))
        encoded = self.tokenizer.encode_batch_fast([t for _, t in others], add_special_tokens=False)
        for (span, _), ids in zip(others, encoded, strict=True):
            self.known[span] = array("I", ids.ids).tobytes()

    def of_spans(self, data: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the spans that begin at ``starts`` and fill ``data`` up to ``end``, and how many each span has."""
        first = int(starts[0])
        offsets = np.append(starts, end) - first
        buffers = [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data[first:end].tobytes())]
        spans = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        distinct = spans.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self.known = {}
        self.learn([x for x in distinct if x not in self.known])
        found = [self.known[x] for x in distinct]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, begins = np.frombuffer(b"".join(found), np.uint32), np.cumsum(sizes) - sizes
        which = spans.indices.to_numpy()
        counts = sizes[which]
        before = np.cumsum(counts) - counts
        return flat[np.repeat(begins[which] - before, counts) + np.arange(int(counts.sum()))], counts

    def ids(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a batch."""
        data, offsets = text_bytes(column)
        first, cuts = offsets[:-1][np.diff(offsets) > 0], self.cuts(data)
        # A text may begin with a space that looks like a border; it is one anyway.
        starts = np.insert(cuts, np.searchsorted(cuts, first), first)
        starts = starts[np.append(np.diff(starts) > 0, True)] if len(starts) else starts
        parts, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for lo in range(0, len(starts), SPANS_AT_ONCE):
            hi = min(lo + SPANS_AT_ONCE, len(starts))
            ids, sizes = self.of_spans(data, starts[lo:hi], int(starts[hi]) if hi < len(starts) else len(data))
            parts.append(ids)
            counts.append(sizes)
        flat = np.concatenate(parts)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        borders = ends[np.searchsorted(starts, offsets)]
        for lo, hi in zip(borders[:-1], borders[1:], strict=True):
            yield flat[lo:hi]


@functools.lru_cache(maxsize=2)
def span_tokenizer(path: str) -> SpanTokenizer:
    """One for each worker process."""
    return SpanTokenizer(path)


def piece_borders(length: int, capacity: int) -> list[int]:
    """Where the pieces of a document begin, and its end; only the first piece may be shorter."""
    first = length % capacity or capacity
    return [0, *range(first, length + 1, capacity)] if length else [0]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``PIECES`` of each document's tokens, its end id included, and the token ids where asked.

    A null text has only the end. ``path`` names a byte-level tokenizer's file.
    """
    path = path or tokenizer_path()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, number, starts, lengths, sums, tokens = [], [], [], [], [], []
        for row, ids in enumerate(span_tokenizer(path).ids(batch["text"])):
            ended = np.append(ids, np.uint32(END_ID)).astype("<u4")
            borders = piece_borders(len(ended), capacity)
            for k, (lo, hi) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
                rows.append(row)
                number.append(k)
                starts.append(lo)
                lengths.append(hi - lo)
                sums.append(zlib.crc32(ended[lo:hi].tobytes()))
                if with_ids:
                    tokens.append(ended[lo:hi].astype(np.int32))
        made = {
            "doc_id": batch["doc_id"].take(pa.array(rows, pa.int64())),
            "piece": pa.array(number, pa.int32()),
            "start": pa.array(starts, pa.int64()),
            "length": pa.array(lengths, pa.int64()),
            "ids_crc32": pa.array(sums, pa.int64()),
        }
        if with_ids:
            made["ids"] = pa.array(tokens, pa.list_(pa.int32()))
        return pa.RecordBatch.from_pydict(made)

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return batch_map(plain, cut, PIECES + (", ids array<int>" if with_ids else ""))


# The plan


class Complements:
    """How often each length is left, with look-ups of one, two or three lengths that sum to a gap.

    Counts only fall, so a combination that is not available never is again: the place where a sum's search stopped is
    remembered, and all searches together pass each pair of lengths once.
    """

    def __init__(self, counts: np.ndarray):
        self.left = [int(n) for n in counts]
        self.pair_at: dict[int, int] = {}
        self.triple_at: dict[int, int] = {}
        self.longest = len(self.left) - 1

    def available(self, lengths: tuple[int, ...]) -> int:
        """How often all of ``lengths`` can be taken."""
        return min(self.left[x] // n for x, n in Counter(lengths).items())

    def take(self, lengths: tuple[int, ...], times: int = 1) -> None:
        for x in lengths:
            self.left[x] -= times

    def pair(self, total: int) -> tuple[int, ...] | None:
        """The pair with the longest part that sums to ``total``."""
        at = self.pair_at.get(total, min(total - 1, self.longest))
        while at > 0 and at >= total - at:
            if self.left[at] and self.available((at, total - at)):
                self.pair_at[total] = at
                return at, total - at
            at -= 1
        self.pair_at[total] = 0
        return None

    def triple(self, total: int) -> tuple[int, ...] | None:
        """The triple with the longest part, and a pair for the rest, that sums to ``total``."""
        at = self.triple_at.get(total, min(total - 2, self.longest))
        while at > 0:
            rest = self.pair(total - at) if self.left[at] else None
            if rest and self.available((at, *rest)):
                self.triple_at[total] = at
                return at, *rest
            at -= 1
        self.triple_at[total] = 0
        return None

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths that sum to ``gap`` exactly."""
        if gap <= self.longest and self.left[gap]:
            return (gap,)
        return self.pair(gap) or self.triple(gap)

    def best_fit(self, gap: int) -> tuple[int, ...] | None:
        """The longest length left that fits into ``gap``."""
        return next(((x,) for x in range(min(gap, self.longest), 0, -1) if self.left[x]), None)

    def sequence(self, opening: int, capacity: int) -> tuple[int, ...]:
        """Take the lengths of one sequence that begins with ``opening``."""
        content = (opening,)
        self.take(content)
        while gap := capacity - sum(content):
            more = self.filling(gap) or self.best_fit(gap)
            if more is None:
                break
            self.take(more)
            content += more
        return content


@dataclass(frozen=True)
class Plan:
    """For each range of pieces of one length: from which number in its length, to which first sequence and offset.

    ``keys`` are ``length << 40 | number`` where a range begins, ascending; the pieces of a range go to consecutive
    sequences, at the same offset.
    """

    keys: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray
    total: int

    def place(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (lengths.astype(np.int64) << 40) | numbers
        at = np.searchsorted(self.keys, wanted, side="right") - 1
        return self.sequences[at] + wanted - self.keys[at], self.offsets[at]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Where to put ``counts[n]`` pieces of each length n up to ``capacity``.

    A sequence's lengths are taken as many times as they are all left, so a step uses up some length (or leaves less of
    it than one sequence holds), and the number of steps depends on the capacity and not on the number of pieces.
    """
    lengths = Complements(counts)
    used = [0] * len(counts)
    ranges: list[tuple[int, int, int]] = []
    total = 0
    for opening in range(len(counts) - 1, 0, -1):
        while lengths.left[opening]:
            content = lengths.sequence(opening, capacity)
            again = lengths.available(content)
            lengths.take(content, again)
            offset = 0
            for length in content:
                ranges.append((length << 40 | used[length], total, offset))
                used[length] += 1 + again
                offset += length
            total += 1 + again
    keys, sequences, offsets = np.array(sorted(ranges), np.int64).reshape(-1, 3).T
    return Plan(keys, sequences, offsets, total)


def packed(pieces_: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces_`` (with ``length``) and each one's ``sequence_id`` and ``offset``."""
    spark = pieces_.sparkSession
    # Rows are told apart by their place in the table, so that many equal rows spread like any others.
    table = stored(pieces_.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    counted = table.groupBy("length").agg(F.count("*").alias("_rows"))
    counts = np.zeros(capacity + 1, np.int64)
    held = counted.toArrow()
    counts[held["length"].to_numpy()] = held["_rows"].to_numpy()
    where = plan(counts, capacity)
    groups = spark.createDataFrame(
        [(n, int(k)) for n, k in enumerate(counts) if k], "length bigint, _rows bigint"
    )
    ranked = numbered(table, "length", groups, [F.col("_spread")], "_number").drop("_spread", "_rows")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = where.place(*[batch[c].to_numpy(zero_copy_only=False) for c in ("length", "_number")])
            kept = [c for c in batch.schema.names if c != "_number"]
            columns = [batch[c] for c in kept] + [pa.array(x, pa.int64()) for x in at]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_number"]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def sequences(packed_: DataFrame) -> DataFrame:
    """(sequence_id, ids, length) of each sequence, from packed pieces that hold their ``ids``.

    A sequence holds at most its capacity of tokens, so each group is small.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    together = packed_.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length"))
    return together.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), "length")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packed(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")))
