"""Texts of an Arrow batch as byte arrays: words, lines, windows and their 64-bit hashes, without loops over rows.

A batch's texts lie in one buffer; everything here works on that buffer in pieces of bounded size, so memory
follows the number of words found and not the number of bytes times the number of steps.
"""

from __future__ import annotations

import ctypes
import io
import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import SparkContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

PIECE = 1 << 18
#: A batch is worked on in slices of rows that hold about so many bytes of text.
SLICE_BYTES = 8 << 20
# An odd number and its inverse modulo 2**64: powers of the one weigh the bytes of a span, powers of the
# other move a span's sum to where it would be at position 0.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: For words ``[^\x20\x09-\x0D]+``.
NOT_WHITE = np.array([b not in WHITE for b in range(256)])
#: For words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased texts.
ALPHANUMERIC = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def batch_map(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | Iterable[pa.RecordBatch]],
    schema: str | StructType,
    text: str | None = "text",
    size: int = SLICE_BYTES,
) -> DataFrame:
    """``mapInArrow`` for functions of one batch, called with slices that hold about ``size`` bytes of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, text, size) if text else [batch]:
                made = work(part)
                if isinstance(made, pa.Table):
                    yield from made.to_batches()
                elif isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made

    return df.mapInArrow(giving_back(run), schema)


def sliced(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, a row at least."""
    _, offsets = text_bytes(batch[text])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def give_back() -> None:
    """Hands free memory back to the system. A Python worker waits for its next task with what the last one left it."""
    pa.default_memory_pool().release_unused()
    # Of the GNU C library only.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's work that leaves no free memory with its Python worker."""

    def run(rows: Iterator) -> Iterator:
        try:
            yield from work(rows)
        finally:
            give_back()

    return run


class Shared:
    """A value broadcast to the tasks, compressed, with the classes it is made of, and unpacked once in each task."""

    def __init__(self, context: SparkContext, value: object):
        packed = io.BytesIO()
        # Written and read as a stream: the pickled value is never whole beside the packed one.
        with zstandard.ZstdCompressor(level=1).stream_writer(packed, closefd=False) as out:
            cloudpickle.dump(value, out)
        self.packed = context.broadcast(packed.getvalue())
        self.unpacked: list = []

    def __reduce__(self):
        return restored, (self.packed,)

    @property
    def value(self):
        if not self.unpacked:
            with zstandard.ZstdDecompressor().stream_reader(self.packed.value) as packed:
                self.unpacked.append(pickle.load(io.BufferedReader(packed)))
        return self.unpacked[0]

    def destroy(self) -> None:
        """Remove all copies, when no job will read them again."""
        self.packed.destroy()


def restored(packed) -> Shared:
    shared = Shared.__new__(Shared)
    shared.packed, shared.unpacked = packed, []
    return shared


def unused(name: str, columns: list[str]) -> str:
    """A column name that is not taken."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, one position more than texts. Null counts as empty."""
    filled = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    buffer = filled.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return data[first:last], offsets - first


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


_POWERS: dict[str, np.ndarray] = {}


def piece_powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        _POWERS["up"], _POWERS["down"] = powers(BASE, PIECE + 1), powers(BASE_INVERSE, PIECE + 1)
    return _POWERS["up"], _POWERS["down"]


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of member bytes begin and end; no run crosses from one text into the next."""
    starts, ends = [], []
    breaks = offsets[1:-1]
    breaks = np.unique(breaks[(breaks > 0) & (breaks < len(data))])
    for lo in range(0, len(data), PIECE):
        hi = min(lo + PIECE, len(data))
        inside = member[data[lo:hi]]
        before = np.empty(hi - lo, bool)
        before[1:] = inside[:-1]
        before[0] = lo > 0 and member[data[lo - 1]]
        cut = breaks[np.searchsorted(breaks, lo) : np.searchsorted(breaks, hi)] - lo
        # A text's first byte begins a run, and ends the one before it.
        closed = ~inside & before
        closed[cut] = before[cut]
        opened = inside & ~before
        opened[cut] = inside[cut]
        starts.append(np.flatnonzero(opened) + lo)
        ends.append(np.flatnonzero(closed) + lo)
    if len(data) and member[data[-1]]:
        ends.append(np.array([len(data)]))
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *starts]), np.concatenate([empty, *ends])


def rows_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text each position lies in."""
    return np.searchsorted(offsets, positions, side="right") - 1


def prefix_sums(data: np.ndarray, *wanted: np.ndarray) -> list[np.ndarray]:
    """At each wanted position (ascending), the weighted sum of the bytes before it."""
    up, _ = piece_powers()
    found = [np.zeros(len(at), np.uint64) for at in wanted]
    carry, scale = np.uint64(0), np.uint64(1)
    sums = np.empty(PIECE + 1, np.uint64)
    with np.errstate(over="ignore"):
        for lo in range(0, len(data), PIECE):
            hi = min(lo + PIECE, len(data))
            n = hi - lo
            weighted = (data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:n]
            sums[0] = 0
            np.cumsum(weighted, out=sums[1 : n + 1])
            last = hi == len(data)
            for at, out in zip(wanted, found, strict=True):
                a, b = np.searchsorted(at, lo), np.searchsorted(at, hi, side="right" if last else "left")
                out[a:b] = carry + scale * sums[at[a:b] - lo]
            carry = carry + scale * sums[n]
            scale = scale * up[PIECE]
    return found


def moved_to_zero(sums: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of spans that begin at ``starts``, as if they began at 0."""
    _, down = piece_powers()
    whole = powers(down[PIECE], int(starts[-1] // PIECE) + 1 if len(starts) else 1)
    with np.errstate(over="ignore"):
        return sums * down[starts % PIECE] * whole[starts // PIECE]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes and length. Starts and ends each ascend; spans may overlap."""
    first, last = prefix_sums(data, starts, ends)
    with np.errstate(over="ignore"):
        lengths = (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mixed(moved_to_zero(last - first, starts) + lengths)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive words, whatever texts they belong to."""
    n = max(0, len(words) - size + 1)
    total = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = total * BASE + words[k : k + n]
        return mixed(total)


class Words:
    """The words of a batch's texts: ``hashes``, ``starts`` and ``ends`` of all words in order, ``rows`` the text
    each belongs to, and ``first[i]`` to ``first[i + 1]`` the words of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
        self.starts, self.ends = spans(data, offsets, member)
        self.hashes = span_hashes(data, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.rows = np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each window of ``size`` words inside one text, and the word it begins with."""
        hashes = window_hashes(self.hashes, size)
        inside = np.flatnonzero(self.rows[: len(hashes)] == self.rows[size - 1 :][: len(hashes)])
        return hashes[inside], inside


def sums_by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i] : first[i + 1]]`` for each i."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the half-open spans."""
    edges = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(edges)[:n] > 0


def distinct(keys: np.ndarray) -> np.ndarray:
    """Marks one occurrence of each key."""
    repeated = found_twice(keys)
    at = np.flatnonzero(repeated)
    _, first = np.unique(keys[at], return_index=True)
    chosen = ~repeated
    chosen[at[first]] = True
    return chosen


def runs(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of marked positions, cut where the row changes."""
    at = np.flatnonzero(mask)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (rows[at[1:]] != rows[at[:-1]])
    first = at[new]
    last = at[np.concatenate([new[1:], np.ones(min(1, len(at)), bool)])]
    return first, last + 1


def counts_by_row(data: np.ndarray, offsets: np.ndarray, *members: np.ndarray) -> list[np.ndarray]:
    """For each class of bytes, how many each text has."""
    at = [np.zeros(len(offsets), np.int64) for _ in members]
    carry = [0] * len(members)
    for lo in range(0, len(data), PIECE):
        hi = min(lo + PIECE, len(data))
        a, b = np.searchsorted(offsets, lo, side="right"), np.searchsorted(offsets, hi, side="right")
        for k, member in enumerate(members):
            sums = np.cumsum(member[data[lo:hi]], dtype=np.int64)
            at[k][a:b] = carry[k] + sums[offsets[a:b] - lo - 1]
            carry[k] += int(sums[-1])
    return [np.diff(x) for x in at]


def row_keys(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that differ from row to row."""
    with np.errstate(over="ignore"):
        return mixed(hashes + mixed(rows.astype(np.uint64) + np.uint64(1)))


def distinct_hashes(keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct hashes in order, the first place of each, for each hash its number among them, and how often each occurs.

    Places are sorted in the last bits of their hashes; only where two hashes differ in nothing but these, by all bits."""
    last = np.uint64((1 << max(len(keys) - 1, 0).bit_length()) - 1)
    packed = np.sort(keys & ~last | np.arange(len(keys), dtype=np.uint64))
    order = (packed & last).astype(np.int64)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if np.any(new[1:] & (packed[1:] & ~last == packed[:-1] & ~last)):
        return np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    at = np.flatnonzero(new)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[at], order[at], number, np.diff(at, append=len(keys))


def binary_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Spans of some bytes, in any order, as a column."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    own = np.empty(offsets[-1], np.uint8)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, side="right")) - 1)
        # A long span alone takes no number for each of its bytes.
        several = np.repeat(starts[lo:hi] - offsets[lo:hi], np.diff(offsets[lo : hi + 1])) + np.arange(offsets[lo], offsets[hi]) if hi > lo + 1 else None
        own[offsets[lo] : offsets[hi]] = data[starts[lo] : ends[lo]] if several is None else data[several]
        lo = hi
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(own)]).cast(pa.binary())


def found_twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    passing = np.zeros(1 << 20, bool)
    passing[(twice >> np.uint64(44)).astype(np.int64)] = True
    found = passing[(keys >> np.uint64(44)).astype(np.int64)]
    near = np.flatnonzero(found)
    place = np.minimum(np.searchsorted(twice, keys[near]), len(twice) - 1)
    found[near] = twice[place] == keys[near]
    return found
