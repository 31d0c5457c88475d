"""Which token follows which: a context across the border of two tokens, in numpy, for ``lm_scoring``.

A running text is a sequence of symbols. Each of the commonest pairs of token and class is one, in the order of its key;
the other tokens of a class are one together, and so is the beginning of its texts. How often a symbol followed another in
training texts is counted exactly and mixed with what the model of single tokens says:

    P(token | one before) = P0(token) * (1 - share + share * ratio),
    ratio = (times the token's symbol followed the one before / times anything did) / P0(the token's symbol)

The share is the logistic function of a weight that a gate chooses by how often the symbol before has been seen, learned
online over the training texts. The sum over all tokens is that of P0: at most one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard

from shelfseek.llm.mixing import N_CLASSES
from shelfseek.llm.text_arrays import mixed

#: Bits of a symbol, and of a text's place in a batch with the mark of training texts; a pair and its text fill 64 bits.
SYMBOL_BITS, TEXT_BITS = 20, 24
GATES = 40
START = -2.0
RATE = 0.1
PORTION = 1 << 11


class Symbols:
    """The symbols of some common keys: how often each came before something in training texts, and its probability.

    ``n`` and ``log`` are the training counts and log10 probabilities of the common keys, ``classes`` theirs; ``every`` and
    ``texts`` are how many tokens, ends included, and training texts each class has."""

    def __init__(self, keys: np.ndarray, classes: np.ndarray, n: np.ndarray, log: np.ndarray, is_end: np.ndarray, every: np.ndarray, texts: np.ndarray):
        self.keys = keys
        count = len(keys)
        if count + 2 * N_CLASSES > 1 << SYMBOL_BITS:
            raise ValueError("too many symbols")
        p = 10.0**log
        known = np.bincount(classes, p, N_CLASSES)
        words = np.bincount(classes[~is_end], n[~is_end], N_CLASSES)
        self.before = np.concatenate([np.where(is_end, 0, n), every - texts - words, texts]).astype(np.float64)
        # Logarithms, as a very long token's probability is below the least number.
        self.log = np.concatenate([log, np.log10(np.maximum(1 - known, 1e-9)), np.zeros(N_CLASSES)])
        self.rest, self.start = count, count + N_CLASSES

    def gate(self, symbol: np.ndarray, less: int = 0) -> np.ndarray:
        """By how often a symbol came before something, by doublings; 0 where it never did."""
        return np.ceil(np.log2(np.maximum(self.before[symbol] - less, 0) + 1)).astype(np.int64)

    def log_ratio(self, pairs: np.ndarray, counts: np.ndarray, less: int = 0) -> np.ndarray:
        """What the symbol before says of the next one's probability, as a multiple of what the single token has, as a log10;
        ``less`` is how many of the counts are taken out."""
        one, next_ = pairs >> np.uint64(SYMBOL_BITS), pairs & np.uint64((1 << SYMBOL_BITS) - 1)
        with np.errstate(divide="ignore"):
            return np.log10(np.maximum(counts - less, 0) / np.maximum(self.before[one] - less, 1)) - self.log[next_]


def log_mixed(share: np.ndarray, log_ratio: np.ndarray) -> np.ndarray:
    """log10(1 - share + share * ratio)."""
    with np.errstate(divide="ignore"):
        return np.logaddexp2(np.log2(1 - share), np.log2(share) + log_ratio * np.log2(10)) / np.log2(10)


def followed(symbols: np.ndarray, ends: np.ndarray, first: np.ndarray, starts: np.ndarray, training: np.ndarray) -> np.ndarray:
    """For every word of some texts and the end of each: the symbol before, its own, the text's place and whether it is a
    training text, as one number; in the order of these numbers."""
    if len(ends) > 1 << (TEXT_BITS - 1):
        raise ValueError("too many texts in a batch")
    counts = np.diff(first)
    own = np.insert(symbols, first[1:], ends)
    row = np.repeat(np.arange(len(ends)), counts + 1)
    before = np.concatenate([[0], own[:-1]]).astype(np.uint64)
    before[first[:-1] + np.arange(len(ends))] = starts
    low = row.astype(np.uint64) << np.uint64(1) | training[row].astype(np.uint64)
    return np.sort((before << np.uint64(SYMBOL_BITS) | own.astype(np.uint64)) << np.uint64(TEXT_BITS) | low)


def packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers, by their differences."""
    steps = np.diff(numbers, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def dealt(numbers: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """The numbers by part, all those of a pair in the same one."""
    part = (mixed(numbers >> np.uint64(TEXT_BITS)) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for at in np.flatnonzero(np.diff(edges)).tolist():
        yield at, packed(numbers[order[edges[at] : edges[at + 1]]])


class Pairs:
    """All numbers of some parts, with how often each pair occurs in training texts."""

    def __init__(self, blocks: list[bytes]):
        numbers = [unpacked(b) for b in blocks]
        self.edges = np.concatenate([[0], np.cumsum([len(x) for x in numbers])]).astype(np.int64)
        self.numbers = np.concatenate([*numbers, np.empty(0, np.uint64)])
        del numbers
        ordered = self.numbers >> np.uint64(TEXT_BITS) << np.uint64(1) | self.numbers & np.uint64(1)
        ordered.sort()
        training = (ordered & np.uint64(1)).astype(np.int64)
        ordered >>= np.uint64(1)
        new = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]))
        self.pairs = ordered[new]
        self.counts = np.add.reduceat(training, new) if len(new) else training

    def learn(self, symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
        """The gates' weights after one online pass over the training texts' pairs, and the mass each gate has seen. A pair
        is taken out of the counts before it is predicted."""
        weights, mass = np.full(GATES, START), np.zeros(GATES)
        seen = np.flatnonzero(self.counts)
        # The keys of symbols are hashes, but pairs of the same first symbol stand together.
        seen = seen[np.argsort(mixed(self.pairs[seen]))]
        before = (self.pairs[seen] >> np.uint64(SYMBOL_BITS)).astype(np.int64)
        ratio, gate = symbols.log_ratio(self.pairs[seen], self.counts[seen], 1), symbols.gate(before, 1)
        for number, lo in enumerate(range(0, len(seen), PORTION)):
            own, g = ratio[lo : lo + PORTION], gate[lo : lo + PORTION]
            weight = self.counts[seen[lo : lo + PORTION]]
            share = 1 / (1 + np.exp(-weights))
            from_context = 1 / (1 + np.exp(-np.clip(weights[g] + own * np.log(10), -700, 700)))
            met = np.bincount(g, weight, GATES)
            step = np.bincount(g, weight * (from_context - share[g]), GATES) / np.maximum(np.maximum(met, mass / max(number, 1)), 1)
            weights = np.clip(weights + RATE * step / (share * (1 - share)), -9, 9)
            mass += met
        return weights, mass

    def gains(self, symbols: Symbols, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each block its texts' places and what these pairs add to the texts' log10 probabilities."""
        before = (self.pairs >> np.uint64(SYMBOL_BITS)).astype(np.int64)
        share = np.where(symbols.before[before] > 0, 1 / (1 + np.exp(-weights[symbols.gate(before)])), 0)
        gain = log_mixed(share, symbols.log_ratio(self.pairs, self.counts))
        for lo, hi in zip(self.edges[:-1], self.edges[1:], strict=True):
            own = self.numbers[lo:hi]
            row = ((own & np.uint64((1 << TEXT_BITS) - 1)) >> np.uint64(1)).astype(np.int64)
            rows = np.flatnonzero(np.bincount(row))
            yield rows, np.bincount(row, gain[np.searchsorted(self.pairs, own >> np.uint64(TEXT_BITS))])[rows]
