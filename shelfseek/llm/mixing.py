"""Logistic mixing of hashed-context bit predictors, in numpy: the model that ``lm_scoring`` trains and applies.

Text is a sequence of tokens, a token its bytes and a closing space, the end of a text one line break. A byte is coded
in binary decisions: five for a common byte, five and eight for any other. For each decision, predictors look up how
often it went either way after the last 1, 2, 4 and 6 bytes of the token (its beginning included) and after all of them.
Their log-odds are added up with weights that a gate chooses by how much the two longest contexts have been seen;
an adaptive map then corrects the mixed probability by what came true at such probabilities.

Counts are kept by context and next byte (``Contexts``), as many as the text has; the decisions' counts are sums of them.
Tables of a fixed size, indexed by a hash, serve vocabularies that fit them (``add_counts``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from shelfseek.llm.text_arrays import mixed, moved_to_zero, prefix_sums, text_bytes

CLOSE, END = 0x20, 0x0A
# The bytes coded in five decisions; the last code introduces all others.
COMMON = b"abcdefghijklmnopqrstuvwxyz .,\n\xc3"
ESCAPE = len(COMMON)
CODES = np.full(256, ESCAPE, np.int64)
CODES[np.frombuffer(COMMON, np.uint8)] = np.arange(ESCAPE)
DEPTH = 5

#: Bytes of a token that a predictor looks back on; 0 stands for all of them.
ORDERS = (1, 2, 4, 6, 0)
#: Predictors that also look at the text's class.
BY_CLASS = (False, True, True, True, True)
TABLE_BITS = (13, 18, 20, 21, 21)
OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in TABLE_BITS])])
SLOTS = int(OFFSETS[-1])
MULTIPLIERS = mixed(np.arange(1, 1 + len(ORDERS), dtype=np.uint64)) | np.uint64(1)
CLASSES = mixed(np.arange(1000, 1000 + 256, dtype=np.uint64))
NODES = mixed(np.arange(100, 100 + 512, dtype=np.uint64))
SPREAD = np.uint64(0xBF58476D1CE4E5B9)

#: Orders whose contexts are counted for the whole corpus. All of a token's bytes, if more than WHOLE_FROM - 1, are a
#: context of the tokens that begin so and of no others, so these are counted where those tokens are.
GRAMS = ORDERS[:-1]
WHOLE_FROM = max(ORDERS) + 1
# A byte as 13 bits, the decisions that code it: five, for the rare ones eight more. Contexts' hashes leave room for them.
PATH = DEPTH + 8
SYMBOLS = ((CODES << 8) | np.where(CODES == ESCAPE, np.arange(256), 0)).astype(np.uint64)
SYMBOL = np.uint64((1 << PATH) - 1)
#: By which decision two bytes part, from the exclusive or of their symbols; PATH if they are the same.
PARTING = np.array([PATH - x.bit_length() for x in range(1 << PATH)], np.int64)

#: A text's class is told before it, so it costs log10(N_CLASSES).
N_CLASSES = 16
PRIOR = 0.4
SEEN = 8
GATES = SEEN * SEEN
BINS = 24
LIMIT = 8.0
RATE = 0.3
#: Tokens handled at a time.
CHUNK = 1 << 13
#: Distinct beginnings of tokens handled at a time.
PORTION = 1 << 15


def joined(words: list[bytes] | pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens with what closes them, in one array, and where each begins."""
    column = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else pa.array(words, pa.binary())
    found, offsets = text_bytes(column)
    lengths = np.diff(offsets)
    end = np.zeros(len(lengths), bool)
    single = np.flatnonzero(lengths == 1)
    end[single] = found[offsets[single]] == END
    return np.insert(found, offsets[1:][~end], CLOSE), np.concatenate([[0], np.cumsum(lengths + ~end)])


def text_classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The class of each text, by its commonest two-byte beginning of a character beyond ASCII: 0 where fewer than one
    byte in 100 begins it, else one of N_CLASSES - 1. It mostly tells languages and scripts apart."""
    at = np.flatnonzero(data[:-1] >= 0xC0)
    row = np.searchsorted(offsets, at, side="right") - 1
    pair = data[at].astype(np.int64) << 8 | data[at + 1]
    keys, n = np.unique(row << 16 | pair, return_counts=True)
    order = np.lexsort((-n, keys >> 16))
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys >> 16, prepend=-1))
    row, pair, n = keys[first] >> 16, keys[first] & 0xFFFF, n[first]
    found = np.zeros(len(offsets) - 1, np.int64)
    clear = 100 * n >= np.diff(offsets)[row]
    spread = (mixed(pair.astype(np.uint64)) >> np.uint64(32)) % np.uint64(N_CLASSES - 1)
    found[row[clear]] = 1 + spread[clear].astype(np.int64)
    return found


@dataclass
class Decisions:
    """All binary decisions of some tokens: the token, the byte, the table slots, and how each went."""

    token: np.ndarray
    at: np.ndarray
    slots: np.ndarray
    bit: np.ndarray


def decisions(data: np.ndarray, first: np.ndarray, classes: np.ndarray) -> Decisions:
    n = len(data)
    lengths = np.diff(first)
    token = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(n) - first[:-1][token]
    history = np.zeros(n, np.uint64)
    for k in range(1, max(ORDERS) + 1):
        before = np.zeros(n, np.uint64)
        before[k:] = data[:-k]
        before[inside < k] = 0
        history |= before << np.uint64(8 * (k - 1))
    whole = prefix_hashes(data, first)
    text_class = CLASSES[classes][token]
    codes = CODES[data]
    depth = np.arange(DEPTH)
    node = ((1 << depth) | (codes[:, None] >> (DEPTH - depth))).reshape(-1)
    bit = ((codes[:, None] >> (DEPTH - 1 - depth)) & 1).reshape(-1)
    at = np.repeat(np.arange(n), DEPTH)
    rare = np.flatnonzero(codes == ESCAPE)
    if len(rare):
        depth = np.arange(8)
        value = data[rare].astype(np.int64)[:, None]
        node = np.concatenate([node, ((1 << DEPTH) + ((1 << depth) | (value >> (8 - depth)))).reshape(-1)])
        bit = np.concatenate([bit, ((value >> (7 - depth)) & 1).reshape(-1)])
        at = np.concatenate([at, np.repeat(rare, 8)])
    marks = NODES[node]
    slots = np.empty((len(ORDERS), len(node)), np.int32)
    with np.errstate(over="ignore"):
        for k, (order, bits) in enumerate(zip(ORDERS, TABLE_BITS, strict=True)):
            seen = history & np.uint64((1 << (8 * order)) - 1) if order else whole
            own = (seen + text_class if BY_CLASS[k] else seen) * MULTIPLIERS[k]
            z = own[at] + marks
            z ^= z >> np.uint64(31)
            z *= SPREAD
            slots[k] = (z >> np.uint64(64 - bits)).astype(np.int32) + np.int32(OFFSETS[k])
    return Decisions(token[at], at, slots, bit.astype(np.int8))


def prefix_hashes(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each byte, a hash of the token's bytes before it."""
    every = np.arange(len(data))
    sums, begins = prefix_sums(data, every, first[:-1])
    token = np.repeat(np.arange(len(first) - 1), np.diff(first))
    with np.errstate(over="ignore"):
        return mixed(moved_to_zero(sums - begins[token], first[:-1][token]))


def placed(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte its token, how many bytes of the token are before it, and a hash of these."""
    token = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return token, np.arange(len(data)) - first[:-1][token], prefix_hashes(data, first)


def whole_keys(whole: np.ndarray, classes: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Keys of all of a token's bytes so far, as hashed in ``whole``, with the next byte's symbol."""
    with np.errstate(over="ignore"):
        return mixed(whole + CLASSES[classes]) & ~SYMBOL | symbol


def context_keys(
    data: np.ndarray, first: np.ndarray, classes: np.ndarray, at: np.ndarray | None = None, places: tuple[np.ndarray, ...] | None = None
) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """For each byte, or those ``at`` some places, its token; by order, a hash of its context with its own symbol; and how
    many bytes of the token are before it."""
    places = places or placed(data, first)
    at = np.arange(len(data)) if at is None else at
    token, inside, whole = (x[at] for x in places)
    text_class = CLASSES[classes][token]
    symbol = SYMBOLS[data[at]]
    history = np.zeros(len(at), np.uint64)
    keys = []
    with np.errstate(over="ignore"):
        for k in range(1, max(ORDERS) + 1):
            before = np.where(inside < k, 0, data[np.maximum(at - k, 0)]).astype(np.uint64)
            history |= before << np.uint64(8 * (k - 1))
            if k in GRAMS:
                # Where the token's beginning is seen, it is part of the context.
                seen = mixed(history | np.minimum(inside, k + 1).astype(np.uint64) << np.uint64(56))
                own = mixed(seen + text_class) if BY_CLASS[ORDERS.index(k)] else seen
                keys.append(own & ~SYMBOL | symbol)
    keys.append(whole_keys(whole, classes[token], symbol))
    return token, keys, inside, symbol


class Beginnings:
    """Distinct beginnings of some tokens, each of which is coded the same way wherever it occurs: ``at`` is the place of the
    last byte of one occurrence, ``keys`` tell them apart, ``weights`` are the sums of their tokens' counts. They come in the
    order of their hashes."""

    def __init__(self, data: np.ndarray, first: np.ndarray, classes: np.ndarray, counts: np.ndarray):
        self.tokens = data, first, classes
        self.places = placed(data, first)
        token, self.inside, whole = self.places
        self.keys, self.at, self.place = np.unique(whole_keys(whole, classes[token], SYMBOLS[data]), return_index=True, return_inverse=True)
        self.weights = np.bincount(self.place, counts[token], len(self.keys))

    def whole(self) -> Contexts:
        """The counts of the contexts that are all of a token's bytes so far, if these are WHOLE_FROM and more."""
        long = self.inside[self.at] >= WHOLE_FROM
        return Contexts(self.keys[long], self.weights[long])

    def portions(self) -> Iterator[tuple[slice, np.ndarray]]:
        for lo in range(0, len(self.at), PORTION):
            yield slice(lo, lo + PORTION), self.at[lo : lo + PORTION]

    def by_token(self, values: np.ndarray) -> np.ndarray:
        """The sums of the values of each token's beginnings."""
        return np.bincount(self.places[0], values[self.place], len(self.tokens[1]) - 1)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, n, len(distinct))


class Contexts:
    """How often each byte came after each context, by sorted keys of context and symbol."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.n = keys[order], n[order].astype(np.float64)

    def counts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each distinct key and decision on the way to its symbol, how often it went as for this symbol and how often
        not; and for each key its place among the distinct ones."""
        asked, place = np.unique(keys, return_inverse=True)
        lo = np.searchsorted(self.keys, asked & ~SYMBOL)
        size = np.searchsorted(self.keys, asked | SYMBOL, side="right") - lo
        at = np.repeat(np.arange(len(asked)), size)
        entry = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        parting = PARTING[((self.keys[entry] ^ asked[at]) & SYMBOL).astype(np.int64)]
        parted = np.bincount(at * (PATH + 1) + parting, self.n[entry], len(asked) * (PATH + 1)).reshape(-1, PATH + 1)
        alike = parted[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:]
        return alike.astype(np.float32), parted[:, :PATH].astype(np.float32), place


def gram_counts(
    data: np.ndarray, first: np.ndarray, classes: np.ndarray, counts: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """By order of GRAMS, distinct keys of context and symbol and how often they occur, ``counts`` times in each token."""
    found = [([], []) for _ in GRAMS]
    for lo, hi, part, own in chunks(data, first):
        token, keys, _, _ = context_keys(part, own, classes[lo:hi])
        weight = counts[lo:hi][token]
        for (every, n), k in zip(found, keys[:-1], strict=True):
            k, w = summed(k, weight)
            every.append(k)
            n.append(w)
    empty = [np.empty(0, np.uint64)], [np.empty(0)]
    return [summed(np.concatenate(every or empty[0]), np.concatenate(n or empty[1])) for every, n in found]


def whole_contexts(data: np.ndarray, first: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> Contexts:
    """The contexts of WHOLE_FROM bytes and more that are all of a token's bytes so far."""
    every, n = [np.empty(0, np.uint64)], [np.empty(0)]
    for lo, hi, part, own in chunks(data, first):
        token, keys, inside, _ = context_keys(part, own, classes[lo:hi])
        long = inside >= WHOLE_FROM
        k, w = summed(keys[-1][long], counts[lo:hi][token[long]])
        every.append(k)
        n.append(w)
    return Contexts(*summed(np.concatenate(every), np.concatenate(n)))


def chunks(data: np.ndarray, first: np.ndarray):
    """Tokens in portions: at most CHUNK tokens and, but for one long token, about 16 bytes for each."""
    lo, n = 0, len(first) - 1
    while lo < n:
        most = int(np.searchsorted(first, first[lo] + 16 * CHUNK, side="right")) - 1
        hi = min(max(lo + 1, most), lo + CHUNK, n)
        yield lo, hi, data[first[lo] : first[hi]], first[lo : hi + 1] - first[lo]
        lo = hi


def seen_class(total: np.ndarray) -> np.ndarray:
    """How much a context has been seen: 0, then classes that each hold about five times as much."""
    return np.minimum(np.ceil(np.log2(total + 1) * 0.43), SEEN - 1).astype(np.int8)


def add_counts(
    zeros: np.ndarray, ones: np.ndarray, data: np.ndarray, first: np.ndarray, classes: np.ndarray, counts: np.ndarray
) -> None:
    """Adds how often each decision went either way, ``counts`` times for each token, to the tables."""
    for lo, hi, part, own in chunks(data, first):
        made = decisions(part, own, classes[lo:hi])
        weight = counts[lo:hi][made.token].astype(np.float32)
        went = made.bit == 1
        for slots in made.slots:
            np.add.at(ones, slots[went], weight[went])
            np.add.at(zeros, slots[~went], weight[~went])


def start_weights() -> np.ndarray:
    weights = np.zeros((GATES, len(ORDERS)))
    weights[:] = (0.05, 0.05, 0.1, 0.2, 0.6)
    # A long context that was never seen says nothing.
    weights[:SEEN] = (0.1, 0.15, 0.25, 0.5, 0.0)
    weights[0] = (0.1, 0.3, 0.6, 0.0, 0.0)
    return weights


@dataclass
class Counted:
    """All binary decisions of some bytes: which of them, how often each went either way, by predictor, and how it went."""

    byte: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    bit: np.ndarray


@dataclass
class Mixer:
    """Counts, gated weights and adaptive map. The counts are those of ``grams``, by order of GRAMS, and ``whole``, which
    must hold the tokens that are asked; else those of the tables ``zeros`` and ``ones``."""

    zeros: np.ndarray | None = None
    ones: np.ndarray | None = None
    weights: np.ndarray = field(default_factory=start_weights)
    refine: np.ndarray | None = None
    grams: list[Contexts] | None = None
    whole: Contexts | None = None

    def counted(
        self, data: np.ndarray, first: np.ndarray, classes: np.ndarray, at: np.ndarray | None = None, places: tuple[np.ndarray, ...] | None = None
    ) -> Counted:
        """The decisions of all bytes, or of those ``at`` some places."""
        at = np.arange(len(data)) if at is None else at
        if self.grams is None:
            made = decisions(data, first, classes)
            asked = np.full(len(data), -1)
            asked[at] = np.arange(len(at))
            own = np.flatnonzero(asked[made.at] >= 0)
            slots = made.slots[:, own]
            return Counted(asked[made.at[own]], self.zeros[slots], self.ones[slots], made.bit[own])
        _, keys, inside, symbol = context_keys(data, first, classes, at, places)
        rare = np.flatnonzero(CODES[data[at]] == ESCAPE)
        long = np.flatnonzero(inside >= WHOLE_FROM)
        bits = (symbol[:, None] >> np.arange(PATH - 1, -1, -1).astype(np.uint64)) & np.uint64(1)
        bit = np.concatenate([bits[:, :DEPTH].reshape(-1), bits[rare, DEPTH:].reshape(-1)]).astype(bool)
        zeros, ones = np.empty((len(ORDERS), len(bit)), np.float32), np.empty((len(ORDERS), len(bit)), np.float32)
        for k in range(len(ORDERS)):
            if k < len(GRAMS):
                alike, other, place = self.grams[k].counts(keys[k])
            else:
                # A short beginning is the whole context of the order before.
                more, less, own = self.whole.counts(keys[k][long])
                place[long] = own + len(alike)
                alike, other = np.concatenate([alike, more]), np.concatenate([other, less])
            same, opposite = (
                np.concatenate([t[:, :DEPTH][place].reshape(-1), t[:, DEPTH:][place[rare]].reshape(-1)]) for t in (alike, other)
            )
            zeros[k], ones[k] = np.where(bit, opposite, same), np.where(bit, same, opposite)
        return Counted(np.concatenate([np.repeat(np.arange(len(at)), DEPTH), np.repeat(rare, 8)]), zeros, ones, bit.astype(np.int8))

    def prepare(self) -> Mixer:
        """Weights for scoring."""
        self.flat_weights = [self.weights[:, k].astype(np.float32).copy() for k in range(len(ORDERS))]
        return self

    def learn(
        self, data: np.ndarray, first: np.ndarray, classes: np.ndarray, counts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """One online pass over counted tokens: corrects the weights after each portion, and returns the mass each gate
        has seen and, for each bin of the mixed probability, how often 0 and 1 came true."""
        return self.learn_beginnings(Beginnings(data, first, classes, counts))

    def learn_beginnings(self, tokens: Beginnings) -> tuple[np.ndarray, np.ndarray]:
        """The same over tokens whose distinct beginnings are known.

        A decision is taken out of the counts before it is predicted, so that a token does not vouch for itself. A portion
        that holds less than the usual mass of a gate corrects it less."""
        mass = np.zeros(GATES)
        came = np.zeros((2, SEEN, BINS))
        for number, (own, at) in enumerate(tokens.portions()):
            made = self.counted(*tokens.tokens, at, tokens.places)
            weight = tokens.weights[own][made.byte]
            zeros = np.maximum(made.zeros - (1 - made.bit), 0)
            ones = np.maximum(made.ones - made.bit, 0)
            odds = np.log((ones + PRIOR) / (zeros + PRIOR))
            seen = seen_class(zeros[-2:] + ones[-2:])
            gate = seen[1].astype(np.int64) * SEEN + seen[0]
            mixture = np.clip((self.weights[gate].T * odds).sum(axis=0), -LIMIT, LIMIT)
            error = (made.bit - 1 / (1 + np.exp(-mixture))) * weight
            share = np.bincount(gate, weight, GATES)
            for k in range(len(ORDERS)):
                step = np.bincount(gate, error * odds[k], GATES)
                self.weights[:, k] += RATE * step / np.maximum(np.maximum(share, mass / max(number, 1)), 1)
            mass += share
            bin_ = np.round((mixture + LIMIT) * ((BINS - 1) / (2 * LIMIT))).astype(np.int64)
            at = seen[1].astype(np.int64) * BINS + bin_
            for value in (0, 1):
                hit = made.bit == value
                came[value] += np.bincount(at[hit], weight[hit], SEEN * BINS).reshape(SEEN, BINS)
        return mass, came

    def log10(self, data: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The log10 probability of each token."""
        return self.log10_beginnings(Beginnings(data, first, classes, np.ones(len(classes))))

    def log10_beginnings(self, tokens: Beginnings) -> np.ndarray:
        """The same for tokens whose distinct beginnings are known."""
        found = np.empty(len(tokens.at))
        for own, at in tokens.portions():
            made = self.counted(*tokens.tokens, at, tokens.places)
            odds = np.log((made.ones + PRIOR) / (made.zeros + PRIOR)).astype(np.float32)
            seen = seen_class(made.zeros[-2:] + made.ones[-2:])
            high = seen[1]
            gate = high.astype(np.int16) * SEEN + seen[0]
            mixture = np.zeros(len(made.bit), np.float32)
            for k in range(len(ORDERS)):
                mixture += self.flat_weights[k][gate] * odds[k]
            np.clip(mixture, -LIMIT, LIMIT, out=mixture)
            p = 1 / (1 + np.exp(-mixture))
            if self.refine is not None:
                place = (mixture + np.float32(LIMIT)) * np.float32((BINS - 1) / (2 * LIMIT))
                below = np.minimum(place.astype(np.int16), BINS - 2)
                share = place - below
                cell = high.astype(np.int32) * BINS + below
                table = self.refine.reshape(-1)
                p = (p + table[cell] * (1 - share) + table[cell + 1] * share) / 2
            p = np.where(made.bit == 1, p, 1 - p)
            found[own] = np.bincount(made.byte, np.log10(p), len(at))
        return tokens.by_token(found)


def refinement(came: np.ndarray) -> np.ndarray:
    """Probabilities of 1 by how much the longest context was seen and the bin of the mixed probability."""
    middle = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, BINS)))
    prior = 20.0
    return ((came[1] + prior * middle) / (came[0] + came[1] + prior)).astype(np.float32)
