import random
from collections import Counter

import numpy as np

from shelfseek.llm import following, lm_scoring, mixing
from tables import sentence


def test_scores_follow_the_order_of_words(spark):
    """The same words in another order have the same base score and another score, the better the more of the pairs occur
    in training texts."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[(k + i) % 40] for k in range(60))) for i in range(300)]
    spoilt = [list(rows[0][1].split()) for _ in range(20)]
    for own in spoilt:
        rng.shuffle(own)
    rows += [(1000 + i, " ".join(own)) for i, own in enumerate(spoilt)] + [(2000, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in lm_scoring.score_texts(docs).collect()}
    for i in range(20):
        assert np.isclose(found[1000 + i].base_score, found[2000].base_score)
        assert found[2000].score > found[1000 + i].score + 1
    held = [r for r in found.values() if r.held_out and r.doc_id < 1000]
    assert len(held) > 10 and all(r.score > r.base_score for r in held)


def symbols_of(rng, count=30):
    log = np.log10(rng.dirichlet(np.ones(count)) * 0.9)
    n = rng.integers(1, 50, count)
    is_end = np.arange(count) == 3
    every, texts = np.zeros(mixing.N_CLASSES), np.zeros(mixing.N_CLASSES)
    every[0], texts[0] = n.sum() + 7, n[3]
    return following.Symbols(np.arange(count, dtype=np.uint64), np.zeros(count, np.int64), n, log, is_end, every, texts)


def test_pairs_are_counted_exactly():
    """Over any number of parts, each pair of a text is counted once, those of training texts for the model."""
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 9, rng.integers(0, 30)) for _ in range(200)]
    training = rng.random(200) < 0.7
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    numbers = following.followed(np.concatenate(texts), np.full(200, 9), first, np.full(200, 10), training)
    expected, every = Counter(), Counter()
    for own, learned in zip(texts, training, strict=True):
        run = [10, *own.tolist(), 9]
        every.update(zip(run, run[1:]))
        if learned:
            expected.update(zip(run, run[1:]))
    for parts in (1, 7, 70_000):
        held = {}
        for part, data in following.dealt(numbers, parts):
            held.setdefault(part, []).append(data)
        got, n = Counter(), 0
        for blocks in held.values():
            pairs = following.Pairs(blocks)
            n += len(pairs.numbers)
            for pair, count in zip(pairs.pairs.tolist(), pairs.counts.tolist(), strict=True):
                assert (pair >> following.SYMBOL_BITS, pair & ((1 << following.SYMBOL_BITS) - 1)) not in got
                got[pair >> following.SYMBOL_BITS, pair & ((1 << following.SYMBOL_BITS) - 1)] += int(count)
        assert +got == expected and n == every.total()


def test_probabilities_after_a_token_add_up():
    """Whatever the weights, the symbols' probabilities after any symbol sum to one."""
    rng = np.random.default_rng(3)
    symbols = symbols_of(rng)
    nexts = np.arange(symbols.rest + 1)
    for before in [0, 5, symbols.rest, symbols.start]:
        counts = rng.multinomial(int(symbols.before[before]), np.ones(len(nexts)) / len(nexts))
        pairs = (np.uint64(before) << np.uint64(following.SYMBOL_BITS)) | nexts.astype(np.uint64)
        ratio = symbols.log_ratio(pairs, counts)
        for share in (0.0, 0.3, 0.9):
            logs = symbols.log[nexts] + following.log_mixed(np.full(len(nexts), share), ratio)
            assert np.isclose((10**logs).sum(), 1)


def test_gains_are_those_of_the_pairs():
    """Texts get back the sum over their own pairs, however the pairs are dealt."""
    rng = np.random.default_rng(4)
    symbols = symbols_of(rng)
    texts = [rng.integers(0, 3, rng.integers(0, 12)) for _ in range(50)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    numbers = following.followed(np.concatenate(texts), np.full(50, 3), first, np.full(50, symbols.start), np.ones(50, bool))
    counts = Counter()
    for own in texts:
        run = [symbols.start, *own.tolist(), 3]
        counts.update(zip(run, run[1:]))
    weights = np.linspace(-2, 1, following.GATES)
    expected = np.zeros(50)
    for i, own in enumerate(texts):
        run = [symbols.start, *own.tolist(), 3]
        for one, other in zip(run, run[1:]):
            share = 1 / (1 + np.exp(-weights[int(np.ceil(np.log2(symbols.before[one] + 1)))]))
            expected[i] += np.log10(1 - share + share * counts[one, other] / symbols.before[one] / 10 ** symbols.log[other])
    for parts in (1, 5):
        got = np.zeros(50)
        for _, data in following.dealt(numbers, parts):
            for rows, gain in following.Pairs([data]).gains(symbols, weights):
                got[rows] += gain
        assert np.allclose(got, expected)


def test_pairs_that_say_nothing_get_little_weight():
    """Words drawn evenly: the weights learned for the token before cost less than three percent of the score."""
    rng = random.Random(6)
    words = sorted(set(" ".join(sentence(rng, 400) for _ in range(4)).split()))
    place = {w: i for i, w in enumerate(words)}
    count = len(words) + 1
    texts = [np.array([place[w] for w in rng.choices(words, k=60)]) for _ in range(300)]
    first = np.arange(301) * 60
    numbers = following.followed(np.concatenate(texts), np.full(300, count - 1), first, np.full(300, count + mixing.N_CLASSES), np.ones(300, bool))
    n = np.bincount(np.concatenate(texts), minlength=count)
    n[-1] = 300
    every, ends = np.zeros(mixing.N_CLASSES), np.zeros(mixing.N_CLASSES)
    every[0], ends[0] = n.sum(), 300
    log = np.log10((n + 0.1) / (n.sum() + 0.1 * count + 1))
    symbols = following.Symbols(np.arange(count, dtype=np.uint64), np.zeros(count, np.int64), n, log, np.arange(count) == count - 1, every, ends)
    pairs = following.Pairs([data for _, data in following.dealt(numbers, 1)])
    weights, mass = pairs.learn(symbols)
    total = sum(gain.sum() for _, gain in pairs.gains(symbols, weights))
    assert mass.sum() > 1000 and total > 0.03 * (n * log).sum()
