"""Hard negatives against plain loops, the curve and the bounds against their definitions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfseek.llm import hard_negatives as h

SCHEMA = "vec_id bigint, label int, embedding array<float>, anchor string, score string"


def test_curve_steps_to_neighbours():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    places = h.hilbert_order(cells, 3)
    order = sorted(range(len(cells)), key=lambda k: places[k].tobytes())
    steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
    assert (steps == 1).all() and len({p.tobytes() for p in places}) == len(cells)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(-50, 50), min_size=3, max_size=3), min_size=1, max_size=8), st.lists(st.integers(-50, 50), min_size=3, max_size=3))
def test_bounds_hold_every_score(rows, anchor):
    block, one = np.array(rows), np.array([anchor])
    low, high = h.bounds(one, block.min(axis=0)[None], block.max(axis=0)[None])
    scores = block @ one[0]
    assert low[0, 0] <= scores.min() and scores.max() <= high[0, 0]


def test_products_are_exact_beyond_doubles():
    most = h.largest_number(64)
    big = np.full((1, 64), most, np.int32)
    assert h.products(big, big)[0, 0] == 64 * most * most < 1 << 62


def brute(rows, every, positives, negatives):
    rows = [
        (i, l, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, l, v in rows
        if None not in (i, l, v) and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, label, vector) in enumerate(rows):
        if anchor % every:
            continue
        scored = sorted((-sum(map(int.__mul__, vector, v)), i, k, l) for k, (i, l, v) in enumerate(rows) if k != a)
        for best, positive, _, _ in [s for s in scored if s[3] == label][:positives]:
            inside = [s for s in scored if s[3] != label and -30 * best <= -100 * s[0] <= -90 * best]
            out += [(anchor, positive, n + 1, s[1], -best, -s[0]) for n, s in enumerate(inside[:negatives])]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in h.hard_negatives(df, **options).collect())


@pytest.mark.parametrize("block_rows", [4, 256])
def test_as_plain_loops(spark, monkeypatch, block_rows):
    for name, value in {"BLOCK_ROWS": block_rows, "SLAB_BITS": 2, "GROUP_ANCHORS": 3, "MEETING_GROUPS": 2}.items():
        monkeypatch.setattr(h, name, value)
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), [rng.gauss(0.2, 0.4) for _ in range(6)]) for i in range(160)]
    # Ties, a hot vector, and rows that take no part.
    rows += [(200 + i, i % 2, rows[7][2]) for i in range(30)]
    rows += [(400, 1, None), (410, None, rows[0][2]), (None, 1, rows[0][2]), (420, 1, []), (430, 0, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    rows += [(440, 0, [float("nan")] * 6), (450, 0, [float("inf")] + [0.0] * 5), (460, 2, [0.0] * 6), (470, 5, rows[3][2])]
    rng.shuffle(rows)
    assert found(spark, rows, every=10, positives=3, negatives=4) == brute(rows, 10, 3, 4)


def test_vectors_of_a_rare_length_and_large_numbers(spark):
    rows = [(0, 1, [1e30, 1.0]), (1, 1, [1.0, 2.0]), (2, 0, [0.5, 0.5]), (3, 0, [1.0, 1.0, 1.0]), (4, 1, [-1e30, 3.0])]
    made = found(spark, rows)
    assert made == [] or all(r[3] != 3 for r in made)
    assert found(spark, [r for r in rows if r[0] != 3]) == made


def test_no_rows_and_no_anchors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, 0, [1.0, 0.0]), (3, 1, [1.0, 0.0])]) == []
    assert found(spark, [(100, 0, [1.0, 0.0])]) == []


def test_equal_rows_count_each(spark):
    rows = [(0, 0, [1.0, 0.0]), (5, 0, [1.0, 0.0]), (5, 0, [1.0, 0.0]), (7, 1, [0.5, 0.0]), (7, 1, [0.5, 0.0])]
    assert found(spark, rows) == sorted([(0, 5, n, 7, 65536, 32768) for n in (1, 2)] * 2)


def test_zones_leave_blocks_out(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK_ROWS", 16)
    rng = random.Random(1)
    rows = []
    for i in range(800):
        centre = i % 8
        rows.append((i, centre % 2, [2.0 * (k == centre) + rng.random() / 50 for k in range(8)]))
    kept, dims = h.usable(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA))
    blocks = h.blocks_of(kept, dims, 256)
    groups = h.anchor_groups(blocks, dims, 100, 5)
    best = h.positives_of(blocks, groups, dims, 5)
    asked = h.with_windows(groups, best, 30, 90)
    chosen = h.chosen_blocks(blocks, asked, dims, same_label=False)
    others = sum(blocks.filter(f"label <> {g.label}").count() for g in groups.select("label").collect())
    assert chosen.count() < others
