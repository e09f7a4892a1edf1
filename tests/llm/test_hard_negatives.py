"""Hard negatives against brute force: ties, copies, odd vectors, windows that are empty, and the tree's bounds."""

import math

import numpy as np
import pytest
from acceptance import compare as comparing

from pollstone.llm import hard_negatives
from pollstone.llm.queries import ORACLES, QUERIES

SHAPE = "vec_id long, label int, embedding array<double>, anchor string, block int, tree int, v int"


def by_hand(rows, step=100, positives=5, negatives=10):
    known = set()
    for vec_id, label, vector in rows:
        if vec_id is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            known.add((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    out = set()
    for a, label, v in known:
        if a % step:
            continue
        scored = {(-sum(x * y for x, y in zip(v, w, strict=False)), b, other) for b, other, w in known if b != a}
        best = sorted({(s, b) for s, b, other in scored if other == label})[:positives]
        for s, b in best:
            fit = sorted({(t, c) for t, c, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s})[:negatives]
            out |= {(a, b, k + 1, c, -s, -t) for k, (t, c) in enumerate(fit)}
    return sorted(out)


def mined(spark, rows, **options):
    table = spark.createDataFrame([(*row, "clash", 1, 2, 3) for row in rows], SHAPE)
    return sorted(tuple(r) for r in hard_negatives.mine(table, table.where("vec_id % 100 = 0"), **options).collect())


def drawn(seed, count, dims=6):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(4, dims))
    return [(int(k), int(draw.integers(0, 3)), (middle[k % 4] + 0.4 * draw.normal(size=dims)).round(2).tolist()) for k in range(count)]


@pytest.mark.parametrize("seed, anchors, block", [(1, 512, 8192), (2, 2, 50)])
def test_against_brute_force(spark, monkeypatch, seed, anchors, block):
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows = drawn(seed, 700)
    rows += rows[:50] + [(k + 1000, label, v) for k, label, v in rows[:120]]
    rows += [(2000, 1, None), (2100, None, [1.0] * 6), (None, 1, [1.0] * 6), (2200, 1, [math.nan] * 6), (2300, 1, [math.inf] * 6), (2400, 1, [None] * 6)]
    rows += [(2500, 1, [0.0] * 6), (2600, 2, []), (2700, 0, [1.0, 2.0]), (300, 2, [0.5] * 6), (2800, 9, [1.0] * 6)]
    found = mined(spark, rows)
    assert found == by_hand(rows) and {row[0] for row in found} > {0, 100, 300, 1000}


def test_few_rows_and_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0])]) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])]) == []
    some = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 0, [0.5]), (3, 0, [1.0]), (100, 1, [-1.0]), (4, 0, [0.5])]
    assert mined(spark, some) == by_hand(some) == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 4, 65536, 32768)]
    assert mined(spark, some + [(5, 0, [1e300])]) == by_hand(some)


def test_tree_is_minimal_and_bounds_hold():
    draw = np.random.default_rng(3)
    points = np.concatenate([draw.integers(-200, 200, (30, 5)), draw.integers(-200, 200, (1, 5)) + draw.integers(-3, 4, (30, 5))])
    order, parent = hard_negatives.spanning_tree(points)
    place = np.argsort(order)
    assert sorted(order) == list(range(len(points))) and (parent < 0).sum() == 1
    assert all(place[parent[k]] < place[k] for k in range(len(points)) if parent[k] >= 0)
    square = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    edges = sorted((square[i, j], i, j) for i in range(len(points)) for j in range(i))
    group, least = list(range(len(points))), 0.0
    for weight, i, j in edges:
        if group[i] != group[j]:
            group = [group[i] if g == group[j] else g for g in group]
            least += weight
    assert sum(square[k, parent[k]] for k in range(len(points)) if parent[k] >= 0) == least
    rows = draw.integers(-200, 200, (500, 5))
    windows = [(20_000, 30_000)] * 60 + [(1, 0)]
    work = 0
    for k, meets, score, rescored in hard_negatives.tree_scores(points, order, parent, windows, rows):
        exact = rows @ points[k]
        assert (exact[meets] == score).all()
        assert set(np.flatnonzero((exact >= windows[k][0]) & (exact <= windows[k][1]))) <= set(meets.tolist())
        work += rescored
    assert work < 0.9 * len(points) * len(rows)


@pytest.mark.parametrize("name", ["op13_hard_negatives"])
def test_query_matches_sql(spark, folder, monkeypatch, name):
    monkeypatch.setattr(comparing, "queries", lambda: QUERIES)
    assert comparing.compare(spark, comparing.connect(folder), folder, name, ORACLES[name]) == []
