import math
import random

import numpy as np
import pytest

from parlato.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string"


def brute(rows, positives=5, negatives=10):
    kept = [
        (i, label, [math.floor(256.0 * float(np.float32(x))) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors: dict = {}
    for i, label, v in sorted(kept):
        if i % 100 == 0:
            anchors.setdefault(i, (label, v))
    out = []
    for q, (label, a) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(a, b, strict=True)), i, other) for i, other, b in kept if len(a) == len(b)]
        best = sorted((s, i) for s, i, other in scored if other == label and i != q)[:positives]
        for s, p in best:
            inside = [(t, i) for t, i, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(q, p, r + 1, i, -s, -t) for r, (t, i) in enumerate(sorted(inside)[:negatives])]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, hn.hard_negatives(df, "vec_id", "embedding", "label", lambda key: key % 100 == 0, **more).collect()))


def clustered(n, length, seed=1, centres=12, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, length))
    return (middle[rng.integers(0, centres, n)] + rng.normal(scale=spread, size=(n, length))).astype(np.float32)


def test_against_brute_force(spark, monkeypatch):
    for name, value in (("TREE_ROWS", 90), ("LEAF", 4), ("BLOCK_ANCHORS", 3), ("TILE", 20)):
        monkeypatch.setattr(hn, name, value)
    rng = random.Random(2)
    ids = [*range(0, 900, 3), *range(0, 1200, 100)]
    rows = [(i, [float(x) for x in v], rng.randint(0, 3)) for i, v in zip(dict.fromkeys(ids), clustered(len(set(ids)), 4), strict=True)]
    rows += [(2001, None, 1), (None, [1.0] * 4, 1), (2002, [1.0] * 4, None), (2003, [None, 1.0, 1.0, 1.0], 1), (2100, [math.nan] * 4, 1)]
    rows += [(2200, [math.inf] * 4, 1), (2300, [0.5], 1), (2301, [1.5], 1), (2302, [0.7], 2), (2400, [], 1), (2401, [], 2), (2500, [0.0] * 4, 1)]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 200


def test_ties_take_small_ids_and_one_common_vector(spark):
    rows = [(i, [1.0, 0.5], 1) for i in range(0, 400, 5)] + [(i, [0.5, 0.25], 2) for i in range(1, 400, 5)]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) == 4 * 5 * 10


def test_repeated_ids(spark):
    rows = [(100, [1.0], 1), (100, [2.0], 2), (1, [2.0], 1), (1, [2.0], 1), (2, [1.0], 2), (2, [1.0], 2)]
    # the anchor of the smaller label answers, and each repeated row is a candidate
    assert [r[:2] + r[3:] for r in run(spark, rows)] == [(100, 1, 2, 131072, 65536)] * 4


def test_large_values(spark):
    # 256e9 squared passes 64 bits: such rows take no part
    rows = [(0, [1e9, 1e9], 1), (100, [3e5, 1.0], 1), (1, [4e5, 1.0], 1), (2, [2e5, 1.0], 2), (3, [1e30, 0.0], 2)]
    got = run(spark, rows)
    assert [r[:4] for r in got] == [(100, 1, 1, 2)]
    assert got[0][4] == math.floor(256.0 * 3e5) * math.floor(256.0 * 4e5) + 256 * 256


def test_no_rows_and_no_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert run(spark, [(100, [1.0], 1)]) == []


def test_tree_covers_and_skips():
    vectors = np.floor(256 * clustered(6000, 8).astype(np.float64)).astype(np.int64)
    ids, labels = np.arange(len(vectors)), np.arange(len(vectors)) % 5
    tree = hn.CoverTree.over(ids, labels, vectors)
    assert sorted(tree.ids) == list(ids) and len(tree.parent) > 10
    squared = (tree.vectors**2).sum(axis=1)
    extra = np.sqrt(squared.max() - squared)
    points = np.column_stack([tree.vectors, extra])
    at = {i: k for k, i in enumerate(map(tuple, tree.vectors))}
    for node in range(len(tree.parent)):
        here = points[tree.first[node] : tree.last[node]]
        centre = points[at[tuple(tree.centre[node])]]
        assert np.sqrt(((here - centre) ** 2).sum(axis=1)).max() <= tree.radius[node] * (1 + 1e-9) + 1e-6
        for child in tree.children[node]:
            assert tree.first[node] <= tree.first[child] < tree.last[child] <= tree.last[node]
    again = hn.CoverTree.of(8, {c: tree.row().column(c)[0].as_py() for c in hn.PARTS})
    n, looked = 60, [0]
    ask = hn.Search(ids[:n], labels[:n], np.full((n, 1), hn.NONE + 1), np.full((n, 1), -hn.NONE), 5, True)
    look = ask.look

    def counting(asking, scores, *rest):
        looked[0] += scores.size
        look(asking, scores, *rest)

    ask.look = counting
    again.search(vectors[:n], ask)
    for q in range(n):
        every = sorted((-int(s), int(i)) for s, i in zip(vectors @ vectors[q], ids, strict=True) if i != q and labels[i] == labels[q])
        assert [(-s, i) for s, i in zip(ask.score[q, 0].tolist(), ask.found[q, 0].tolist(), strict=True)] == every[:5]
    # whole nodes are left out
    assert looked[0] < 0.4 * n * len(ids)


@pytest.mark.parametrize("score", [0, 7, 10, -7, 101])
def test_windows(score):
    low, high = hn._window(np.array([[score]]), 30, 90)
    fit = [t for t in range(-200, 200) if 30 * score <= 100 * t <= 90 * score]
    assert [t for t in range(-200, 200) if low[0, 0] <= t <= high[0, 0]] == fit
