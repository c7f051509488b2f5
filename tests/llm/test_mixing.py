import random

import numpy as np
import pytest

from parlato.llm import mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in fixed)
        share = sum(weight[s] for s in names if s not in fixed)
        target = {s: 3.0 * sizes[s] if s in fixed else rest * weight[s] / share for s in names}
        over = {s for s in names if target[s] > 3 * sizes[s]} - fixed
        if not over:
            return target
        fixed |= over


def test_targets_and_copies(documents, monkeypatch):
    monkeypatch.setattr(mixing, "NODE_ROWS", 16)
    rng = random.Random(9)
    sources = ["b", "a", "é", "Z", None, "tiny"]
    rows = []
    for i in range(600):
        s = "a" if i % 3 == 0 else rng.choice(sources[:5])
        rows.append((i, " ".join("w" * rng.randrange(1, 80)) if i % 11 else None, None, s))
    rows += [(900, "one two", None, "tiny"), (901, " \n", None, "tiny"), (None, "a b c", None, "b"), (None, "a b c", None, "b")]
    made = [r.asDict() for r in mixing.copies(documents(rows)).collect()]
    assert len(made) == len(rows)
    sizes, largest = {}, {}
    for i, t, _, s in rows:
        n = len((t or "").split())
        sizes[s] = sizes.get(s, 0) + n
        largest[s] = max(largest.get(s, 0), n)
    targets = plain_targets(sizes)
    for r in made:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        low = int(targets[r["source"]] / sizes[r["source"]] + 1e-9)
        assert r["copies"] in (low, low + 1) and r["copies"] <= 3
    for s, target in targets.items():
        taken = sum(r["copies"] * r["size"] for r in made if r["source"] == s)
        assert abs(taken - target) <= largest[s]
    again = [r.asDict() for r in mixing.copies(documents(rows).repartition(7)).collect()]
    key = lambda r: (str(r["doc_id"]), r["h"], r["copies"])
    assert sorted(map(key, made)) == sorted(map(key, again))


def test_pivot_keeps_words_and_expectation():
    rng = np.random.default_rng(4)
    size = rng.integers(1, 200, 40).astype(float)
    p = np.full(40, 0.3)
    drawn = []
    for _ in range(3000):
        q, left = mixing.pivot(size, p, rng.random(40))
        whole = [k for k in range(40) if k != left]
        assert set(q[whole]) <= {0.0, 1.0}
        assert q @ size == pytest.approx(p @ size)
        drawn.append(q)
    assert np.abs(np.mean(drawn, axis=0) - 0.3).max() < 0.05


def test_edges(documents):
    assert mixing.copies(documents([])).collect() == []
    empty = mixing.copies(documents([(1, None, None, "a"), (2, "", None, None)])).collect()
    assert [r["copies"] * r["size"] for r in empty] == [0, 0]
    (one,) = mixing.copies(documents([(1, "a b", None, "s")])).collect()
    assert (one["copies"], one["target"]) == (1, 2.0)


def test_rows_repeat(documents):
    rows = [(i, "a b c d", None, "s" if i < 90 else "t") for i in range(100)] + [(None, "x", None, "t")] * 3
    docs = documents(rows)
    made, counts = mixing.mix_rows(docs), {}
    assert made.columns == docs.columns
    for r in made.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    expected = {}
    for r in mixing.copies(docs).collect():
        expected[r["doc_id"]] = expected.get(r["doc_id"], 0) + r["copies"]
    assert counts == {k: v for k, v in expected.items() if v}
