import math
import random

from parlato.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k):
    kept = [
        (i, [math.floor(64.0 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in kept:
        if q % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in kept if i != q and len(a) == len(b)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def run(spark, rows, k):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, topk.top_k(df, "vec_id", "embedding", lambda key: key % 20 == 0, k).collect()))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.3, 1.5]) for _ in range(4)]) for i in range(150)]
    rows += [(160, [0.1]), (161, [0.2]), (180, []), (181, []), (None, [1.0] * 4), (182, None)]
    rows += [(183, [None, 1.0, 1.0, 1.0]), (184, [math.nan] * 4), (200, [math.inf] * 4), (220, [0.0] * 4)]
    assert run(spark, rows, 7) == brute(rows, 7)


def test_ties_take_small_ids(spark):
    rows = [(i, [1.0, 1.0]) for i in range(100)]
    assert run(spark, rows, 20) == brute(rows, 20)


def test_large_values(spark):
    rows = [(0, [3e5, -2e5]), (1, [4e5, 1.5]), (2, [-9e5, 7.0]), (20, [1e6, 1e6])]
    assert run(spark, rows, 2) == brute(rows, 2)


def test_no_rows_and_no_queries(spark):
    assert run(spark, [], 3) == []
    assert run(spark, [(1, [1.0])], 3) == []
    assert run(spark, [(20, [1.0])], 3) == []


def test_repeated_ids(spark):
    rows = [(20, [1.0]), (1, [2.0]), (1, [2.0]), (20, [3.0])]
    # the query of the smaller values answers, each repeated row is a candidate
    assert run(spark, rows, 5) == [(20, 1, 1, 64 * 128), (20, 2, 1, 64 * 128)]
