import hashlib
import random

import numpy as np

from parlato.llm import fingerprints as fp


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha1((r[1] or "").encode()).hexdigest()))
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, nxt = fp.signatures([text, edited, after])
        out.append((i, len(text), edited, fp.fingerprint_text(own), fp.fingerprint_text(other), (own == other).mean(), (own == nxt).mean()))
    return sorted(out, key=str)


def test_ranges_against_brute_force(documents):
    rng = random.Random(1)
    rows = [(i * 7 - 100, " ".join(rng.choice(["aé", "b", "😀c", "d"]) for _ in range(rng.randrange(40)))) for i in range(90)]
    rows += [(10**18, None), (-(10**18), ""), (None, "no id at all"), (3, "x" * 30_000), (12345, rows[0][1])]
    for size in (8, 1000):
        made = [tuple(r) for r in fp.compare_with_next(documents(rows), size).collect()]
        assert sorted(made, key=str) == brute(rows)


def test_edges(documents):
    assert fp.compare_with_next(documents([])).collect() == []
    (alone,) = fp.compare_with_next(documents([(1, "a b c d e f")])).collect()
    assert alone["near_next"] == 1.0 and alone["edited"] == "a b c a b c"[:11]
    twice = fp.compare_with_next(documents([(1, "same text"), (1, "same text")])).collect()
    assert len(twice) == 2 and twice[0]["fingerprint"] == twice[1]["fingerprint"]


def test_likeness_estimates_jaccard():
    words = [f"w{k}" for k in range(400)]
    a, b = " ".join(words), " ".join(words[:300] + [f"v{k}" for k in range(100)])
    x, y = fp.signatures([a, b], 512)
    assert abs(float((x == y).mean()) - 296 / 496) < 0.08
    assert (fp.signatures(["", None, " \n"]) == 0xFFFFFFFF).all()
    assert (fp.signatures(["a b"]) == fp.signatures([" a\tb "])).all()
    many = ["word " * 9, *[" ".join(words)] * 300]
    assert (fp.signatures(many)[1:] == fp.signatures([" ".join(words)])[0]).all()


def test_near_pairs(documents):
    rng = np.random.default_rng(2)
    base = [" ".join(rng.choice(list("abcdefghij"), 200)) for _ in range(4)]
    rows = [(i, t) for i, t in enumerate(base)] + [(10 + i, t + " and more") for i, t in enumerate(base)] + [(20, base[0]), (21, None), (22, "")]
    found = {(r["left"], r["right"]) for r in fp.near_pairs(documents(rows), "doc_id", "text").collect()}
    assert found == {(i, 10 + i) for i in range(4)}
