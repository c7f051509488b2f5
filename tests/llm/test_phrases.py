import random
import re
from collections import Counter

import numpy as np

from parlato.llm import phrases

WORDS = ["the", "The", "of", "a\x0bb", "été", "École", "x\x1cy", "new", "york", "city", "|", "-", "a\xa0b"]
GLUE = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0c", "! ?"]


def brute(rows, least, percent, top):
    count: dict = {}
    for text, lang in rows:
        found = count.setdefault("und" if lang is None else lang, Counter())
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for size in (1, 2, 3):
                found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in count.items():
        n = sum(v for g, v in f.items() if len(g) == 1)
        listed = []
        for g, a in f.items():
            if len(g) < 2 or a < least:
                continue
            longer = [v for h, v in f.items() if len(h) > len(g) and v >= least and g in (h[:2], h[1:])]
            if any(100 * v >= percent * a for v in longer):
                continue
            cuts = [(1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            listed.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, r, p.decode(), -a, l, q, n, -s) for r, (s, a, p, l, q) in enumerate(sorted(listed)[:top], 1)]
    return sorted(out)


def texts(n, seed=2):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        words = rng.choices(WORDS, weights=range(len(WORDS), 0, -1), k=rng.randint(0, 60))
        made.append(("".join(w + rng.choice(GLUE) for w in words), rng.choice(["en", "en", "en", "it", None, "und"])))
    return made


def run(documents, rows, **more):
    df = documents([(i, *row) for i, row in enumerate(rows)]).withColumnRenamed("score", "phrase").repartition(5)
    return sorted(map(tuple, phrases.collocations(df, **more).collect()))


def test_against_brute_force(documents):
    rows = [*texts(150), (None, "en"), ("", None), ("new york city " * 30, "de"), ("word " * 3000, "fr")]
    assert run(documents, rows) == brute(rows, 10, 50, 2000)


def test_small_chunks_tiles_and_lists(documents, monkeypatch):
    # workers take the module's values from here: chunks of a few texts, tiles of two ids a side
    for name, value in (("CHUNK_BYTES", 700), ("HELD_BYTES", 1000), ("BITS", 1), ("DENSE", 4), ("STRIP", 50)):
        monkeypatch.setattr(phrases, name, value)
    rows = texts(120, 7)
    assert run(documents, rows, least=3, percent=80, top=9) == brute(rows, 3, 80, 9)


def test_nothing_frequent_and_no_rows(documents):
    assert run(documents, [("one two three", "en")]) == []
    assert run(documents, []) == []


def test_tiles_count_pairs():
    rng = np.random.default_rng(1)
    for bits, dense in ((10, 1 << 16), (2, 5), (3, 1)):
        phrases.BITS, phrases.DENSE = bits, dense
        try:
            tiles, want = phrases.Tiles(), Counter()
            for _ in range(3):
                left, right = rng.integers(0, 40, (2, 500)) * rng.choice([1, 1000, (1 << 31) // 40 - 1], 500)
                tiles.add(left, right)
                want.update(zip(left.tolist(), right.tolist(), strict=True))
            keys, n = tiles.counts()
            assert dict(zip(zip((keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist(), strict=True), n.tolist(), strict=True)) == want
        finally:
            phrases.BITS, phrases.DENSE = 10, 1 << 16
    assert [len(x) for x in phrases.Tiles().counts()] == [0, 0]


def test_scores_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_000, 4_000_000_000_001, 5_000_000_000_003
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(phrases._score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (left * right)
