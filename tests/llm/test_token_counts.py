import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from parlato.llm import token_counts
from parlato.llm.bpe import vocabulary_path
from parlato.llm.common import slices

ODD = ["  ", "\n", " \n", " ", "\t", "'s", " 's", "aaaa", " aaa", "<|endoftext|>", "<|endof", "\x1c", "\xa0", " ", "日本語テキスト"]
ODD += ["՘", "\U0001df90", "é", "é", "123", " 45", "!!", "=====", "x" * 300, "🙂", "Ġ", "don't", "I'LL", "The quick", " fox."]


@pytest.fixture(scope="module")
def path():
    return vocabulary_path("byte_bpe_50k.json")


def expected(path, texts):
    return [len(e.ids) for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def texts(n, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_against_the_library(path):
    made = token_counts.Counter(path)
    found = [*texts(2000), None, "", " ", "<|endoftext|>"]
    assert made.count(found) == expected(path, found)
    # from kept runs
    assert made.count(found) == expected(path, found)


def test_small_strips_and_forgetting(path, monkeypatch):
    monkeypatch.setattr(token_counts, "STRIP", 7)
    monkeypatch.setattr(token_counts, "KEPT_RUNS", 5)
    made = token_counts.Counter(path)
    for seed in range(4):
        found = texts(50, seed)
        assert made.count(found) == expected(path, found)


def test_long_pre_token(path):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    assert token_counts.Counter(path).count([text, "a" * 50_000]) == expected(path, [text, "a" * 50_000])


def test_overlapping_pairs_merge_from_the_left():
    letters = {c: i for i, c in enumerate(token_counts.byte_letters())}
    merger = token_counts.Merger(letters | {"aa": 256, "aab": 257}, [("a", "a"), ("aa", "b")])
    assert merger.sizes([b"aaab", b"aab", b"aaaa", b"b", b"aaaaab"]).tolist() == [3, 1, 2, 1, 4]
    assert token_counts.Merger(letters, []).sizes([b"ab"]).tolist() == [2]


def test_every_letter_of_newer_databases(path):
    made = token_counts.Counter(path)
    found = ["a" + c + "1" for c in sorted(made.newer)[::7]]
    assert made.count(found) == expected(path, found)


def test_rows(spark, documents, path, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_ROWS", 3)
    rows = [(i, t) for i, t in enumerate(texts(40))] + [(None, "null id"), (7, "twice"), (7, "twice"), (50, None), (51, ""), (52, "wörd " * 2000)]
    df = documents(rows).withColumnRenamed("score", "n_tokens")
    made = token_counts.token_counts(df, "text", path, 100).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2])
    want = [(i, t, len((t or "").encode()), n, n > 100) for (i, t), n in zip(rows, expected(path, [t for _, t in rows]))]
    got = [(r["doc_id"], r["text"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in made]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert made[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_bytes", "n_tokens", "over_limit"}


def test_empty_table(documents, path):
    assert token_counts.token_counts(documents([]), "text", path).collect() == []


def test_slices():
    assert [(s.start, s.stop) for s in slices(np.array([], np.int64), 500, 10)] == []
    assert [(s.start, s.stop) for s in slices(np.array([1, 11, 2, 3]), 500, 10)] == [(0, 1), (1, 2), (2, 4)]
    assert [(s.start, s.stop) for s in slices(np.array([1, 1, 1]), 2, 10)] == [(0, 2), (2, 3)]
