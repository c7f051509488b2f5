import random
import tracemalloc

import pytest
from tokenizers import Tokenizer

from parlato.llm import bpe

PATH = bpe.vocabulary_path()


@pytest.fixture(scope="module")
def pair():
    return bpe.Encoder(PATH), Tokenizer.from_file(PATH)


def plain(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


def test_against_library(pair):
    encoder, library = pair
    rng = random.Random(1)
    low = [chr(c) for c in range(1, 0x250)]
    odd = [chr(rng.randrange(0x250, 0x3000)) for _ in range(2000)] + list("Σßİ́​ 　😀한\x1c\x85")
    for k in range(3000):
        pool = low if k % 2 else odd
        text = "".join(rng.choice(pool if rng.random() < 0.4 else "abcdeth'e INSTHE's've12!?.") for _ in range(rng.randrange(50)))
        if k % 9 == 0:
            text += "<|endoftext|>" + text[:4] + "<|startoftext|>"
        assert encoder.encode([text]) == [plain(library, text)], repr(text)


def test_every_low_character(pair):
    encoder, library = pair
    for c in range(1, 0x250):
        for text in (chr(c), f"a{chr(c)}b", f"1{chr(c)}'s {chr(c)}{chr(c)}"):
            assert encoder.encode([text]) == [plain(library, text)], repr(text)


def test_long_words(pair):
    encoder, library = pair
    for text in ("a" * 2000, "ab" * 500, "the" * 300, "!" * 777, "é" * 300):
        assert encoder.encode([text]) == [plain(library, text)]


def merged(word, merges):
    parts = [*word[:-1], word[-1] + "."]
    while True:
        ranks = [merges.index(pair) if pair in merges else len(merges) for pair in zip(parts, parts[1:])]
        if not ranks or min(ranks) == len(merges):
            return parts
        a, b = merges[min(ranks)]
        out = []
        for part in parts:
            if out and out[-1] == a and part == b and not done:
                out[-1], done = a + b, True
            else:
                out.append(part)
                done = False
        parts = out


def test_automaton_of_random_merges():
    rng = random.Random(6)
    for _ in range(40):
        tokens, merges = ["a", "b", "a.", "b."], []
        while len(merges) < 8:
            a, b = rng.choice([t for t in tokens if t[-1] != "."]), rng.choice(tokens)
            if a + b not in tokens:
                tokens.append(a + b)
                merges.append((a, b))
        made = bpe.Automaton({t: i for i, t in enumerate(tokens)}, merges, ".")
        for _ in range(60):
            word = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 12)))
            assert [made.tokens[i] for i in made.encode(word)] == merged(word, merges), (word, merges)
            assert bpe.Tables(made, bpe.byte_letters()).encode([word.encode()]) == [made.encode(word)]
    with pytest.raises(ValueError):
        made.encode("c")
    with pytest.raises(ValueError):
        bpe.Tables(made, bpe.byte_letters()).encode([b"c"])


def test_kept_results_are_bounded():
    held = bpe.Kept(2)
    for k in "abcabcd":
        assert held.known([k, "z"]) in ({}, {k: (k,)})
        held.keep({k: (k,)})
    assert len(held.young) <= 2 and len(held.old) <= 2 and held.known("d") == {"d": ("d",)}


def test_texts_together(pair, monkeypatch):
    library = pair[1]
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    encoder = bpe.Encoder(PATH)
    texts = ["Ein Text", None, "", "ein text's", "<|endoftext|> a<|endoftext|>", "12 x 3", "ſ İ é", "it's 0n\x7f", "a_b\x01c"]
    for _ in range(3):
        assert encoder.encode(texts) == [plain(library, t or "") for t in texts]


def test_tables_and_automaton_agree(pair):
    encoder = pair[0]
    rng = random.Random(8)
    words = [bytes(rng.choice(b"abcdethingsrou0123!?.\xc3\xa9\xff\x00") for _ in range(rng.randrange(1, 48))) for _ in range(3000)]
    scalar = [encoder.automaton.encode("".join(encoder.letters[b] for b in w)) for w in words]
    assert encoder.tables.encode(words) == scalar
    assert encoder.tables.encode([]) == []


def test_words_are_walked_in_strips(pair):
    encoder = pair[0]
    words = [b"%037d" % (k % 500) for k in range(60_000)]
    tracemalloc.start()
    found = encoder._words(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 500 and peak < 40 << 20


def test_frame(documents, pair):
    texts = ["Ein Text", None, "", " \n", "x" * 5000, "Ein Text", "<|endoftext|>"]
    docs = documents(list(enumerate(texts))).withColumnRenamed("score", "ids")
    rows = {r["doc_id"]: (r["n_tokens"], r["ids"], r["decoded"]) for r in bpe.encoded(docs, "text", PATH).collect()}
    assert rows == {i: plain(pair[1], t or "") for i, t in enumerate(texts)}
    assert bpe.encoded(documents([]), "text", PATH).collect() == []
