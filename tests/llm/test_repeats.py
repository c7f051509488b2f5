import random

from parlato.llm.repeats import remove_repeats


def brute(docs, size):
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            if key in seen:
                gone[p : p + size] = [True] * size
            seen.add(key)
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def run(docs, size=20, **given):
    return {r["doc_id"]: tuple(r)[1:] for r in remove_repeats(docs, size, **given).collect()}


def test_against_brute_force(documents):
    rng = random.Random(3)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for i in range(120):
        w = [rng.choice("abcdefgh") + rng.choice("é  xy") for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            w[5:5] = passage
        rows.append((i, rng.choice([" ", "\n", "\t\x0b", "  "]).join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a " * 3000), (204, rows[0][1]), (205, rows[0][1])]
    for size in (1, 4, 20):
        assert run(documents(rows), size, chunk_bytes=2000, shard_keys=500) == brute(rows, size)


def test_hot_copies(documents):
    rows = [(i, "same words in every one of these texts") for i in range(400)]
    assert run(documents(rows), 5, chunk_bytes=500, shard_keys=100) == brute(rows, 5)


def test_null_and_repeated_ids(documents):
    found = sorted(
        tuple(r) for r in remove_repeats(documents([(7, "a b c"), (7, "a b c"), (7, "b c"), (None, "a b"), (None, None)]), 2).collect()
        if r["doc_id"] is not None
    )
    # the rows of an id follow each other in the order of their texts
    assert found == [(7, 2, 2, ""), (7, 3, 0, "a b c"), (7, 3, 3, "")]


def test_no_rows(documents):
    assert run(documents([])) == {}
