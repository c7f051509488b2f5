import random
from collections import Counter

import corpus_pipeline
from parlato.llm import bpe, secret_scan
from test_neardup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def make(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_and_result(spark, tmp_path):
    rng = random.Random(7)
    words = {"en": ["the", "and", "house", "water", "with"], "de": ["der", "und", "haus", "wasser", "mit"]}
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "de"])
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "en"]) for _ in range(rng.randrange(20, 60)))
        rows.append((i, text, lang, rng.choice(["s1", "s2", None]), len(text)))
    rows += [(200 + k, rows[k][1], "en", "s1", 0) for k in range(10)]
    rows += [(300, None, "en", "s1", None), (301, "123 !!", "en", "s1", 6), (302, "", None, "s1", 0)]
    rows += [(303, 'the house token = "abcdefghijklmnopqrst" and the water', None, "s2", 1)]
    folder = make(spark, tmp_path, rows)
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        seen[name] = [r.asDict() for r in docs.collect()]
        if name != "bpe_encoding":
            assert docs.columns == COLUMNS
    ids = {name: Counter(r["doc_id"] for r in found) for name, found in seen.items()}
    assert set(ids["language_id"]) == {r[0] for r in rows} - {300, 301, 302}
    classes = brute([(r["doc_id"], r["text"]) for r in seen["language_id"]])
    assert set(ids["near_dedup"]) == set(classes.values())
    secret = next(r for r in seen["secret_scans"] if r["doc_id"] == 303)
    assert secret["text"] == 'the house [secret]" and the water' and secret["n_chars"] == len(secret["text"]) and secret["lang"] == "en"
    assert set(ids["secret_scans"]) == set(ids["near_dedup"])
    assert max(ids["mix_sources"].values()) <= 3
    encoder = bpe.Encoder(bpe.vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in seen["secret_scans"]}
    assert ids["bpe_encoding"] == ids["mix_sources"]
    for r in seen["bpe_encoding"]:
        assert (r["n_tokens"], r["ids"], r["decoded"]) == encoder.encode([texts[r["doc_id"]]])[0]
    key = lambda r: (r["doc_id"], r["ids"])
    again = [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(map(key, again)) == sorted(map(key, seen["bpe_encoding"]))
    assert secret_scan.KINDS[-1] == "model"


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, make(spark, tmp_path, [])).collect() == []
