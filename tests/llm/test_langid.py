import zlib

from parlato.llm import langid

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    given = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = langid.op9_language_id(spark, FOLDER).collect()
    assert len(rows) == len(given)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    tested = [r for r in rows if r["held_out"]]
    assert sum(given[r["doc_id"]] == r["lang_pred"] for r in tested) >= 0.98 * len(tested)


def test_plain_counts(documents):
    rows = [(1, "ab ba", "x"), (2, "ab", "x"), (3, "zz", "y"), (4, None, "y"), (5, "12", "y"), (6, "zz", None)]
    model = langid.learn(documents(rows).selectExpr("text", "lang as label"))
    assert model.labels == ["x", "y"] and abs(float(model.prior[0]) - -0.4055) < 1e-3
    letters = langid.letter_table()
    assert model.predict("abab", letters)[0] == "x" and model.predict("Z", letters)[0] == "y"
    for nothing in (None, "", "12 !?", "́"):
        assert model.predict(nothing, letters) == ("und", 0.0)
    assert model.predict("\U00010400\U00010401", letters)[0] in ("x", "y")


def test_grams_see_whole_texts():
    letters = langid.letter_table()
    assert len(langid.grams("ab" * 40_000, letters)) > 200_000
    assert (langid.grams("A-b", letters) == langid.grams("a  b", letters)).all()


def test_frames(documents):
    docs = documents([(1, "abc", "x"), (2, "xyz", "y"), (3, "...", "y"), (4, None, "x"), (5, "abc", None)])
    kept = langid.in_known_language(docs, "text", "lang")
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["lang"]) for r in kept.collect()} == {(1, "x"), (2, "y"), (5, "x")}
    assert langid.in_known_language(documents([]), "text", "lang").collect() == []
    # nothing to learn from
    assert langid.in_known_language(documents([(1, "abc")]), "text", "lang").collect() == []


def test_texts_are_judged_once(documents):
    docs = documents([(1, "abc", "x"), (2, "xyz", "y")])
    plan = langid.in_known_language(docs, "text", "lang")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
