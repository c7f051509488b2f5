import re
import unicodedata
from pathlib import PurePosixPath

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parlato.functions import text as X

EDGE = [
    "", None, " a ", "[a](b){c}<d>e", "a[b\nc]d", "(a [b) c] d)", "[[a]b]", "café x", "café",
    "한국어 test", "a\r\nb", "[a\rb]c", "x_y__z", " a　b\u0085c", "(((", "[a]]]", "<b>x</b>",
    "ॐ नमस्ते", "\U0001f600a\U0001f600", "ᬆஔ한", "a\x0bb\x1cc",
    "ࡰx", "Ciao CIAO", "İı", "[" * 50 + "]",
]


def expected(text):
    """The normaliser's contract in plain Python."""
    if text is None:
        return ""
    for opening, closing in ("[]", "()", "{}", "<>"):
        text = re.sub(re.escape(opening) + ".*?" + re.escape(closing), " ", text)
    text = re.sub(r"[^\w\s]|_", " ", text)
    marks = unicodedata.normalize("NFD", text)
    return " ".join("".join(c for c in marks if unicodedata.category(c) != "Mn").split())


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [row.out for row in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_normalize_edges(spark):
    assert apply(spark, X.normalize, EDGE) == [expected(text) for text in EDGE]


def test_normalize_every_code_point(spark):
    codes = [code for code in range(1, 0x110000) if not 0xD800 <= code < 0xE000]
    rows = [" ".join(f"a{chr(code)}b" for code in codes[i : i + 256]) for i in range(0, len(codes), 256)]
    assert apply(spark, X.normalize, rows) == [expected(row) for row in rows]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(max_size=60), min_size=40, max_size=80))
def test_normalize_any_text(spark, texts):
    texts = [text.replace("\0", "") for text in texts]
    assert apply(spark, X.normalize, texts) == [expected(text) for text in texts]


def test_normalize_lowercase_and_lists(spark):
    assert apply(spark, lambda c: X.normalize(c, lowercase=True), ["PerchÉ NO"]) == ["perche no"]
    lists = apply(spark, X.normalize_each, [["a-b", None, "È [x]"], []], "array<string>")
    assert lists == [["a b", "", "E"], []]


def test_strip_is_python_strip(spark):
    values = [f"{chr(c)}a {chr(c)}b{chr(c)}" for c in range(1, 0x3100) if chr(c).isspace()] + ["​a", "", " \n"]
    assert apply(spark, X.strip_ws, values) == [value.strip() for value in values]


def scored_words(text):
    return [word for word in re.sub(r"\s\s+", " ", text.strip()).split(" ") if word]


def test_words(spark):
    values = ["", " ", "a", " a  b ", "a\nb", "\na\n", "a \nb", "a\t\tb", " a ", "a\nb c\n\nd", "  ", "\n a"]
    assert apply(spark, X.words, values) == [scored_words(value) for value in values]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(alphabet=" \n\tab 　é", max_size=12), min_size=40, max_size=80))
def test_words_any_text(spark, texts):
    assert apply(spark, X.words, texts) == [scored_words(text) for text in texts]


def test_path_functions(spark):
    paths = ["/c/N/a.wav", "/c/N/a.b.wav", "/c.d/N/a", "/c/N/.wav", "c/N/x.WAV", "/c/la test/a.wav"]
    assert apply(spark, X.path_stem, paths) == [str(PurePosixPath(p).with_suffix("")) for p in paths]
    assert apply(spark, X.parent_name, paths) == [PurePosixPath(p).parent.name for p in paths]
    assert apply(spark, lambda c: X.without_suffix(c, ".wav"), ["a.wav", "a.wavx", ".wav", "a"]) == ["a", "a.wavx", "", "a"]
    assert apply(spark, lambda c: X.swap_suffix(c, ".wav", ".mp3"), ["a.wav", "b"]) == ["a.mp3", "b.mp3"]


def test_split_from_path(spark):
    paths = ["c/test/a.wav", "c/latest/a.wav", "c/x/contest.wav", "c/TEST/a.wav", "c/x/test.wav", "c/x/a.wav"]
    assert apply(spark, X.split_from_path, paths) == ["test"] * 5 + ["train"]
    by_segment = apply(spark, lambda c: X.split_from_path(c, "segment"), paths)
    assert by_segment == ["test", "train", "train", "test", "test", "train"]
    with pytest.raises(ValueError):
        X.split_from_path(F.col("v"), "other")


def test_transcript_line(spark):
    assert apply(spark, lambda c: X.transcript_line(c, F.lit("u1")), ["ciao bella"]) == ["ciao bella (u1)"]
