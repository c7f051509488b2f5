import random

import pytest
from pyspark.sql import functions as F

from parlato.functions.edits import SHORT_PAIR_WORDS, bit_parallel_distance, word_edit_distance
from parlato.operators.scoring import pair_edits, score


def by_table(left, right):
    """Textbook dynamic program."""
    row = list(range(len(right) + 1))
    for i, a in enumerate(left, 1):
        corner, row[0] = row[0], i
        for j, b in enumerate(right, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (a != b))
    return row[-1]


def random_pairs(count, lengths, seed=3):
    rng = random.Random(seed)
    words = ["a", "é", "casa", "日", "x", "Casa"] + [f"w{i}" for i in range(200)]

    def text():
        used = words[: rng.choice([2, 6, 206])]
        return " ".join(rng.choice(used) for _ in range(rng.choice(lengths)))

    return [(text(), text()) for _ in range(count)]


def test_distance_on_short_and_long_pairs(spark):
    pairs = random_pairs(200, [0, 1, 2, 7, 30, 90, SHORT_PAIR_WORDS // 2, SHORT_PAIR_WORDS, 400])
    df = spark.createDataFrame(pairs, "r string, h string")
    rows = df.select("r", "h", word_edit_distance(F.col("r"), F.col("h")).alias("d")).collect()
    assert [row.d for row in rows] == [by_table(row.r.split(), row.h.split()) for row in rows]


def test_bit_parallel_distance():
    for left, right in random_pairs(300, [0, 1, 5, 63, 64, 65, 130], seed=5):
        assert bit_parallel_distance(left.split(), right.split()) == by_table(left.split(), right.split())


def one(spark, rows, **options):
    return score(spark.createDataFrame(rows, "ref string, hyp string"), **options).collect()[0]


@pytest.mark.parametrize(
    "ref, hyp, wer",
    [("a b c", "a b c", 0.0), ("a b c", "a x c", 1 / 3), ("a", "a b c", 2.0), ("Ciao", "ciao", 1.0), ("a b", "", 1.0)],
)
def test_hand_cases(spark, ref, hyp, wer):
    assert one(spark, [(ref, hyp)]).wer == pytest.approx(wer)


def test_ratio_of_sums_and_blank_references(spark):
    row = one(spark, [("a b c d", "a b c d"), ("a", "x"), (None, "x"), ("   ", "x y"), ("b", None)])
    assert (row.n_pairs, row.edits, row.ref_words) == (3, 2, 6)
    assert row.wer == pytest.approx(2 / 6)


def test_nothing_to_score(spark):
    row = one(spark, [(" ", "a"), (None, "b")])
    assert (row.n_pairs, row.edits, row.ref_words, row.wer) == (0, 0, 0, 0.0)
    empty = score(spark.createDataFrame([], "ref string, hyp string")).collect()
    assert [(r.n_pairs, r.wer) for r in empty] == [(0, 0.0)]


def test_groups_without_references_stay(spark):
    rows = [("g1", "a b", "a c"), ("g2", " ", "x"), ("g1", "c", "c")]
    df = spark.createDataFrame(rows, "grp string, ref string, hyp string")
    got = {r.grp: (r.n_pairs, r.wer) for r in score(df, by=["grp"]).collect()}
    assert got == {"g1": (2, pytest.approx(1 / 3)), "g2": (0, 0.0)}


def test_clean_normalises_both_sides(spark):
    assert one(spark, [("Perché, no? [rumore]", "Perche no")], clean=True).wer == 0.0
    assert one(spark, [("Perché, no?", "Perche no")]).wer == 1.0


def test_pair_edits_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a b", "a"), (2, None, "a")], "id int, ref string, hyp string")
    rows = {r.id: (r.edits, r.ref_words) for r in pair_edits(df).collect()}
    assert rows == {1: (1, 2), 2: (None, None)}
