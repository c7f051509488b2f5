"""Word-level edit distance between two transcripts."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlato.functions.text import _bind, words

# Up to this many words in both texts together the JVM's quadratic routine is
# the faster one; spoken utterances stay far below it.
SHORT_PAIR_WORDS = 240

_FIRST_CODE = 19968  # a block of letters wide enough for every word of a short pair


def _short_distance(ref: Column, hyp: Column) -> Column:
    """Give each distinct word of the pair one character, then compare the two strings."""

    def encode(texts: Column, vocabulary: Column) -> Column:
        codes = F.transform(texts, lambda w: F.hex(F.array_position(vocabulary, w) + _FIRST_CODE))
        return F.decode(F.unhex(F.array_join(codes, "")), "UTF-16BE")

    return _bind(F.array_union(ref, hyp), lambda v: F.levenshtein(encode(ref, v), encode(hyp, v)))


def bit_parallel_distance(left: Sequence[str], right: Sequence[str]) -> int:
    """Levenshtein distance of two word lists, one column of the table per big-integer step.

    The bit-vector method of Myers (1999) in the form of Hyyrö (2003). The set bits
    of ``plus`` and ``minus`` are the steps of +1 and -1 down the current column.
    """
    start, stop = 0, min(len(left), len(right))
    while start < stop and left[start] == right[start]:
        start += 1
    tail = 0
    while tail < stop - start and left[-1 - tail] == right[-1 - tail]:
        tail += 1
    rows, columns = left[start : len(left) - tail], right[start : len(right) - tail]
    if len(rows) < len(columns):
        rows, columns = columns, rows
    if not columns:
        return len(rows)

    where: dict[str, int] = {}
    for i, word in enumerate(rows):
        where[word] = where.get(word, 0) | (1 << i)
    full = (1 << len(rows)) - 1
    plus, minus = full, 0
    for word in columns:
        level = where.get(word, 0) | minus
        level = (((level & plus) + plus) ^ plus | level) & full
        risen = ((minus | (full ^ (plus | level))) << 1 | 1) & full
        fallen = ((plus & level) << 1) & full
        plus, minus = fallen | (full ^ (risen | level)), risen & level
    return len(columns) + plus.bit_count() - minus.bit_count()


@F.pandas_udf(T.IntegerType())
def _long_distance(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    def pair(r, h):
        return None if r is None else bit_parallel_distance(r.split(" "), h.split(" "))

    return pd.Series([pair(r, h) for r, h in zip(ref, hyp)], dtype="Int32")


def word_edits(ref_words: Column, hyp_words: Column) -> Column:
    """Fewest word substitutions, insertions and deletions that turn one array into the other.

    Takes what :func:`parlato.functions.text.words` returns. Short pairs stay in
    the JVM; the Python worker receives the text of long pairs only, nulls else.
    """
    short = F.size(ref_words) + F.size(hyp_words) <= SHORT_PAIR_WORDS
    one_empty = (F.size(ref_words) == 0) | (F.size(hyp_words) == 0)

    def long_text(texts: Column) -> Column:
        return F.when(~short & ~one_empty, F.array_join(texts, " "))

    return (
        F.when(one_empty, F.size(ref_words) + F.size(hyp_words))
        .when(short, _short_distance(ref_words, hyp_words))
        .otherwise(_long_distance(long_text(ref_words), long_text(hyp_words)))
    )


def word_edit_distance(ref: Column, hyp: Column) -> Column:
    """:func:`word_edits` of two texts."""
    return word_edits(words(ref), words(hyp))
