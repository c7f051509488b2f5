"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlato.llm.common import mix, table

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
# Buckets that one row of counts holds, and nodes of the first summing step.
BLOCK = 4096
NODES = 1024
# The model's size is bounded by this many labels.
MAX_LABELS = 1000
SMOOTHING = 0.5
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def grams(text: str, letters: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams of the whole text, in lower case; anything but letters is one gap."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    low = points < 0x10000
    if low.all():
        is_letter = letters[points]
    else:
        is_letter = np.zeros(len(points), bool)
        is_letter[low] = letters[points[low]]
        is_letter[~low] = [chr(c).isalpha() for c in points[~low]]
    if not is_letter.any():
        return np.empty(0, np.int64)
    kept = np.concatenate([[0], np.where(is_letter, points, 0), [0]]).astype(np.uint64)
    kept = kept[np.concatenate([[True], (kept[1:] != 0) | (kept[:-1] != 0)])]
    found = []
    for n in ORDERS:
        h = np.full(max(0, len(kept) - n + 1), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x110001) + kept[k : k + len(h)]
        # a gap alone says nothing
        h = h[kept != 0] if n == 1 else h
        found.append((mix(h) & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(found)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per label: documents and n-grams by bucket of one task, packed in blocks."""
    letters = letter_table()
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            found = grams(text, letters)
            if len(found):
                mine = counts.setdefault(label, np.zeros(BUCKETS + BLOCK, np.int64))
                mine[:BUCKETS] += np.bincount(found, minlength=BUCKETS)
                mine[BUCKETS] += 1
    node = TaskContext.get().partitionId() % NODES
    rows = [
        (label, b, node, part.tobytes())
        for label, mine in counts.items()
        for b, part in enumerate(mine.reshape(-1, BLOCK))
        if part.any()
    ]
    yield pd.DataFrame(rows, columns=["label", "block", "node", "counts"])


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK, np.int64)
    for packed in rows["counts"]:
        total += np.frombuffer(packed, np.int64)
    return rows.head(1).assign(counts=[total.tobytes()])


class Model:
    """Labels in order and log-probabilities, ``weights[bucket, label]``."""

    def __init__(self, labels: list[str], counts: np.ndarray, documents: np.ndarray) -> None:
        self.labels = labels
        smooth = counts + SMOOTHING
        self.weights = np.ascontiguousarray(np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))
        self.prior = np.log(documents / documents.sum()) if len(labels) else documents

    def predict(self, text: str | None, letters: np.ndarray) -> tuple[str, float]:
        found = grams(text, letters) if text else ()
        if not len(found) or not self.labels:
            return UNKNOWN, 0.0
        logs = self.prior + self.weights[found].sum(axis=0, dtype=np.float64)
        odds = np.exp(logs - logs.max())
        best = int(np.argmax(odds))
        return self.labels[best], float(odds[best] / odds.sum())


def learn(docs: DataFrame) -> Model:
    """A model of the rows ``text, label`` that have both.

    All rows count. Tasks sum counts of their own rows; the sums meet by label
    and block of buckets, in two steps, so that no group holds more than a share
    of the tasks. What reaches the driver is one table of ``BUCKETS`` numbers a
    label, for ``MAX_LABELS`` labels at most; more raise ``ValueError``.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("label").isNotNull()).select("text", "label")
    schema = "label string, block int, node int, counts binary"
    part = rows.mapInPandas(_counted, schema)
    part = part.groupBy("label", "block", "node").applyInPandas(_summed, schema)
    total = part.groupBy("label", "block").applyInPandas(_summed, schema)
    if part.select("label").distinct().limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    found = total.toPandas()
    labels = sorted(found["label"].unique())
    counts = np.zeros((len(labels), BUCKETS + BLOCK), np.int64)
    for row in found.itertuples():
        counts[labels.index(row.label)].reshape(-1, BLOCK)[row.block] = np.frombuffer(row.counts, np.int64)
    return Model(labels, counts[:, :BUCKETS], counts[:, BUCKETS])


def identify(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior probability of the best label.

    A text that is null, empty or without letters is ``und`` with score 0, and
    so is every text where the model has learned no label. Only ``text`` goes to
    Python; columns named ``lang_pred`` or ``score`` are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for batch in batches:
            yield pd.DataFrame([sent.value.predict(t, letters) for t in batch], columns=["lang_pred", "score"])

    # a filter by what is found would else run the function a second time, in workers of its own
    predict = predict.asNondeterministic()
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    made = docs.select(*kept, predict(F.col(text)).alias("__lang"))
    return made.select(*kept, "__lang.lang_pred", "__lang.score")


def in_known_language(docs: DataFrame, text: str, label: str, least: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose text is in no language that the labelled rows teach.

    Those are texts without letters, null ones and those whose best label is less
    probable than ``least``. A null label is filled with the one found.
    """
    columns = docs.columns
    model = learn(docs.select(F.col(text).alias("text"), F.col(label).alias("label")))
    made = identify(docs.select(F.struct(*columns).alias("row"), F.col(text).alias("text")), "text", model)
    made = made.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    filled = F.coalesce(F.col(f"row.{label}"), "lang_pred").alias(label)
    return made.select(*[filled if c == label else F.col(f"row.`{c}`") for c in columns])


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 1 when divided by 3; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))).select("text", F.col("lang").alias("label")))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(out, "text", model).select("doc_id", "held_out", "lang_pred", "score")
