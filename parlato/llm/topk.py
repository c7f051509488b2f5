"""Exact top-k search by inner product: histogram selection over all scores."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlato.llm.common import table
from parlato.session import scratch_path

# Queries that go to the executors at once, and the values they may hold in all.
BLOCK_QUERIES = 4096
BLOCK_VALUES = 1 << 20
# Bins of one refinement: each pass makes the bins this many times finer.
BINS = 256
# Scores that a task holds at once.
TILE = 1 << 22


def quantised(df: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """``id, v``: each component x as floor(scale * x), x as double. Rows with a null key or vector, or with null
    or non-finite components, are left out."""
    x = F.col(vector)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    kept = df.where(F.col(key).isNotNull() & x.isNotNull() & finite)
    return kept.select(
        F.col(key).cast("long").alias("id"),
        F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v"),
    )


class Block:
    """Queries of one block, by vector length: ids and an integer-valued matrix."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]) -> None:
        self.ids = ids
        by_length: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_length.setdefault(len(v), []).append(i)
        self.parts = {n: (np.array(at), np.array([vectors[i] for i in at], np.int64).reshape(len(at), n)) for n, at in by_length.items()}

    def scores(self, batch: pa.RecordBatch):
        """Gives (query positions, candidate ids, scores) in tiles; own rows score the smallest integer.

        Products run in floating point where every sum is an exact integer there.
        """
        ids, vectors = batch.column(0).to_numpy(), batch.column(1)
        flat, sizes = vectors.flatten().to_numpy(), vectors.value_lengths().to_numpy()
        starts = np.cumsum(sizes) - sizes
        for n in np.unique(sizes):
            if n not in self.parts:
                continue
            rows = np.flatnonzero(sizes == n)
            at, queries = self.parts[n]
            found = flat[starts[rows][:, None] + np.arange(n)]
            bound = int(n) * int(np.abs(queries).max(initial=0)) * int(np.abs(found).max(initial=0))
            kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
            queries, found, step = queries.astype(kind), found.astype(kind), max(1, TILE // max(1, len(at)))
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                out = (queries @ found[k : k + step].T).astype(np.int64)
                out[self.ids[at][:, None] == ids[part][None, :]] = np.iinfo(np.int64).min
                yield at, ids[part], out


OWN = np.iinfo(np.int64).min


def _histograms(block: Block, low: np.ndarray, width: int, k: int):
    """Counts of scores by query and bin over one task's rows, for scores from ``low`` up to ``BINS`` bins of ``width``.

    Scores above the last bin count in it. Bins below the one where the task's
    own count reaches ``k`` can't hold the k-th score and are left out.
    """

    def run(batches):
        counts = np.zeros((len(block.ids), BINS), np.int64)
        for batch in batches:
            for at, _, scores in block.scores(batch):
                bins = (scores - low[at][:, None]) // width
                kept = (scores != OWN) & (bins >= 0)
                np.minimum(bins, BINS - 1, out=bins)
                q = np.broadcast_to(np.arange(len(at))[:, None], bins.shape)
                flat = np.bincount(q[kept] * BINS + bins[kept], minlength=len(at) * BINS)
                counts[at] += flat.reshape(len(at), BINS)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(counts[q, b])], ["q", "bin", "n"])

    return run


def _selected(block: Block, cut: np.ndarray, k: int):
    """Rows with a score of at least the k-th; of those equal to it, the task's ``k`` smallest ids."""

    def run(batches):
        ties: dict[int, list[np.ndarray]] = {}
        schema = pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        for batch in batches:
            for at, ids, scores in block.scores(batch):
                limit = cut[at][:, None]
                q, c = np.nonzero((scores > limit) & (scores != OWN))
                yield pa.RecordBatch.from_arrays([pa.array(at[q]), pa.array(ids[c]), pa.array(scores[q, c])], schema=schema)
                q, c = np.nonzero((scores == limit) & (scores != OWN))
                first = np.searchsorted(q, np.arange(len(at) + 1))
                for j in np.unique(q):
                    mine = ids[c[first[j] : first[j + 1]]]
                    held = np.concatenate([*ties.get(at[j], []), mine])
                    ties[at[j]] = [np.partition(held, k - 1)[:k] if len(held) > k else held]
        for q, (held,) in ties.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), q)), pa.array(held), pa.array(np.full(len(held), cut[q]))], schema=schema
            )

    return run


def _kth_scores(rows: DataFrame, block: Block, longest: int, k: int) -> np.ndarray:
    """The k-th best score of each query of the block, or the lowest there can be where fewer rows exist."""
    low = np.full(len(block.ids), -longest, np.int64)
    want = np.full(len(block.ids), k, np.int64)
    width = max(1, BINS ** max(0, math.ceil(math.log(2 * longest + 1, BINS)) - 1))
    while BINS * width < 2 * longest + 1:
        width *= BINS
    while True:
        made = rows.mapInArrow(_histograms(block, low, width, k), "q long, bin long, n long")
        total = made.groupBy("q", "bin").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros((len(block.ids), BINS), np.int64)
        counts[total["q"].to_numpy(), total["bin"].to_numpy()] = total["n"].to_numpy()
        reached = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] >= want[:, None]
        bins = np.where(reached.any(axis=1), BINS - 1 - np.argmax(reached[:, ::-1], axis=1), 0)
        low = low + bins * width
        if width == 1:
            return low
        # rows above the bin stay in the count: they fall in the last bin of the next pass
        width //= BINS


def top_k(df: DataFrame, key: str, vector: str, is_query, k: int = 20, scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of each query row, ties to the smaller id.

    Every row but those of the query's own id is scored; the score is the inner
    product of the quantised vectors, taken between vectors of one length only.
    Queries go out in blocks of bounded size. For each block a few passes over
    all rows sum score histograms, each pass refining the bin that holds a
    query's k-th score, and a last pass keeps the rows at or above it: at most
    ``k`` rows a task and query leave for the final ranking.

    Rows with a null id or an unusable vector take no part. Rows that repeat an
    id are candidates each; query rows that repeat one are answered once for
    the first of them in order of their values. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = quantised(df, key, vector, scale)
    queries = rows.where(is_query(F.col("id")))
    top = rows.agg(F.max(F.array_max(F.transform("v", lambda e: F.abs(e)))).alias("m"), F.max(F.size("v")).alias("n")).first()
    longest = max(1, (top["m"] or 0) ** 2 * (top["n"] or 0))
    count = queries.count()
    blocks = max(1, math.ceil(count / min(BLOCK_QUERIES, max(1, BLOCK_VALUES // max(1, top["n"] or 1)))))
    path = scratch_path(spark, "top-k")
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for b in range(blocks if count else 0):
        mine = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).groupBy("id").agg(F.min("v").alias("v"))
        held = mine.orderBy("id").toPandas()
        block = Block(held["id"].to_numpy(np.int64), [np.asarray(v, np.int64) for v in held["v"]])
        cut = _kth_scores(rows, block, longest, k)
        found = rows.mapInArrow(_selected(block, cut, k), "q long, vec_id long, score long")
        names = spark.createDataFrame(held[["id"]].rename(columns={"id": "query_id"}).assign(q=range(len(held))))
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked.join(F.broadcast(names), "q").select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", lambda key: key % 20 == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
