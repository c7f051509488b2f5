"""Hard-negative mining by inner product: cover trees over norm-augmented candidates, searched best node first."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlato.llm.common import stage, table
from parlato.session import scratch_path

# Fixed values of the report: positives of an anchor, negatives of each positive, and the window in per cent.
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
# Candidates of one tree, and the values that they may hold in all.
TREE_ROWS, TREE_VALUES = 1 << 13, 1 << 20
# Points up to which a node is not parted, and children that a node may have.
LEAF, CHILDREN = 256, 64
# How many times nearer the points of a level lie to their centres than those of the level above.
BASE = 1.3
# Scores that are looked at in one go.
TILE = 1 << 20
# Anchors that go to the trees at once, and the values that they may hold in all.
BLOCK_ANCHORS, BLOCK_VALUES = 2048, 1 << 19
# Rows whose squared length passes this take no part: beyond it, an inner product need not fit 64 bits.
MOST_SQUARED = 4e18
# Relative room for rounding in a bound.
SLACK = 1e-9
# Stands where there is no score.
NONE = -(1 << 62)


PARTS = ("ids", "labels", "vectors", "first", "last", "radius", "centre", "parent")
TREE = "n int, " + ", ".join(f"{c} binary" for c in PARTS)


class CoverTree:
    """A cover tree over one batch of integer vectors, all of one length.

    To each vector one component is added that brings all to the same length R,
    so that a candidate's inner product with a query falls as its distance from
    the query (with 0 added) grows. The root covers all points. The children of a node on level i
    are centres more than BASE^i apart that cover its points within BASE^i; a centre is its own
    first child, and each point goes to the nearest centre. Levels on which a node would be its own only child are
    skipped. A node is a leaf if it has at most ``LEAF`` points or if
    ``CHILDREN`` centres don't cover it on the next level: its points are then so far from each other
    that bounds would not tell them apart. ``radius`` is how far a node's points reach as measured; their inner products with
    q are that of the centre, give or take ``radius`` times the length of q.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, first, last, radius, centre, parent) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.first, self.last, self.radius, self.centre, self.parent = first, last, radius, centre, parent
        self.children: list[list[int]] = [[] for _ in parent]
        for node in range(1, len(parent)):
            self.children[parent[node]].append(node)

    @classmethod
    def over(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> CoverTree:
        squared = (vectors.astype(np.float64) ** 2).sum(axis=1)
        extra = np.sqrt(np.maximum(squared.max(initial=0) - squared, 0))
        points = np.column_stack([vectors.astype(np.float64), extra])
        nodes: list[tuple[int, int, float, int, int]] = []
        order: list[np.ndarray] = []
        todo = [(np.arange(len(ids)), 0, -1)]
        place = 0
        # depth first, so the points of each node lie side by side
        while todo:
            rows, at, parent = todo.pop()
            away = np.sqrt(((points[rows] - points[at]) ** 2).sum(axis=1))
            nodes.append((place, place + len(rows), float(away.max()), at, parent))
            parts = cls._parted(points, rows, at, away) if len(rows) > LEAF and away.any() else []
            if parts:
                node = len(nodes) - 1
                todo += [(part, centre, node) for part, centre in parts]
            else:
                order.append(rows)
                place += len(rows)
        first, last, radius, at, parent = map(np.array, zip(*nodes, strict=True))
        rows = np.concatenate(order)
        return cls(ids[rows], labels[rows], vectors[rows], first, last, radius, vectors[at], parent)

    def row(self) -> pa.RecordBatch:
        """All arrays but the vectors' length as one row of bytes."""
        kept = (self.ids, self.labels, self.vectors, self.first, self.last, self.radius, self.centre, self.parent)
        columns = [pa.array([self.vectors.shape[1]], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in kept]]
        return pa.RecordBatch.from_arrays(columns, ["n", *PARTS])

    @classmethod
    def of(cls, n: int, held: dict[str, bytes]) -> CoverTree:
        made = {c: np.frombuffer(held[c], np.float64 if c == "radius" else np.int64) for c in PARTS}
        for c, rows in (("vectors", "ids"), ("centre", "first")):
            made[c] = made[c].reshape(len(made[rows]), n)
        return cls(**made)

    @staticmethod
    def _parted(points: np.ndarray, rows: np.ndarray, at: int, away: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """The points of one node by the centres of the next level that needs more than one; nothing if it needs too many."""
        reach = BASE ** (math.ceil(math.log(away.max(), BASE)) - 1)
        centres, near, whose = [at], away.copy(), np.zeros(len(rows), np.int64)
        while near.max() > reach:
            if len(centres) == CHILDREN:
                return []
            # the point that is farthest from all centres so far
            far = int(np.argmax(near))
            to = np.sqrt(((points[rows] - points[rows[far]]) ** 2).sum(axis=1))
            whose[to < near] = len(centres)
            near = np.minimum(near, to)
            centres.append(int(rows[far]))
        return [(rows[whose == k], centre) for k, centre in enumerate(centres)]

    def search(self, queries: np.ndarray, ask: Search) -> None:
        """Let ``ask`` look at the points of every leaf that its windows may need.

        Nodes are passed down level by level, with the bounds of their inner
        products for each query; a query goes on to the children of a node unless its windows lie outside. Then
        each query takes its leaves from the highest upper bound down, all queries
        one step at a time, until none of its windows can gain from the rest.
        """
        length = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        open_ = [(0, np.arange(len(queries)))]
        leaves, whose, tops, bottoms = [], [], [], []
        while open_:
            below = []
            for node, asking in open_:
                middle = _products(queries[asking], self.centre[node : node + 1])[:, 0].astype(np.float64)
                room = self.radius[node] * length[asking]
                room = room * (1 + SLACK) + SLACK * np.abs(middle) + 1
                wanted = ask.wants(asking, middle - room, middle + room)
                asking = asking[wanted]
                if not len(asking):
                    continue
                if self.children[node]:
                    below += [(child, asking) for child in self.children[node]]
                else:
                    leaves.append(np.full(len(asking), node))
                    whose.append(asking)
                    bottoms.append((middle - room)[wanted])
                    tops.append((middle + room)[wanted])
            open_ = below
        if not leaves:
            return
        leaf, query, low, high = (np.concatenate(x) for x in (leaves, whose, bottoms, tops))
        order = np.lexsort((-high, query))
        leaf, query, low, high = leaf[order], query[order], low[order], high[order]
        step = np.arange(len(query)) - np.searchsorted(query, query)
        for round_ in range(int(step.max()) + 1):
            turn = np.flatnonzero(step == round_)
            turn = turn[ask.wants(query[turn], low[turn], high[turn])]
            if not len(turn):
                continue
            turn = turn[np.argsort(leaf[turn], kind="stable")]
            names, first = np.unique(leaf[turn], return_index=True)
            for node, asking in zip(names, np.split(query[turn], first[1:]), strict=True):
                at = slice(self.first[node], self.last[node])
                each = max(1, TILE // (at.stop - at.start))
                for k in range(0, len(asking), each):
                    some = asking[k : k + each]
                    ask.look(some, _products(queries[some], self.vectors[at]), self.ids[at], self.labels[at])


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: in floating point where every sum is an exact integer there."""
    bound = queries.shape[1] * int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0))
    if bound < 1 << 53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


class Search:
    """The best ``k`` rows of each window of each query so far: scores from ``low`` to ``high``, labels equal or not.

    Query q has the windows ``low[q]``; a window with low > high is empty.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> None:
        self.ids, self.labels, self.low, self.high, self.k, self.same = ids, labels, low, high, k, same
        n, windows = low.shape
        self.score = np.full((n, windows, k), NONE)
        self.found = np.full((n, windows, k), np.iinfo(np.int64).max)

    def wants(self, asking: np.ndarray, bottom: np.ndarray, top: np.ndarray) -> np.ndarray:
        """Whether scores between the bounds can still enter a window. Equal scores can, by a smaller id."""
        low = np.maximum(self.low[asking], self.score[asking, :, -1])
        inside = (self.low[asking] <= self.high[asking]) & (low <= top[:, None]) & (self.high[asking] >= bottom[:, None])
        return inside.any(axis=1)

    def look(self, asking: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        equal = self.labels[asking][:, None] == labels
        fit = (equal & (self.ids[asking][:, None] != ids)) if self.same else ~equal
        for w in range(self.low.shape[1]):
            last = self.score[asking, w, -1]
            inside = fit & (scores >= np.maximum(self.low[asking, w], last)[:, None]) & (scores <= self.high[asking, w][:, None])
            if len(ids) > self.k:
                masked = np.where(inside, scores, NONE)
                inside &= masked >= np.partition(masked, -self.k, axis=1)[:, -self.k, None]
            at, found = np.nonzero(inside)
            if not len(at):
                continue
            q = np.unique(asking[at])
            whose = np.concatenate([np.repeat(q, self.k), asking[at]])
            score = np.concatenate([self.score[q, w].ravel(), scores[at, found]])
            name = np.concatenate([self.found[q, w].ravel(), ids[found]])
            order = np.lexsort((name, -score, whose))
            first = np.searchsorted(whose[order], q)
            best = order[first[:, None] + np.arange(self.k)]
            self.score[q, w], self.found[q, w] = score[best], name[best]

    def rows(self) -> pa.RecordBatch:
        q, w, _ = at = np.nonzero(self.score > NONE)
        columns = [q, w, self.found[at], self.score[at], self.low[q, w]]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["q", "w", "vec_id", "score", "low"])


FOUND = "q long, w long, vec_id long, score long, low long"


def usable(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``id, label, v``: each component x as floor(scale * x), x as double, of the rows that take part."""
    x = F.col(vector)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    kept = df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & finite)
    made = kept.select(
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double"))).alias("v"),
    )
    squared = F.aggregate("v", F.lit(0.0), lambda acc, e: acc + e.cast("double") * e.cast("double"))
    return made.where(squared <= MOST_SQUARED).withColumn("v", F.transform("v", lambda e: e.cast("long")))


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one task as cover trees of up to ``TREE_ROWS`` rows, by vector length."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    count: dict[int, int] = {}

    def done(n: int) -> pa.RecordBatch:
        ids, labels, vectors = (np.concatenate(x) for x in zip(*held.pop(n), strict=True))
        del count[n]
        return CoverTree.over(ids, labels, vectors).row()

    for batch in batches:
        ids, labels = (batch.column(c).to_numpy() for c in ("id", "label"))
        lists = batch.column("v")
        flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        starts = np.cumsum(sizes) - sizes
        for n in np.unique(sizes):
            n = int(n)
            most = max(1, min(TREE_ROWS, TREE_VALUES // max(1, n)))
            rows = np.flatnonzero(sizes == n)
            for k in range(0, len(rows), most):
                at = rows[k : k + most]
                held.setdefault(n, []).append((ids[at], labels[at], flat[starts[at][:, None] + np.arange(n)].reshape(len(at), n)))
                count[n] = count.get(n, 0) + len(at)
                if count[n] >= most:
                    yield done(n)
            if sum(c * max(1, m) for m, c in count.items()) > 2 * TREE_VALUES:
                for m in list(count):
                    yield done(m)
    for n in list(count):
        yield done(n)


class Anchors:
    """One block of anchors: ids, labels, vectors by length, and windows where they are known."""

    def __init__(self, ids, labels, vectors, low: np.ndarray, high: np.ndarray) -> None:
        self.ids, self.labels = np.asarray(ids, np.int64), np.asarray(labels, np.int64)
        self.low, self.high = low, high
        by_length: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_length.setdefault(len(v), []).append(i)
        self.parts = {n: (np.array(at), np.array([vectors[i] for i in at], np.int64).reshape(len(at), n)) for n, at in by_length.items()}


def _searched(block: Anchors, most: int, same: bool) -> Callable:
    """What one task's trees have for each window of the block; the best so far carry over from tree to tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asks = {n: Search(block.ids[at], block.labels[at], block.low[at], block.high[at], most, same) for n, (at, _) in block.parts.items()}
        for batch in batches:
            for k, n in enumerate(batch.column("n").to_pylist()):
                if n in asks:
                    tree = CoverTree.of(n, {c: batch.column(c)[k].as_py() for c in PARTS})
                    tree.search(block.parts[n][1], asks[n])
        for n, ask in asks.items():
            made = ask.rows()
            q = block.parts[n][0][made.column("q").to_numpy()]
            yield pa.RecordBatch.from_arrays([pa.array(q), *made.columns[1:]], made.schema.names)

    return run


def hard_negatives(
    df: DataFrame,
    key: str,
    vector: str,
    label: str,
    is_anchor: Callable[[Column], Column],
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A row's score is its integer inner product with the anchor, taken between vectors of
    one length only; higher ones come first, of equal ones the smaller id. An
    anchor's positives are its first ``positives`` other rows of the same label. For each of them the
    first ``negatives`` rows of another label are returned whose score is from ``low`` to ``high`` per cent of
    the positive's.

    Each task plants cover trees of bounded size over the rows that it scans; they are stored
    once, and no row is moved. Anchors go out in blocks of bounded size: one pass over the
    trees finds the positives, a second one the negatives in the windows that
    these give. A task hands on at most the best few rows of each window.

    Rows with a null id, label or vector, with null or non-finite components, or
    with a squared length above 4 * 10^18 after scaling take no part. Rows that repeat an id are candidates
    each (no row of its own id is an anchor's positive, and no repeated pair is returned twice); anchor rows that
    repeat one are answered once, for the first of them in order of label and values. An empty table, or one
    without anchors, gives no rows.
    """
    spark = df.sparkSession
    rows = usable(df, key, vector, label, scale)
    trees = stage(rows.mapInArrow(_planted, TREE), "negative-trees")
    anchors = rows.where(is_anchor(F.col("id"))).groupBy("id").agg(F.min(F.struct("label", "v")).alias("a"))
    anchors = stage(anchors.select("id", "a.label", "a.v"), "negative-anchors")
    size = anchors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("longest")).first()
    each = min(BLOCK_ANCHORS, max(1, BLOCK_VALUES // max(1, size["longest"] or 1)))
    blocks = math.ceil(size["n"] / each)
    path = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    least, most = NONE + 1, -NONE
    for b in range(blocks):
        held = anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id").toPandas()
        if not len(held):
            continue
        vectors, n = [np.asarray(v, np.int64) for v in held["v"]], len(held)
        everything = Anchors(held["id"], held["label"], vectors, np.full((n, 1), least), np.full((n, 1), most))
        best = _ranked(trees.mapInArrow(_searched(everything, positives, True), FOUND), ["q"], positives).toPandas()
        # positives of one anchor are its windows, of equal scores one; empty ones have no room
        score = np.zeros((n, positives), np.int64)
        name = np.full((n, positives), -1)
        q, at = best["q"].to_numpy(), best["rank"].to_numpy() - 1
        score[q, at], name[q, at] = best["score"].to_numpy(), best["vec_id"].to_numpy()
        given = np.zeros((n, positives), bool)
        given[q, at] = True
        from_, to = _window(score, low, high)
        from_[~given], to[~given] = 1, 0
        block = Anchors(held["id"], held["label"], vectors, from_, to)
        found = _ranked(trees.mapInArrow(_searched(block, negatives, False), FOUND), ["q", "w"], negatives)
        windows = [
            (int(i), int(w), int(held["id"].iloc[i]), int(name[i, w]), int(score[i, w])) for i, w in zip(*np.nonzero(given), strict=True)
        ]
        known = spark.createDataFrame(windows, "q long, w long, anchor_id long, positive_id long, positive_score long")
        made = found.join(F.broadcast(known), ["q", "w"])
        made = made.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        made.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _window(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest whole score from ``low`` to ``high`` per cent of each score."""
    exact = [[(-(-low * int(s) // 100), high * int(s) // 100) for s in row] for row in score]
    both = np.array(exact, np.int64).reshape(*score.shape, 2)
    return both[..., 0].copy(), both[..., 1].copy()


def _ranked(found: DataFrame, window: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*window).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", changed), "vec_id", "embedding", "label", lambda key: key % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5),
n AS (
  SELECT p.a AS anchor_id, p.c AS positive_id, s.c AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.c)::INTEGER AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
