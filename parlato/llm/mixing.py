"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlato.llm.common import mix, n_words, stage, table
from parlato.operators.numbering import number_by_key

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3.0
# Rows that one node of the reduction tree rounds on average.
NODE_ROWS = 1024
# Copy probabilities this near to 0 or 1 are integral.
TINY = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """``group, source_size, n_docs, target`` from ``group, size``; one row per source.

    ``group`` is the empty text for a null source and ``=`` and the name for
    others. Sources in code point order, null last, weigh ``weights``, repeating.
    A target over ``most`` times its source's size stops there, and what is left
    is shared by weight among the others until none is above.
    """
    sums = sizes.groupBy("group").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sums = sums.withColumn("last", (F.col("group") == "").cast("int"))
    ranked = number_by_key(sums, ["last", "group"], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.select("group", "source_size", "n_docs", weight.alias("weight")), "mix-sources")
    top = F.col("source_size") * most
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * level > top
        got = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(over, top).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(over.cast("int")).alias("n"),
        ).first()
        if got["n"] is None or got["n"] == capped or not got["weight"]:
            break
        capped, level = got["n"], (got["total"] - got["fixed"]) / got["weight"]
    return ranked.select("group", "source_size", "n_docs", F.least(F.col("weight") * level, top).alias("target"))


def _pairwise(size: np.ndarray, p: np.ndarray, coin: np.ndarray, order: list[int]) -> int:
    """Round the rows of ``order`` in place, two at a time; gives the one left fractional, or -1."""
    left = -1
    for j in order:
        if left < 0:
            left = j
            continue
        i = left
        up = min(size[i] * (1 - p[i]), size[j] * p[j])
        down = min(size[i] * p[i], size[j] * (1 - p[j]))
        moved = up if coin[j] * (up + down) < down else -down
        p[i] += moved / size[i]
        p[j] -= moved / size[j]
        ends = [k for k in (i, j) if TINY < p[k] < 1 - TINY]
        for k in (i, j):
            if k not in ends:
                p[k] = round(p[k])
        left = ends[0] if ends else -1
    return left


def pivot(size: np.ndarray, p: np.ndarray, coin: np.ndarray) -> tuple[np.ndarray, int]:
    """Round copy probabilities ``p`` until at most one is fractional, whose position is returned, or -1.

    A row is paired with the next smaller ones, as many as can take its words, and
    one coin decides whether words move to it or from it, until it is integral;
    each partner moves in proportion to its room. So every probability keeps its
    expectation and the words expected in all stay the same. Large rows go first,
    which leaves a small one to the end. Rows whose partners have too little room
    are paired two at a time.
    """
    p = np.where((p > TINY) & (p < 1 - TINY), p, np.round(p))
    order = [int(k) for k in np.argsort(-size, kind="stable") if 0 < p[k] < 1]
    for at, i in enumerate(order):
        if not TINY < p[i] < 1 - TINY:
            p[i] = round(p[i])
            continue
        rise, fall = size[i] * (1 - p[i]), size[i] * p[i]
        partners, rooms, total = [], [], 0.0
        for k in order[at + 1 :]:
            room = min(size[k] * p[k] / rise, size[k] * (1 - p[k]) / fall)
            partners.append(k)
            rooms.append(room)
            total += room
            if total >= 1:
                break
        else:
            rest = [k for k in order[at:] if TINY < p[k] < 1 - TINY]
            left = _pairwise(size, p, coin, rest)
            p = np.where((p > TINY) & (p < 1 - TINY), p, np.round(p))
            return p, left
        moved = -rise if coin[i] < p[i] else fall
        for k, room in zip(partners, rooms, strict=True):
            p[k] += moved * room / total / size[k]
        p[i] = float(coin[i] < p[i])
    return p, -1


def _coin(h: np.ndarray, level: int) -> np.ndarray:
    return (mix(h.view(np.uint64) + np.uint64(level * 2 + 1)) >> np.uint64(11)) / float(1 << 53)


def _rounded(level: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "doc_id", "size"], kind="stable")
        size = rows["size"].to_numpy(np.float64)
        p, left = pivot(size, rows["p"].to_numpy(np.float64), _coin(rows["h"].to_numpy(np.int64), level))
        if last and left >= 0:
            p[left], left = round(p[left]), -1
        return rows.assign(p=p, open=np.arange(len(rows)) == left)

    return run


def copies(docs: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES, seed: int = 0) -> DataFrame:
    """How often the mix takes each row of ``doc_id, text, source``: ``doc_id, h, source, size, source_size, target, copies``.

    A row's expected copies are its source's target over its source's size. The
    whole part is taken, the rest is rounded by :func:`pivot` in a tree: rows of
    a source are dealt to nodes of about ``NODE_ROWS`` by hash, each node leaves
    at most one fractional row, and these meet in the next level's nodes. The
    last row of a source goes to the nearer side. So a source's words miss its
    target by half a row at most, whatever its share of all rows, and the same
    rows always give the same result.

    ``size`` is the number of words; null or empty texts have none, expect the
    whole part of their copies and move no words. A null source is a source of its
    own. ``h`` is a hash of id and text; equal rows count each. No rows give none.
    """
    sized = docs.select(
        # as text, since pandas has no null integers
        F.col("doc_id").cast("string").alias("doc_id"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"),
        "source",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("group"),
        n_words(F.col("text")).alias("size"),
    )
    sized = stage(sized, "mix-sizes")
    targets = source_targets(sized, weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(targets, "group").withColumn("ratio", ratio)
    rows = rows.withColumn("whole", F.floor(F.col("ratio") + TINY))
    rows = rows.withColumn("p", F.greatest(F.col("ratio") - F.col("whole"), F.lit(0.0)))
    fixed = (F.col("p") <= TINY) | (F.col("size") == 0)
    columns = ["doc_id", "h", "source", "group", "size", "source_size", "target", "whole", "n_docs"]
    done = [rows.where(fixed).select(*columns, F.lit(0.0).alias("p"))]
    nodes = F.greatest(F.ceil(F.col("n_docs") / NODE_ROWS), F.lit(1)).cast("long")
    rows = rows.where(~fixed).select(*columns, "p", F.pmod(F.col("h"), nodes).alias("node"))
    most_docs = targets.agg(F.max("n_docs")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(most_docs, 2), NODE_ROWS)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    for level in range(levels):
        made = rows.groupBy("group", "node").applyInPandas(
            _rounded(level, level == levels - 1), f"{kinds}, open boolean"
        )
        made = stage(made, "mix-level")
        done.append(made.where("not open").select(*columns, "p"))
        rows = made.where("open").select(*columns, "p", F.expr(f"node div {NODE_ROWS}").alias("node"))
    id_type = docs.schema["doc_id"].dataType
    return reduce(DataFrame.unionByName, done).select(
        F.col("doc_id").cast(id_type).alias("doc_id"),
        "h",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.col("p")).cast("long").alias("copies"),
    )


def mix_rows(docs: DataFrame, weights=WEIGHTS, most: float = MAX_COPIES, seed: int = 0) -> DataFrame:
    """``docs`` with each row as often as :func:`copies` takes it; rows with no copies go.

    Equal rows share their copies evenly.
    """
    mixed = copies(docs.select("doc_id", "text", "source"), weights, most, seed)
    taken = mixed.groupBy("doc_id", "h").agg(F.sum("copies").alias("__all"), F.count("*").alias("__rows"))
    taken = stage(taken.where("__all > 0").withColumnsRenamed({"doc_id": "__id", "h": "__h"}), "mix-copies")
    rows = docs.withColumn("__own", F.xxhash64(F.lit(seed), "doc_id", "text"))
    rows = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__h")))
    turn = F.row_number().over(Window.partitionBy("__id", "__h").orderBy("__own"))
    rows = rows.withColumn("__n", F.expr("__all div __rows") + (turn <= F.col("__all") % F.col("__rows")).cast("long"))
    times = F.array_repeat(F.lit(0), F.col("__n").cast("int"))
    return rows.withColumn("__copy", F.explode(times)).select(*docs.columns)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )
