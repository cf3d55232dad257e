"""Approximate nearest neighbours by stable projections.

Vectors are scaled to length one and projected on a few Gaussian directions. The projected points
of each index block form a kd-tree. A query opens the cells of the tree in order of their distance in
the projected space and takes the points in them one after the other by their own projected distance,
a few at a time: a point is taken when no cell still closed can hold a nearer one. The original vectors of what it
takes are verified. It stops when a chi-square test says that an unseen vector as near as its present
k-th neighbour would, but for a chosen miss probability, have been met: (projected distance /
distance)^2 of a vector follows a chi-square law with as many degrees of freedom as there are directions.
`verified` counts the vectors that a query was compared with.

Index blocks and query groups have fixed sizes. Every block meets every query group in a task of
its own, which returns k rows per query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrolens.llm.common import in_order, table
from hydrolens.sources.folders import RunFolder

DIRECTIONS = 8  # even, so that the chi-square law has a closed form
MISS = 0.05
LEAF = 64
BLOCK_ROWS = 8192
QUERY_ROWS = 512
# Cells opened and points verified at a time.
STEP_LEAVES = 16
STEP_ROWS = 128


def chi_square_quantile(p: float, degrees: int) -> float:
    """By bisection of the closed form for even degrees of freedom."""

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def directions(size: int) -> np.ndarray:
    return np.random.default_rng(size).standard_normal((size, DIRECTIONS))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length one; first by the largest component, so that no square is lost."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def kd_leaves(points: np.ndarray) -> list[np.ndarray]:
    """Rows of the cells of a kd-tree, split at the median of the widest direction."""
    open_cells, leaves = [np.arange(len(points))], []
    while open_cells:
        cell = open_cells.pop()
        if len(cell) <= LEAF:
            leaves.append(cell)
            continue
        values = points[cell, np.ptp(points[cell], axis=0).argmax()]
        order = np.argpartition(values, len(cell) // 2)
        open_cells += [cell[order[: len(cell) // 2]], cell[order[len(cell) // 2 :]]]
    return leaves


def _matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.to_list(), np.float64)


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """One row: the block's vectors in the order of the tree's cells, and the cells' boxes."""
    vectors = unit(_matrix(rows["vector"]))
    points = vectors @ directions(vectors.shape[1])
    leaves = kd_leaves(points)
    order = np.concatenate(leaves)
    boxes = np.array([[points[x].min(axis=0), points[x].max(axis=0)] for x in leaves])
    return pd.DataFrame(
        {
            "dim": [rows["dim"].iloc[0]],
            "block": [rows["block"].iloc[0]],
            "ids": [rows["vec_id"].to_numpy(np.int64)[order].tobytes()],
            "slots": [rows["slot"].to_numpy(np.int64)[order].tobytes()],
            "vectors": [vectors[order].tobytes()],
            "sizes": [np.array([len(x) for x in leaves]).tobytes()],
            "boxes": [boxes.tobytes()],
        }
    )


def search_block(block, queries: np.ndarray, own: np.ndarray, k: int, limit: float):
    """Ids and cosines of the k nearest rows of the block, and the number of rows verified, for each query."""
    dim = queries.shape[1]
    ids, slots = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["slots"], np.int64)
    vectors = np.frombuffer(block["vectors"]).reshape(-1, dim)
    ends = np.cumsum(np.frombuffer(block["sizes"], np.int64))
    boxes = np.frombuffer(block["boxes"]).reshape(-1, 2, DIRECTIONS)
    rows = [np.arange(a, b) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
    points, projected = vectors @ directions(dim), queries @ directions(dim)
    found = []
    for query, point, me in zip(queries, projected, own):
        gaps = np.maximum(0, np.maximum(boxes[:, 0] - point, point - boxes[:, 1]))
        gaps = (gaps * gaps).sum(axis=1)
        order = np.argsort(gaps, kind="stable")
        ends_at = np.append(gaps[order], np.inf)  # what the closed cells can hold at best
        best, scores, verified, opened = np.zeros(0, np.int64), np.zeros(0), 0, 0
        waiting, away = np.zeros(0, np.int64), np.zeros(0)  # points of open cells by projected distance
        while True:
            # Squared distance of unit vectors; the margin covers rounding.
            reach = limit * max(0.0, 2 - 2 * scores[-1]) + 1e-9 if len(best) == k else np.inf
            while ends_at[opened] <= reach and opened < len(order) and np.searchsorted(away, ends_at[opened], "right") < STEP_ROWS:
                cells = np.concatenate([rows[c] for c in order[opened : opened + STEP_LEAVES]])
                opened = min(opened + STEP_LEAVES, len(order))
                cells = cells[slots[cells] != me]
                far = points[cells] - point
                far = np.einsum("ij,ij->i", far, far)
                near = far <= reach  # the reach never grows again
                waiting, away = np.concatenate([waiting, cells[near]]), np.concatenate([away, far[near]])
                by = np.argsort(away)
                waiting, away = waiting[by], away[by]
            ready = min(STEP_ROWS, int(np.searchsorted(away, min(reach, ends_at[opened]), "right")))
            if not ready:
                break
            taken, waiting, away = waiting[:ready], waiting[ready:], away[ready:]
            here = np.concatenate([best, taken])
            value = np.concatenate([scores, (vectors[taken] * query).sum(axis=1)])
            top = np.lexsort((ids[here], -value))[:k]
            best, scores, verified = here[top], value[top], verified + ready
        found.append((ids[best], scores, verified))
    return found


def _search(k: int, limit: float):
    def search(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(asked):
            dim = int(index["dim"].iloc[0])
            queries = unit(_matrix(asked["vector"]))
            own = asked["query_slot"].to_numpy(np.int64)
            for q, s, (ids, scores, n) in zip(asked["query_id"], own, search_block(index.iloc[0], queries, own, k, limit)):
                # The block's count stands on one of its rows.
                counts = np.where(np.arange(len(ids)) == 0, n, 0)
                out.append(pd.DataFrame({"dim": dim, "query_id": q, "query_slot": s, "vec_id": ids, "score": np.clip(scores, -1, 1), "n": counts}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("dim", "query_id", "query_slot", "vec_id", "score", "n")})

    return search


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, vector (doubles) and dim of the rows that take part: with an id, not null, not zero,
    all components finite."""
    infinite = F.lit(float("inf"))
    v = F.col("vector")
    return (
        vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        # NaN is larger than infinity here; a null component makes the first test null or false.
        .where(F.col("vec_id").isNotNull())
        .where(F.forall(v, lambda x: F.coalesce(F.abs(x) < infinite, F.lit(False))) & F.exists(v, lambda x: x != 0))
        .withColumn("dim", F.size(v))
    )


def nearest(
    vectors: DataFrame, asked, run: RunFolder, k: int = 5, miss: float = MISS, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k nearest other rows by cosine of every row for which the condition `asked` (on vec_id)
    holds: query_id, rank, vec_id, score and verified (rows that the query was compared with). Ties go to the smaller vec_id. Only vectors of equal
    length are compared; a query with fewer candidates gets all of them. Rows with the same vec_id
    are rows of their own. Rows without an id take no part. Empty tables give an empty result."""
    rows = in_order(usable(vectors, key, vector), ["vec_id"], run, "vectors", ["dim"]).withColumn(
        "block", (F.col("slot") / BLOCK_ROWS).cast("int")
    )
    rows = run.keep(rows, "numbered")
    index = run.keep(
        rows.groupBy("dim", "block").applyInPandas(
            _build, "dim int, block int, ids binary, slots binary, vectors binary, sizes binary, boxes binary"
        ),
        "index",
    )
    queries = rows.where(asked).select(
        F.col("vec_id").alias("query_id"), F.col("slot").alias("query_slot"), "vector", "dim"
    )
    queries = in_order(queries, ["query_slot"], run, "queries", ["dim"]).withColumn(
        "part", (F.col("slot") / QUERY_ROWS).cast("int")
    )
    queries = run.keep(queries.drop("slot"), "asked")
    parts = queries.groupBy("dim").agg(F.max("part").alias("parts"))
    blocks = index.groupBy("dim").agg(F.max("block").alias("blocks"))
    index = index.join(parts, "dim").withColumn("part", F.explode(F.sequence(F.lit(0), "parts"))).drop("parts")
    queries = queries.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), "blocks"))).drop("blocks")
    meet = ["dim", "block", "part"]
    found = (
        index.groupBy(*meet)
        .cogroup(queries.groupBy(*meet))
        .applyInPandas(_search(k, chi_square_quantile(1 - miss, DIRECTIONS)), "dim int, query_id long, query_slot long, vec_id long, score double, n long")
    )
    query = Window.partitionBy("dim", "query_slot", "query_id")
    return (
        found.withColumn("rank", F.row_number().over(query.orderBy(F.desc("score"), "vec_id")))
        .withColumn("verified", F.sum("n").over(query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "verified")
    )


def embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, RunFolder(spark))
