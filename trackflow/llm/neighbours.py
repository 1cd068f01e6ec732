"""Approximate nearest neighbours from low-dimensional stable projections in kd-trees.

Projected by a matrix of standard normal numbers, a squared distance D becomes D times a chi-square variable of m degrees of
freedom. Rows are dealt to the cells of a kd-tree over the projections, fitted on a bounded sample; cells are cut into
blocks of bounded size, each with its own kd-tree. A query takes projected neighbours in order of their distance and verifies them
by their vectors until the test holds: the next projected distance is so large that, by the chi-square distribution, a row nearer than
the k-th best so far would have come before with probability ``confidence``. It begins in its own cell; others are
visited only if the same test does not rule them out.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from trackflow.llm.work import map_rows, ready, staged

DIMENSIONS = 8
CONFIDENCE = 0.98
SEED = 7
#: Rows that fit the upper tree; every row is indexed.
SAMPLE = 8192
BLOCK = 4096
QUERIES = 2048
LEAF = 32


def chi_square_quantile(confidence: float, m: int) -> float:
    """Of the chi-square distribution with an even number of degrees of freedom."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        x = (low + high) / 2
        beyond = math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(m // 2))
        low, high = (x, high) if 1 - beyond < confidence else (low, x)
    return high


@dataclass
class Tree:
    """Nodes of a kd-tree in breadth-first order: where they split, or which rows they hold, and their boxes."""

    low: list[np.ndarray]
    high: list[np.ndarray]
    children: list[tuple[int, int] | None]
    rows: list[np.ndarray]


def grown(points: np.ndarray, leaf: int = LEAF) -> Tree:
    tree, pending = Tree([], [], [], []), [np.arange(len(points))]
    for own in pending:  # grows while it is read
        inside = points[own]
        low, high = inside.min(axis=0), inside.max(axis=0)
        axis = int(np.argmax(high - low))
        tree.low.append(low)
        tree.high.append(high)
        if len(own) <= leaf or high[axis] == low[axis]:
            tree.children.append(None)
            tree.rows.append(own)
            continue
        order = np.argpartition(inside[:, axis], len(own) // 2)
        tree.children.append((len(pending), len(pending) + 1))
        tree.rows.append(own[:0])
        pending += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return tree


def search(tree: Tree, points: np.ndarray, vectors: np.ndarray, ids: np.ndarray, at: np.ndarray, vector: np.ndarray, k: int, bound: float, factor: float) -> list[tuple[float, int]]:
    """The k nearest found, as (distance, id), nearest first; ``bound``: a distance that k rows elsewhere do not exceed."""

    def away(node: int) -> float:
        gap = np.maximum(np.maximum(tree.low[node] - at, at - tree.high[node]), 0)
        return float(gap @ gap)

    best: list[tuple[float, int]] = []
    heap = [(away(0), 0)]
    while heap:
        near, node = heapq.heappop(heap)
        limit = min(bound, best[-1][0]) if len(best) == k else bound
        if near > limit * limit * factor:
            break  # the test holds for all that is left
        if tree.children[node]:
            for child in tree.children[node]:
                heapq.heappush(heap, (away(child), child))
            continue
        rows = tree.rows[node]
        gap = points[rows] - at
        rows = rows[np.einsum("ij,ij->i", gap, gap) <= limit * limit * factor]
        if len(rows):
            gap = vectors[rows] - vector
            found = zip(np.sqrt(np.einsum("ij,ij->i", gap, gap)).tolist(), ids[rows].tolist(), strict=True)
            best = sorted([*best, *found])[:k]
    return best


class Cells:
    """An upper kd-tree: splits by dimension and value, and the box of every cell."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.splits: list[tuple[int, float]] = []
        m = points.shape[1] if len(points) else 1
        level, boxes = [points], [(np.full(m, -np.inf), np.full(m, np.inf))]
        for _ in range(depth):
            following, inner = [], []
            for own, (low, high) in zip(level, boxes, strict=True):
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if len(own) else 0
                value = float(np.median(own[:, axis])) if len(own) else 0.0
                self.splits.append((axis, value))
                right = own[:, axis] > value if len(own) else np.zeros(0, dtype=bool)
                following += [own[~right], own[right]]
                below, above = high.copy(), low.copy()
                below[axis] = above[axis] = value
                inner += [(low, below), (above, high)]
            level, boxes = following, inner
        self.low, self.high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            axis, value = np.array([self.splits[n][0] for n in node], dtype=np.int64), np.array([self.splits[n][1] for n in node])
            node = 2 * node + 1 + (points[np.arange(len(points)), axis] > value)
        return node - (2**self.depth - 1)

    def away(self, at: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        return np.einsum("ij,ij->i", gap, gap)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank`` from 1, the id, and ``score``, the Euclidean distance in double precision, of up to k rows near each query.

    Both tables hold an id and a vector; a query's own id is no candidate. Rows and queries whose vector is null, zero, of
    another length than most, or holds a null, infinite or NaN number take no part, nor do null ids; ids that repeat with equal
    vectors count once. Ties go to smaller ids. Fewer candidates than k: all. Other columns are not read.
    """
    spark = ready(rows.sparkSession)
    value = F.col(vector_col)
    usable = value.isNotNull() & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    clean = rows.where(usable & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), value.cast("array<double>").alias("vector"))
    asked = queries.where(usable & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), value.cast("array<double>").alias("vector"))
    width = clean.groupBy(F.size("vector").alias("n")).count().agg(F.max_by("n", F.struct("count", "n"))).first()[0] or 0
    clean, asked = (x.where(F.size("vector") == width).distinct() for x in (clean, asked))
    turn = np.random.default_rng(SEED).standard_normal((max(width, 1), dimensions))
    factor = chi_square_quantile(confidence, dimensions)

    # of equal vectors, the k + 1 smallest ids can be among the nearest; the limit is applied map-side as well
    same = Window.partitionBy("vector").orderBy("id")
    few = clean.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).select("id", "vector")
    one = asked.groupBy("vector").agg(F.min("id").alias("query"))

    def project(ids: list, vectors: list) -> list:
        points = np.array(vectors, dtype=np.float64).reshape(-1, max(width, 1)) @ turn
        return [ids, points.tolist(), vectors]

    schema = "id long, point array<double>, vector array<double>"
    points = staged(map_rows(few.select("id", "vector"), project, schema), "points")
    wanted = staged(map_rows(one.select("query", "vector"), project, schema), "queries")
    n = points.count()
    sample = points.orderBy(F.xxhash64("id"), "id").select("point").limit(SAMPLE).collect()  # a bounded sample fits the upper tree
    depth = max(0, min(math.ceil(math.log2(max(n, 1) / block)), int(math.log2(max(len(sample), 16) / 16))))
    cells = Cells(np.array([r[0] for r in sample], dtype=np.float64).reshape(-1, dimensions), depth)

    def cell_of(ids: list, at: list, vectors: list) -> list:
        return [ids, at, vectors, cells.of(np.array(at, dtype=np.float64).reshape(-1, dimensions)).tolist()]

    in_cells = staged(map_rows(points, cell_of, f"{schema}, cell int"), "cells")
    size = {r[0]: r[1] for r in in_cells.groupBy("cell").count().collect()}  # one row of each cell, 512 at most
    found_schema = StructType.fromDDL("query long, id long, score double")
    target = to_arrow_schema(found_schema)

    def compare(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False).astype(bool)
        held, open_ = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
        out: list[tuple[int, int, float]] = []
        if len(held) and len(open_):
            at, vectors, ids = matrix(held["point"], dimensions), matrix(held["vector"], width), held["id"].to_numpy()
            tree = grown(at)
            for query, q_at, q_vector, bound in zip(open_["id"].to_pylist(), matrix(open_["point"], dimensions), matrix(open_["vector"], width), open_["bound"].to_pylist(), strict=True):
                out += [(query, i, d) for d, i in search(tree, at, vectors, ids, q_at, q_vector, k + 1, bound, factor)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else ([], [], []), target, strict=True)], schema=target)

    def met(asks: DataFrame) -> DataFrame:
        """Compare queries (id, point, vector, bound, cell) with all blocks of their cell, both sides in parts of bounded size."""
        parts = {r[0]: -(-r[1] // QUERIES) for r in asks.groupBy("cell").count().collect()}
        plan = spark.createDataFrame([(c, -(-s // block), parts[c]) for c, s in size.items() if c in parts], "cell int, blocks int, parts int")  # a row of each cell
        sides = []
        for df, own, other, asking in ((in_cells.withColumn("bound", F.lit(0.0)), "blocks", "parts", False), (asks, "parts", "blocks", True)):
            dealt = df.join(F.broadcast(plan), "cell").withColumn("mine", F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
            dealt = dealt.withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            b, p = ("theirs", "mine") if asking else ("mine", "theirs")
            sides.append(dealt.select("cell", F.col(b).alias("block"), F.col(p).alias("part"), F.lit(asking).alias("asks"), "id", "point", "vector", "bound"))
        return sides[0].unionByName(sides[1]).groupBy("cell", "block", "part").applyInArrow(compare, found_schema)

    best = Window.partitionBy("query").orderBy("score", "id")
    at_home = map_rows(wanted, cell_of, f"{schema}, cell int").withColumn("bound", F.lit(float("inf")))
    near = met(staged(at_home, "home")).withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).select("query", "id", "score")
    near = staged(near, "near")
    bounds = near.groupBy("query").agg(F.when(F.count("*") > k, F.max("score")).otherwise(float("inf")).alias("bound"))

    def others(ids: list, at: list, vectors: list, bound: list) -> list:
        places = np.array(at, dtype=np.float64).reshape(-1, dimensions)
        home = cells.of(places)
        visit = []
        for p, h, b in zip(places, home, bound, strict=True):
            gap = cells.away(p)
            visit.append([c for c in np.flatnonzero(gap <= b * b * factor).tolist() if c != h])
        return [ids, at, vectors, bound, visit]

    asks = map_rows(wanted.join(bounds.withColumnRenamed("query", "id"), "id", "left").select("id", "point", "vector", F.coalesce("bound", F.lit(float("inf"))).alias("bound")), others, f"{schema}, bound double, visit array<int>")
    asks = staged(asks.select("id", "point", "vector", "bound", F.explode("visit").alias("cell")), "asks")
    every = near.unionByName(met(asks))
    top = staged(every.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).select("query", "id", "score"), "top")
    owners = asked.withColumnRenamed("id", "query_id").join(one, "vector").select("query_id", "query")
    own = Window.partitionBy("query_id").orderBy("score", "id")
    listed = owners.join(top, "query").where("query_id <> id").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return listed.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
