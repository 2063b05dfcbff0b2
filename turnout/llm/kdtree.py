"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are dealt to shards of bounded size by a hash of their id. Each shard's
tree splits at medians of the widest side and keeps tight bounding boxes. A
query walks a tree best-first by the largest inner product a box can hold. The
k-th score found in the query's home shard goes to all other shards as the
starting bound, so most of their boxes are never opened.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from turnout.llm.common import stored, table
from turnout.llm.registry import query

LEAF = 64
EXACT = 2.0 ** 53
FOUND = "query_id long, vec_id long, score long"


class Tree:
    """Median splits over integer points; boxes are tight; leaves hold up to ``LEAF`` points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.arange(len(ids))
        self.low, self.high, self.span, self.kids = [], [], [], []
        stack = [(0, len(ids), -1)]
        while stack:
            start, end, parent = stack.pop()
            node = len(self.span)
            rows = order[start:end]
            low, high = points[rows].min(axis=0), points[rows].max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.span.append((start, end))
            self.kids.append([])
            if parent >= 0:
                self.kids[parent].append(node)
            if end - start > LEAF:
                side = int(np.argmax(high - low)) if len(low) else 0
                middle = (end - start) // 2
                if len(low):
                    order[start:end] = rows[np.argpartition(points[rows, side], middle)]
                stack += [(start, start + middle, node), (start + middle, end, node)]
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.first_id = [int(self.ids[s:e].min()) for s, e in self.span]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product each box can hold, queries x nodes."""
        zero = queries * 0
        return np.maximum(queries, zero) @ self.high.T + np.minimum(queries, zero) @ self.low.T

    def search(self, query_id: int, vector: np.ndarray, bounds: np.ndarray, k: int,
               floor: float) -> list[tuple[int, int]]:
        """Up to k (score, -vec_id), best last; ``floor`` is a score the k-th reaches elsewhere."""
        best: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            limit = max(floor, best[0][0]) if len(best) == k else floor
            if -bound < limit:
                break
            if len(best) == k and -bound == best[0][0] and self.first_id[node] > -best[0][1]:
                continue
            if self.kids[node]:
                for kid in self.kids[node]:
                    if bounds[kid] >= limit:
                        heapq.heappush(queue, (-bounds[kid], kid))
                continue
            start, end = self.span[node]
            scores = self.points[start:end] @ vector
            for at in np.flatnonzero(scores >= limit):
                other = int(self.ids[start + at])
                if other == query_id:
                    continue
                entry = (int(scores[at]), -other)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return best


def _matrix(column: pd.Series) -> np.ndarray:
    """floor(256 x) per component: whole numbers in doubles while products stay exact, else ints."""
    raw = np.floor(256.0 * np.stack([np.asarray(v, dtype=np.float64) for v in column]))
    if raw.size and np.abs(raw).max() ** 2 * raw.shape[1] >= EXACT:
        return np.array([[int(x) for x in row] for row in raw], dtype=object)
    return raw


def _search(k: int):
    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        both = _matrix(pd.concat([points["embedding"], queries["embedding"]]))
        tree = Tree(points["vec_id"].to_numpy(), both[:len(points)])
        vectors = both[len(points):]
        bounds = tree.bounds(vectors)
        out: list[tuple[int, int, int]] = []
        floors = queries["floor"].to_numpy(dtype="float64") if "floor" in queries else None
        for at, query_id in enumerate(queries["vec_id"]):
            floor = -math.inf if floors is None or math.isnan(floors[at]) else floors[at]
            found = tree.search(int(query_id), vectors[at], bounds[at], k, floor)
            for score, other in found:
                if not -2**63 <= score < 2**63:
                    raise OverflowError(f"a score of {score} is beyond 64 bits")
                out.append((int(query_id), -other, score))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192,
          query_rows: int = 1024) -> DataFrame:
    """The ``k`` vectors of highest integer inner product for every query.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``; other columns
    are not read. Null ids, null vectors and vectors with a null or non-finite
    component take no part; vectors only meet vectors of their own length and other
    ids. Rows repeating an id are candidates of their own; queries repeating an id
    get the best of all their rows together. Ties go to the smaller id. A score
    beyond 64 bits is an error. Returns query_id, rank, vec_id, score; an empty
    table gives no rows.

    Every (shard, block of queries) pair is one group of at most about
    ``shard_rows + query_rows`` rows, so memory is bounded at any size.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select("vec_id", "embedding").where(
            "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, "
            "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('infinity'))")

    points = clean(vectors).withColumn("size", F.size("embedding"))
    asked = clean(queries).withColumn("size", F.size("embedding"))
    points, asked = stored(points, "vectors"), stored(asked, "queries")
    shards = max(1, math.ceil(points.count() / shard_rows))
    blocks = max(1, math.ceil(asked.count() / query_rows))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard")
    points = points.select("*", home)

    near = points.groupBy("shard", "size").cogroup(
        asked.select("*", home).groupBy("shard", "size")).applyInPandas(_search(k), FOUND)
    floors = near.groupBy("query_id").agg(
        F.when(F.count("score") >= k, F.min("score")).alias("floor"))
    asked = stored(asked.join(floors, asked.vec_id == floors.query_id, "left").select(
        "vec_id", "embedding", "size", F.col("floor").cast("double")), "bounded-queries")

    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).alias("block")
    spread_points = points.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    spread_asked = asked.select("*", block, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    keys = ["shard", "block", "size"]
    found = spread_points.groupBy(*keys).cogroup(spread_asked.groupBy(*keys)).applyInPandas(_search(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


_SQL = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op6_topk", _SQL)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best for every vector whose id is divisible by 50, against all rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))
