"""Exact top-k by inner product over KD-trees.

Vectors are dealt to shards of about SHARD_ROWS by median splits of a bounded sample, so a shard is a region;
one with far more rows, such as many equal vectors, is split further by a hash. Each shard has the tight box
of its points. The score of a query against a point in a box is at most the sum of the larger of q * low
and q * high over the dimensions. A query, of a stated set, first searches the shard whose box promises most; its
k-th score then tells which other boxes can still hold a better point, and only to those shards it goes. Within a
shard a KD-tree is searched the same way: median splits along the widest side, each node with its tight box;
nodes are visited from the best bound on, and the search ends when the best bound left is under the k-th
score. A task holds one shard and one part of the queries that reach it.

Defined cases: components become floor(1024 * x); vectors that are null, empty or hold null or
non-finite components, and rows without id, take no part. Of several vectors of one id the smallest
counts. Vectors of different lengths aren't compared. Ties go to the smaller id. Empty tables give
empty results. Scores are exact: float64 where every product sum stays under 2 ** 53, else whole numbers
of Python.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from runlens.session import stage

SHARD_ROWS = 8192
QUERY_BLOCK = 2048
LEAF = 64
SCALE = 1024
#: Vectors of the sample that the borders of shards come from, boxes that a task looks through at once.
SAMPLE, BOXES = 1 << 14, 1 << 12
_SPLITS = 1 << 20  # parts of one region at most


def quantised(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v`` (whole numbers) of the rows that take part, one row per id."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = df.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad)
    scaled = whole.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"))
    return scaled.groupBy("vec_id").agg(F.min("v").alias("v"))


class Tree:
    """Median splits of points into leaves of at most LEAF, or of equal points; boxes of all nodes."""

    def __init__(self, points: np.ndarray):
        self.points, self.order = points, np.arange(len(points))
        low, high, self.span, self.child = [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            own = points[self.order[a:b]]
            lo, hi = own.min(axis=0), own.max(axis=0)
            me = len(self.span)
            low.append(lo), high.append(hi), self.span.append((a, b)), self.child.append([])
            if parent >= 0:
                self.child[parent].append(me)
            side = int((hi - lo).argmax())
            if b - a > LEAF and hi[side] > lo[side]:
                mid = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, side], mid, kind="introselect")]
                todo += [(a + mid, b, me), (a, a + mid, me)]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest score that a point of a node can have: queries by nodes."""
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        return plus @ self.high.T + minus @ self.low.T

    def search(self, query: np.ndarray, bound: np.ndarray, ids: np.ndarray, own: int, k: int, least) -> list[tuple]:
        """(score, -id) of up to k best points with a score of at least ``least``, without ``own``."""
        best: list[tuple] = []
        todo = [(-bound[0], 0)]
        while todo:
            top, node = heapq.heappop(todo)
            floor = best[0][0] if len(best) == k else least
            if floor is not None and -top < floor:
                break
            if self.child[node]:
                for c in self.child[node]:
                    if floor is None or bound[c] >= floor:
                        heapq.heappush(todo, (-bound[c], c))
                continue
            a, b = self.span[node]
            rows = self.order[a:b]
            scores = self.points[rows] @ query
            if floor is not None:
                some = scores >= floor
                rows, scores = rows[some], scores[some]
            if len(rows) > k:
                first = np.lexsort((ids[rows], -scores))[: k + 1]
                rows, scores = rows[first], scores[first]
            for s, i in zip(scores.tolist(), ids[rows].tolist(), strict=True):
                if i != own:
                    (heapq.heappush if len(best) < k else heapq.heappushpop)(best, (s, -i))
        return best


def _searcher(k: int):
    def search(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(queries) and len(vectors):
            points, asked = np.stack(vectors["v"].to_numpy()), np.stack(queries["v"].to_numpy())
            kind = _kind(points, asked)
            tree, ids = Tree(points.astype(kind)), vectors["vec_id"].to_numpy()
            asked = asked.astype(kind)
            for a in range(0, len(asked), 256):
                part = asked[a : a + 256]
                for q, bound, own, least in zip(part, tree.bounds(part), queries["query_id"].iloc[a : a + 256].tolist(), queries["least"].iloc[a : a + 256].tolist(), strict=True):
                    out += [(own, -i, int(s)) for s, i in tree.search(q, bound, ids, own, k, _least(least))]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


class Regions:
    """Median splits of a sample along the widest side into ``n`` regions."""

    def __init__(self, sample: np.ndarray, n: int):
        self.side, self.border, self.child = [], [], []
        self.n = 0
        todo = [(sample.astype(float), n, -1, 0)]
        while todo:
            rows, wanted, parent, branch = todo.pop()
            low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
            side = int((high - low).argmax())
            if wanted == 1 or high[side] <= low[side]:
                at, self.n = -self.n - 1, self.n + 1
            else:
                left = wanted // 2
                border = np.partition(rows[:, side], len(rows) * left // wanted)[len(rows) * left // wanted]
                border = border if border > low[side] else np.nextafter(border, np.inf)
                at = len(self.side)
                self.side.append(side), self.border.append(border), self.child.append([0, 0])
                under = rows[:, side] < border
                todo += [(rows[under], left, at, 0), (rows[~under], wanted - left, at, 1)]
            if parent >= 0:
                self.child[parent][branch] = at

    def of(self, points: np.ndarray) -> np.ndarray:
        if not self.side:
            return np.zeros(len(points), dtype=np.int64)
        side, border, child = np.array(self.side), np.array(self.border), np.array(self.child)
        at, rows = np.zeros(len(points), dtype=np.int64), np.arange(len(points))
        while (open_ := at >= 0).any():
            node = at[open_]
            at[open_] = child[node, (points[rows[open_], side[node]] >= border[node]).astype(int)]
        return -at - 1


def _placed(held: DataFrame, rows: int, shards: int, shard_rows: int) -> DataFrame:
    """``dim``, ``shard``, ``vec_id``, ``v``: each vector's shard."""
    few = held.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, rows // SAMPLE))) == 0).select("dim", "v").collect()
    samples: dict[int, list] = {}
    for r in few:
        samples.setdefault(r.dim, []).append(r.v)
    regions = {d: Regions(np.array(v), max(1, round(shards * len(v) / len(few)))) for d, v in samples.items()}

    def region(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), dtype=np.int64)
        sizes = vectors.map(len).to_numpy()
        for d in np.unique(sizes):
            if d in regions:
                here = np.flatnonzero(sizes == d)
                out[here] = regions[d].of(np.stack(vectors.iloc[here].to_numpy()).astype(float))
        return pd.Series(out)

    found = stage(held.withColumn("region", F.pandas_udf(region, LongType())("v")))
    parts = found.groupBy("dim", "region").agg(F.least(F.ceil(F.count("*") / (2 * shard_rows)), F.lit(_SPLITS)).alias("parts"))
    shard = F.col("region") * _SPLITS + F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))
    return stage(found.join(parts, ["dim", "region"]).select("dim", shard.alias("shard"), "vec_id", "v"))


def _kind(*sides: np.ndarray) -> type:
    """float64 where products of the sides and their sums are exact, else whole numbers of Python."""
    size = float(sides[0].shape[1])
    for x in sides:
        size *= float(np.abs(x.astype(float)).max())
    return np.float64 if size < 2**53 else object


def _boxes(points: DataFrame) -> DataFrame:
    def box(group: pd.DataFrame) -> pd.DataFrame:
        own = np.stack(group["v"].to_numpy())
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "shard": group["shard"].iloc[:1], "low": [own.min(axis=0).tolist()], "high": [own.max(axis=0).tolist()]})

    return points.groupBy("dim", "shard").applyInPandas(box, "dim int, shard long, low array<long>, high array<long>")


def _least(value) -> int | None:
    """The k-th score that is known, or a little less where pandas holds it as a float."""
    return None if value is None or value != value else int(value) - (abs(int(value)) >> 50)


def _reach(queries: DataFrame, boxes: DataFrame, n_boxes: int, blocks: int, best_only: bool) -> DataFrame:
    """``dim``, ``query_id``, ``shard``: boxes that can reach the query's ``least`` score, or (``best_only``) the one that promises most."""
    chunks = max(1, -(-n_boxes // BOXES))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumn("block", deal("query_id", blocks)).withColumn("chunk", every(chunks))
    dealt = boxes.withColumn("chunk", deal("shard", chunks)).withColumn("block", every(blocks))

    def look(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(mine) and len(theirs):
            low, high, q = (np.stack(x.to_numpy()) for x in (theirs["low"], theirs["high"], mine["v"]))
            kind = np.float64 if _kind(low, q) is _kind(high, q) is np.float64 else object
            low, high, q, shard = low.astype(kind).T, high.astype(kind).T, q.astype(kind), theirs["shard"].to_numpy()
            dim, ids, least = int(mine["dim"].iloc[0]), mine["query_id"].tolist(), mine["least"].tolist()
            for a in range(0, len(q), 256):
                part = q[a : a + 256]
                bounds = np.maximum(part, 0) @ high + np.minimum(part, 0) @ low
                for i, row in enumerate(bounds, a):
                    floor = _least(least[i])
                    good = [int(row.argmax())] if best_only else np.flatnonzero(row >= floor) if floor is not None else range(len(row))
                    found += [(dim, ids[i], int(shard[k]), float(row[k])) for k in good]
        return pd.DataFrame(found, columns=["dim", "query_id", "shard", "bound"])

    keys = ["dim", "block", "chunk"]
    reached = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(look, "dim int, query_id long, shard long, bound double")
    if not best_only:
        return reached.select("dim", "query_id", "shard")
    return reached.groupBy("dim", "query_id").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))


def _search(points: DataFrame, targets: DataFrame, queries: DataFrame, k: int, query_block: int) -> DataFrame:
    """Best points of each (query, shard) of ``targets``. Queries of a shard are dealt to parts, and its points go to each part."""
    parts = targets.groupBy("dim", "shard").agg(F.ceil(F.count("*") / query_block).cast("int").alias("parts"))
    # names of their own for the cogroups
    here = points.join(parts, ["dim", "shard"]).select(F.col("dim").alias("dim"), F.col("shard").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("vec_id").alias("vec_id"), F.col("v").alias("v"))
    sent = targets.join(parts, ["dim", "shard"]).select("dim", "shard", F.pmod(F.xxhash64("query_id"), "parts").cast("int").alias("part"), "query_id")
    asked = sent.join(queries.select("query_id", "v", "least"), "query_id")
    keys = ["dim", "shard", "part"]
    return _best(asked.groupBy(*keys).cogroup(here.groupBy(*keys)).applyInPandas(_searcher(k), "query_id long, vec_id long, score long"), k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best other vectors of each row of ``quantised`` that is a query.

    A vector moves once to its shard, and again only for more than ``query_block`` queries that reach it;
    a query moves to the shards that can hold one of its k best. Only k rows per query and shard leave a task.
    """
    held = stage(vectors.withColumn("dim", F.size("v")))
    rows, asked = held.count(), held.where(is_query).count()
    shards, blocks = max(1, -(-rows // shard_rows)), max(1, -(-asked // query_block))
    nothing = F.lit(None).cast("long")
    queries = stage(held.where(is_query).select("dim", F.col("vec_id").alias("query_id"), "v"))
    points = _placed(held, rows, shards, shard_rows)
    boxes = stage(_boxes(points))
    n_boxes = boxes.count()
    home = stage(_reach(queries.withColumn("least", nothing), boxes, n_boxes, blocks, best_only=True))
    first = stage(_search(points, home, queries.withColumn("least", nothing), k, query_block))
    kth = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    known = stage(queries.join(kth, "query_id", "left"))
    others = stage(_reach(known, boxes, n_boxes, blocks, best_only=False).join(home, ["dim", "query_id", "shard"], "left_anti"))
    rest = _search(points, others, known, k, query_block)
    found = first.select("query_id", "vec_id", "score").union(rest.select("query_id", "vec_id", "score"))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
