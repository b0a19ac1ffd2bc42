"""Nearest neighbours by a block matrix join on int8 tiles.

Every vector is stored as int8 with its scale and the norms needed to bound
the quantisation error.  Queries and candidates are dealt into groups of
bounded size; a tile is one query group against one candidate group.  Inside a
tile the int8 product of a block gives every score with an error bound:

    |q.x - s_q s_x (q8.x8)|  <=  |q^| |x - x^| + |q - q^| |x|      (^ = dequantised)

A pair survives when its upper bound reaches the query's k-th best exact score
so far; survivors are recomputed in double precision from the original
vectors and merged into the query's heap.  The tiles' heaps are merged by a
ranked window.  No survivor is dropped, so the result is exact.

Work is queries times candidates, in blocks; a tile holds at most
``QUERY_GROUP`` and ``CANDIDATE_GROUP`` vectors (groups are numbered by hash, so
sizes are even).  Of equal vectors only the ``k + 1`` smallest ids can be among
the nearest of any query (itself left out), so a ranked window keeps these as
candidates before the join; this bounds the ties a tile can meet.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part (neither query nor candidate); so do null
ids and vectors of another length than the query's.  Ties go to the smaller
id.  Repeated rows count once as candidates by id.  An empty table gives no
rows.  With fewer candidates than ``k`` all are returned.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modenorm.llm.common import staged, tidy_group

QUERY_GROUP = 2048
CANDIDATE_GROUP = 16384
BLOCK = 2048


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norms of what rounding left out."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - q * scale[:, None], axis=1)


class Heaps:
    """The k best (score, smaller id first) of each query of a tile."""

    def __init__(self, n: int, k: int):
        self.k, self.items, self.floor = k, [[] for _ in range(n)], np.full(n, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        for q, s, i in zip(query.tolist(), score.tolist(), ids.tolist()):
            heap, item = self.items[q], (s, -i)
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
            if len(heap) == self.k:
                self.floor[q] = heap[0][0]


def search_tile(qid: np.ndarray, q: np.ndarray, xid: np.ndarray, x: np.ndarray, k: int) -> Heaps:
    """Exact k best of every query row among the candidate rows, through the int8 bounds."""
    heaps = Heaps(len(q), k)
    q8, qs, qe = quantise(q)
    q_hat, q32 = np.linalg.norm(q8 * qs[:, None], axis=1), q8.astype(np.float32)
    for at in range(0, len(x), BLOCK):
        part, ids = x[at:at + BLOCK], xid[at:at + BLOCK]
        x8, xs, xe = quantise(part)
        # products of int8 rows are whole numbers below 2^24, exact in float32, for up to 1,040 dimensions
        dots = q32 @ x8.astype(np.float32).T if q.shape[1] <= 1040 else q8.astype(float) @ x8.astype(float).T
        slack = (q_hat[:, None] * xe[None] + qe[:, None] * np.linalg.norm(part, axis=1)[None]) * (1 + 1e-9) + 1e-12
        estimate = dots * (qs[:, None] * xs[None])
        if not np.isfinite(heaps.floor).all():  # a first floor: the k-th best lower bound within this block
            lower = np.where(qid[:, None] == ids[None], -np.inf, estimate - slack)
            floor = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] >= k else np.full(len(q), -np.inf)
            floor = np.maximum(floor, heaps.floor)
        else:
            floor = heaps.floor
        a, b = np.nonzero((estimate + slack >= floor[:, None]) & (qid[:, None] != ids[None]))
        for i in range(0, len(a), 1 << 16):
            own, other = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
            heaps.add(own, np.cumsum(q[own] * part[other], axis=1)[:, -1], ids[other])
    return heaps


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    ok = F.expr("size(v) > 0 AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = double('infinity')) "
                "AND exists(v, c -> c <> 0)")
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(ok))


def search(df: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           is_query=None) -> DataFrame:
    """The ``k`` rows with the largest inner product for every query row (default: ids divisible by 20)."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    asks = F.expr("vec_id % 20 = 0") if is_query is None else is_query
    copies = Window.partitionBy("v").orderBy("vec_id")
    candidates = staged(spark, rows.dropDuplicates(["vec_id", "v"]).withColumn("c", F.row_number().over(copies))
                        .where(F.col("c") <= k + 1).drop("c"), "ann-candidates")
    queries = rows.where(asks).dropDuplicates(["vec_id", "v"])
    n_candidates, n_queries = candidates.count(), queries.count()
    wide, tall = max(1, -(-n_candidates // CANDIDATE_GROUP)), max(1, -(-n_queries // QUERY_GROUP))

    def dealt(part, side, own, others, tile):
        """Each row once for every group of the other side; the tile is row group times ``tall`` plus query group."""
        return (part.withColumn("own", F.pmod(F.xxhash64("vec_id"), F.lit(own)))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
                .select(F.expr(tile).cast("long").alias("tile"), F.lit(side).alias("side"), "vec_id", "v"))

    pairs = (dealt(candidates, "c", wide, tall, f"own * {tall} + other")
             .unionByName(dealt(queries, "q", tall, wide, f"other * {tall} + own")))

    def run(tile: pa.Table) -> pa.Table:
        side = np.array(tile.column("side").to_pylist())
        ids = tile.column("vec_id").to_numpy()
        vecs = tile.column("v").combine_chunks()
        sizes = np.diff(vecs.offsets.to_numpy())
        flat, starts = vecs.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
        out = []
        for dim in np.unique(sizes):  # vectors of one length only meet each other
            def block(which):
                at = np.flatnonzero((side == which) & (sizes == dim))
                return ids[at], flat[starts[at][:, None] + np.arange(dim)]
            (qid, q), (xid, x) = block("q"), block("c")
            if len(q) and len(x):
                order = np.argsort(xid)
                for i, heap in zip(qid.tolist(), search_tile(qid, q, xid[order], x[order], k).items):
                    out += [(i, -neg, s) for s, neg in heap]
        return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()),
                         "vec_id": pa.array([r[1] for r in out], pa.int64()),
                         "score": pa.array([r[2] for r in out], pa.float64())})

    found = pairs.groupBy("tile").applyInArrow(tidy_group(run), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


SEARCH_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id, list_dot_product(q.v, x.v) AS score
  FROM rows q JOIN rows x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20"""
