"""Sharding by extendible hashing.

A document's shard is the shortest prefix of its hash whose documents fit the
byte limit: the directory starts with one bucket, and only oversized buckets
split on another bit.  A bucket whose documents all have one hash (a single
document, or repeated ids) is never split, however large.

The directory is made in waves.  A wave sums the bytes of cells ``STEP`` bits
finer than the expected shards, folds them level by level, and finds every
leaf: a bucket that fits while its parent doesn't.  Cells still oversized at
the finest level go on alone in the next wave.  Only cells, about ``2 ** STEP``
a shard, are summed and joined, never documents of a bucket in one task.

Defined results: null and empty texts count 0 bytes; a null id hashes as the
empty string; repeated ids share a shard; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import narrow, staged

HASH_BITS = 60
STEP = 3
SHARD_BYTES = 1 << 20


def _prefix(depth) -> str:
    """SQL for the first ``depth`` bits of ``hash``."""
    return f"shiftright(hash, CAST({HASH_BITS} - ({depth}) AS INT))"


def assign(df: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, depth, prefix, shard_bytes`` of every row; (depth, prefix) names the shard."""
    spark = df.sparkSession
    hashed = narrow(df, id_col, text_col).selectExpr(
        "doc_id", "CAST(coalesce(octet_length(text), 0) AS LONG) AS n_bytes",
        "CAST(conv(substring(md5(coalesce(CAST(doc_id AS STRING), '')), 1, 15), 16, 10) AS LONG) AS hash")
    rows = staged(spark, hashed, "shard-hashes")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    done, base = None, 0
    depth = min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + STEP)
    while True:
        cells = rows.groupBy(F.expr(_prefix(depth)).alias("cell")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        levels = (cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(depth))))
                  .withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
                  .groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("shard_bytes"), F.min("low").alias("low"),
                                                  F.max("high").alias("high"))
                  .withColumn("fits", F.expr(f"shard_bytes <= {limit} OR low = high OR depth = {HASH_BITS}")))
        fit = levels.where("fits").select("depth", "prefix", "shard_bytes")
        # a cell's leaf is the shallowest of the fitting buckets above it
        leaves = staged(spark, cells.select("cell", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth"))
                        .withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
                        .join(fit, ["depth", "prefix"]).groupBy("cell")
                        .agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("leaf")), "shard-leaves")
        with_cell = rows.withColumn("cell", F.expr(_prefix(depth)))
        found = with_cell.join(leaves, "cell").select("doc_id", "n_bytes", "leaf.depth", "leaf.prefix", "leaf.shard_bytes")
        done = found if done is None else done.unionByName(found)
        if depth == HASH_BITS:
            return done
        rows = staged(spark, with_cell.join(leaves, "cell", "left_anti").drop("cell"), "shard-oversized")
        if rows.isEmpty():
            return done
        base, depth = depth, min(HASH_BITS, depth + STEP + 5)


def write_shards(df: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the rows as Parquet, a folder ``shard=<bits>`` for each shard."""
    names = assign(df, limit, id_col, text_col).select(
        F.col("doc_id").alias("_id"), F.expr("concat(depth, '-', hex(prefix))").alias("shard")).distinct()
    (df.join(names, F.col(id_col).cast("long").eqNullSafe(names["_id"]), "left").drop("_id")
     .repartition("shard").write.partitionBy("shard").parquet(path))


ASSIGN_SQL = f"""
WITH rows AS (
  SELECT row_number() OVER () AS row_id, doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash FROM documents),
levels AS (
  SELECT rows.*, CAST(d AS INTEGER) AS depth, hash >> ({HASH_BITS} - d) AS prefix
  FROM rows, range(0, {HASH_BITS + 1}) AS r(d)),
summed AS (
  SELECT *, sum(n_bytes) OVER w AS shard_bytes, min(hash) OVER w = max(hash) OVER w AS alone
  FROM levels WINDOW w AS (PARTITION BY depth, prefix)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY depth) AS r FROM summed
  WHERE shard_bytes <= {SHARD_BYTES} OR alone)
SELECT doc_id, n_bytes, depth, prefix, CAST(shard_bytes AS BIGINT) AS shard_bytes FROM ranked WHERE r = 1"""
