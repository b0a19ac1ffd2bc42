"""Dataset scale-up: replicate a base table to an exact row count and add noise.

Row ids come from ``spark.range(target)``, split evenly over partitions.
Chunk ``c`` holds ids ``[c*chunk, (c+1)*chunk)`` and restarts at base row 0,
so row ``id`` copies base row ``(id % chunk) % n``.

* Base up to a checked size: broadcast hash join of the ids to the base on
  its dense row index (the base ships once per executor).
* Larger base: no join at all -- every base row fans out to its own ids with
  ``explode(sequence(...))`` (about target/n rows each), a narrow operation.

Noise is a keyed normal of (row id, seed), so re-running a lost task gives
the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from modenorm.functions.rng import hash64_normal_pair, normals_from_digest, pair_digest
from modenorm.operators.ordstats import dense_index, file_index
from modenorm.operators.profile import _bytes_expr, numeric_columns

# Fixed values of the reference's scale-up: 10M rows per chunk, noise sd 0.01.
DEFAULT_CHUNK = 10_000_000
DEFAULT_NOISE_SD = 0.01
# A base is broadcast when both limits hold (checked with one aggregate); a larger one fans out where it lies.
BROADCAST_BASE_ROWS = 100_000
BROADCAST_BASE_BYTES = 32 * 1024 * 1024
ROWS_PER_PARTITION = 2_000_000


def chunk_plan(spark: SparkSession, target: int, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """(chunk, start, rows) for ceil(target / chunk) chunks; the last one may be short."""
    if chunk <= 0:
        raise ValueError("chunk must be positive")
    n_chunks = (int(target) + chunk - 1) // chunk if target > 0 else 0
    c = F.col("id")
    return spark.range(n_chunks).select(
        c.alias("chunk"), (c * F.lit(chunk)).alias("start"),
        F.least(F.lit(chunk).cast("long"), F.lit(int(target)) - c * F.lit(chunk)).alias("rows"))


def _base_size(base: DataFrame) -> tuple[int, int | None]:
    """Rows, and bytes where few enough rows make them matter."""
    n = base.count()
    if n > BROADCAST_BASE_ROWS:
        return n, None
    total = None
    for col in base.columns:
        e = _bytes_expr(base, col)
        total = e if total is None else total + e
    return n, int(base.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0])


def replicate(df: DataFrame, target: int, chunk: int = DEFAULT_CHUNK, order_by: Sequence[str] | None = None,
              partitions: int | None = None, strategy: str = "auto") -> DataFrame:
    """Exactly ``target`` rows ``(id, chunk, pos, <base columns>)``; each chunk restarts at base row 0.

    ``order_by`` fixes which base row is "first".  By default rows keep the order of a Parquet base's files (their
    index is file metadata: no sort, no write); any other base is ordered by all columns.  Both strategies give the same rows:
    ``broadcast`` joins a small base to the new ids, ``explode`` copies each base row in its own task.
    """
    spark = df.sparkSession
    if target < 0 or chunk <= 0:
        raise ValueError("target must be >= 0 and chunk > 0")
    n, nbytes = _base_size(df)
    if n == 0:
        raise ValueError("cannot replicate an empty table")
    cols = [F.col(f"`{c}`") for c in df.columns]
    small = nbytes is not None and nbytes <= BROADCAST_BASE_BYTES
    if strategy == "auto":
        strategy = "broadcast" if small else "explode"
    if strategy == "broadcast" and not small:
        raise ValueError(f"a base of {n} rows and {nbytes} bytes is too large to broadcast")
    base = None if order_by else file_index(df, out="__src")
    if base is None:
        base = dense_index(df, list(order_by) if order_by else list(df.columns), out="__src")
    if strategy == "broadcast":
        # A multiple of the cluster's parallelism, each split at most ROWS_PER_PARTITION rows.
        par = spark.sparkContext.defaultParallelism
        parts = partitions or max(1, par * math.ceil(target / (par * ROWS_PER_PARTITION)))
        ids = spark.range(0, int(target), 1, parts)
        ids = ids.select("id", F.expr(f"id div {int(chunk)}").alias("chunk"),
                         (F.col("id") % F.lit(chunk)).alias("pos"))
        ids = ids.withColumn("__src", F.col("pos") % F.lit(n))
        out = ids.join(F.broadcast(base), on="__src", how="inner")
        return out.select("id", "chunk", "pos", *cols)
    from modenorm.sources.io import balanced

    base, _ = balanced(base)  # a base of one split would fan out in one task
    # explode: base row i appears at pos = i + j*n inside every chunk with i < rows(chunk)
    full, last = divmod(int(target), chunk)
    n_chunks = full + (1 if last else 0)
    c = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long"))).alias("chunk")
    fan = base.select("*", c) if n_chunks > 0 else base.limit(0).withColumn("chunk", F.lit(0).cast("long"))
    rows_c = F.when(F.col("chunk") < F.lit(full), F.lit(chunk)).otherwise(F.lit(last)).cast("long")
    fan = fan.withColumn("__rows", rows_c)
    fan = fan.withColumn("__cnt", F.when(F.col("__src") < F.col("__rows"),
                                         F.expr(f"(__rows - 1 - __src) div {int(n)}") + 1).otherwise(0))
    fan = fan.where(F.col("__cnt") > 0)
    fan = fan.withColumn("__j", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("__cnt") - 1).cast("long"))))
    fan = fan.withColumn("pos", F.col("__src") + F.col("__j") * F.lit(n))
    fan = fan.withColumn("id", F.col("chunk") * F.lit(chunk) + F.col("pos"))
    return fan.select("id", F.col("chunk").cast("long").alias("chunk"), "pos", *cols)


def add_noise(df: DataFrame, cols: Sequence[str], sd: float = DEFAULT_NOISE_SD, seed: int = 42,
              key: str = "id", method: str = "keyed") -> DataFrame:
    """C4: ``col + N(0, sd)`` on every listed column (cast to double).

    ``keyed`` (default): columns 2j and 2j+1 share one md5 of ``key|seed+j``
    (Box-Muller cosine / sine), so draws depend only on (key, seed) -- the
    same under retries, repartitioning and in other engines.  ``hash64``:
    the same pairing on Spark's ``xxhash64(key, seed+j)`` -- equally keyed and
    several times cheaper, but Spark-specific.  ``fast``:
    Spark's ``randn`` (seeded per partition; reproducible only while the
    input partitioning is the same).
    """
    cols = list(cols)
    if not cols:
        return df
    if method == "fast":
        return df.withColumns({c: F.col(f"`{c}`").cast("double") + F.lit(float(sd)) * F.randn(seed + i)
                               for i, c in enumerate(cols)})
    if method == "hash64":
        noise = {}
        for j in range((len(cols) + 1) // 2):
            pair = hash64_normal_pair(F.col(f"`{key}`"), seed, j)
            for t, c in enumerate(cols[2 * j: 2 * j + 2]):
                noise[c] = F.col(f"`{c}`").cast("double") + F.lit(float(sd)) * pair[t]
        return df.withColumns(noise)
    if method != "keyed":
        raise ValueError(f"unknown noise method {method!r}")
    digests = {f"__h{j}": pair_digest(F.col(f"`{key}`"), seed, j) for j in range((len(cols) + 1) // 2)}
    cur = df.withColumns(digests)
    noise = {}
    for j in range((len(cols) + 1) // 2):
        pair = normals_from_digest(F.col(f"__h{j}"))
        for t, c in enumerate(cols[2 * j: 2 * j + 2]):
            noise[c] = F.col(f"`{c}`").cast("double") + F.lit(float(sd)) * pair[t]
    return cur.withColumns(noise).drop(*digests)


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Row concatenation by column name."""
    if not dfs:
        raise ValueError("nothing to concatenate")
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def scale_up(spark: SparkSession, src: str, dst: str, target: int, chunk: int = DEFAULT_CHUNK,
             sd: float = DEFAULT_NOISE_SD, seed: int = 42, exclude: Sequence[str] = (),
             order_by: Sequence[str] | None = None, fmt: str = "csv", noise: str = "hash64", files: bool = False) -> None:
    """Read (CSV or Parquet) -> drop index column -> replicate -> noise -> one folder per chunk (``files``: one
    file ``chunk_<i>.parquet``, written by one task)."""
    from modenorm.sources.io import drop_index_cols, read_csv, read_table, write_chunk_files, write_chunks

    base = read_csv(spark, src) if fmt == "csv" else read_table(spark, src)
    base = drop_index_cols(base)
    num = numeric_columns(base, exclude=exclude)
    rep = replicate(base, target, chunk, order_by=order_by)
    noisy = add_noise(rep, num, sd=sd, seed=seed, key="id", method=noise)
    (write_chunk_files if files else write_chunks)(noisy.drop("pos"), dst, chunk_col="chunk")
