"""Dense row indexes and exact order statistics without a single-task step.

``row_number()`` over a global (or few-group) window puts every row of a
group in one task.  Instead rows are range-partitioned by (group, order
keys, random tiebreak) -- the tiebreak lets a hot value spread over many
partitions -- sorted within partitions, and checkpointed so partition ids
stay stable.  Per (partition, group) counts (a table of at most
#partitions x #groups rows) give each partition's offset; a row's index is
its offset plus its position inside the partition.

Where any order will do, :func:`file_index` takes it from the files: a row's
place in its file is metadata, and counts by file give the offsets; nothing
is sorted, shuffled or written.

Exact quantiles are selected digit by digit: a double is an order-preserving
64-bit key, and four passes count 16 bits of it each, for all columns and
ranks together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modenorm.session import checkpoint_dir
from modenorm.sources.io import sized_partitions

# Offsets tables up to this many rows are broadcast; beyond it they are shuffle-joined.
BROADCAST_OFFSET_ROWS = 1_000_000


def dense_index(df: DataFrame, order_by: Sequence[str | Column], group_by: Sequence[str] = (),
                out: str = "idx", partitions: int | None = None, seed: int = 42) -> DataFrame:
    """0-based index of each row in ``order_by`` order, restarting per ``group_by`` group.

    Ties in ``order_by`` are broken arbitrarily (give a unique key for a
    deterministic index).  The number of partitions follows the rows' measured
    bytes unless given.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    groups = [F.col(g) for g in group_by]
    n_parts = partitions or sized_partitions(df)
    tb = F.rand(seed)
    s = (df.withColumn("__tb", tb)
         .repartitionByRange(n_parts, *groups, *order, F.col("__tb"))
         .sortWithinPartitions(*groups, *order, F.col("__tb"))
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__mid", F.monotonically_increasing_id()))
    s = s.checkpoint(eager=True)
    keys = ["__pid", *group_by]
    counts = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__mid0"))
    w = Window.partitionBy(*group_by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.withColumn("__off", F.sum("__n").over(w) - F.col("__n")).drop("__n")
    n_off = offsets.count()
    right = F.broadcast(offsets) if n_off <= BROADCAST_OFFSET_ROWS else offsets
    res = s.join(right, on=keys, how="inner")
    res = res.withColumn(out, F.col("__off") + F.col("__mid") - F.col("__mid0"))
    return res.drop("__tb", "__pid", "__mid", "__mid0", "__off")


def file_index(df: DataFrame, out: str = "idx") -> DataFrame | None:
    """0-based index of each row in (file path, row) order; None where ``df`` is no whole scan of Parquet files."""
    names = df.columns
    try:
        rows = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        return None
    files = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"), (F.max("__row") + 1).alias("__last"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    files = files.withColumn("__off", F.sum("__n").over(before) - F.col("__n")).persist()  # a row for each file
    try:
        n_files, gaps = files.agg(F.count(F.lit(1)), F.count_if(F.col("__n") != F.col("__last"))).first()
        if gaps:  # rows were filtered away
            return None
        offsets = files.select("__file", "__off")
        right = F.broadcast(offsets) if n_files <= BROADCAST_OFFSET_ROWS else offsets
        found = rows.join(right, "__file").withColumn(out, F.col("__off") + F.col("__row"))
        return found.select(*[f"`{c}`" for c in names], out)
    finally:
        files.unpersist()


DIGIT = 16          # bits of a key that a pass counts
ROUNDS = 64 // DIGIT


def ordered_keys(x):
    """Order-preserving unsigned 64-bit keys of an array of doubles (no NaN); 0.0 and -0.0 are one value."""
    import numpy as np

    bits = (x + 0.0).view(np.uint64)
    negative = bits >> np.uint64(63) == 1
    return np.where(negative, ~bits, bits | np.uint64(1 << 63))


def key_value(key: int) -> float:
    """The double of an ordered key."""
    import struct

    bits = key ^ (1 << 63) if key >> 63 else ~key & (2 ** 64 - 1)
    return struct.unpack("<d", struct.pack("<Q", bits))[0]


def _digit_counts(df: DataFrame, cols: Sequence[str], prefixes: list[list[int]], done: int) -> DataFrame:
    """``(t, p, digit, n)``: rows of column t whose first ``done`` bits are its p-th prefix, by the next digit."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        total: dict = {}
        rest = np.uint64(64 - done - DIGIT)
        for b in batches:
            for t, own in enumerate(prefixes):
                x = b.column(t).to_numpy(zero_copy_only=False)
                keys = ordered_keys(x[~np.isnan(x)])
                for p, prefix in enumerate(own):
                    part = keys[keys >> np.uint64(64 - done) == np.uint64(prefix)] if done else keys
                    digit, n = np.unique(part >> rest & np.uint64((1 << DIGIT) - 1), return_counts=True)
                    if len(digit):
                        if (t, p) not in total:
                            total[t, p] = np.zeros(1 << DIGIT, np.int64)
                        total[t, p][digit.astype(np.int64)] += n
        for (t, p), n in total.items():
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), t, np.int32)), pa.array(np.full(len(own), p, np.int32)),
                 pa.array(own.astype(np.int32)), pa.array(n[own])], names=["t", "p", "digit", "n"])

    nan = F.lit(float("nan"))
    rows = df.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), nan).alias(f"x{t}") for t, c in enumerate(cols)])
    return (rows.mapInArrow(run, "t int, p int, digit int, n long").groupBy("t", "p", "digit").agg(F.sum("n").alias("n")))


def select_ranks(df: DataFrame, cols: Sequence[str], ranks_of) -> tuple[list[int], dict[tuple[int, int], float]]:
    """Values at the 0-based ranks ``ranks_of(n)`` of every column, and the columns' counts; four passes.

    A pass gives at most 65,536 counts for each (column, wanted prefix); the digit that holds a rank is found where
    the counts are, so only a row for each column and rank comes to the driver.
    """
    spark = df.sparkSession
    counts = [0] * len(cols)
    prefixes: list[list[int]] = [[0] for _ in cols]
    at: dict[tuple[int, int], tuple[int, int]] = {}          # (column, rank) -> (prefix, rank among its rows)
    for r in range(ROUNDS):
        got = _digit_counts(df, cols, prefixes, r * DIGIT)
        by = Window.partitionBy("t", "p").orderBy("digit")
        upto = got.withColumn("upto", F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        if r == 0:
            upto = upto.persist()
            for t, n in upto.groupBy("t").agg(F.max("upto")).collect():
                counts[t] = n
            at = {(t, k): (0, k) for t, n in enumerate(counts) if n for k in ranks_of(n)}
            if not at:
                upto.unpersist()
                return counts, {}
        wanted = spark.createDataFrame([(t, prefixes[t].index(p), k, rest) for (t, k), (p, rest) in at.items()],
                                       "t int, p int, rank long, rest long")
        hit = upto.join(F.broadcast(wanted), ["t", "p"]).where("upto > rest AND upto - n <= rest").select(
            "t", "rank", "digit", (F.col("rest") - F.col("upto") + F.col("n")).alias("rest")).collect()
        if r == 0:
            upto.unpersist()
        at = {(h["t"], h["rank"]): (at[h["t"], h["rank"]][0] << DIGIT | h["digit"], h["rest"]) for h in hit}
        prefixes = [sorted({p for (t, _), (p, _) in at.items() if t == i}) for i in range(len(cols))]
    return counts, {k: key_value(p) for k, (p, _) in at.items()}


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles of several numeric columns (NaN and null ignored).

    Returns (column, p, quantile); a column without values has no rows.
    """
    def ends(n: int, p: float) -> tuple[int, int]:
        return math.floor(p * (n - 1)), math.ceil(p * (n - 1))

    counts, value = select_ranks(df, cols, lambda n: sorted({k for p in probs for k in ends(n, p)})) if cols else ([], {})
    out = []
    for t, (c, n) in enumerate(zip(cols, counts)):
        for p in probs if n else ():
            lo, hi = ends(n, p)
            low = value[t, lo]
            out.append((c, float(p), low + (value[t, hi] - low) * (p * (n - 1) - lo) if hi > lo else low))
    return df.sparkSession.createDataFrame(out, "column string, p double, quantile double")


def exact_quantiles(long_df: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles per group of a long (group, value) table: one column per group value.

    The groups are few (columns of a table, modes of a model): they are
    listed with one distinct aggregate and each becomes a filtered column of
    the same passes.  Returns (group, prob, quantile).
    """
    groups = [r[0] for r in long_df.select(group).distinct().collect()]
    names = [f"g{i}" for i in range(len(groups))]
    wide = long_df.select(*[F.when(F.col(group) == F.lit(g), F.col(value).cast("double")).alias(nm)
                            for g, nm in zip(groups, names)])
    q = column_quantiles(wide, names, probs).collect()
    by_name = dict(zip(names, groups))
    gtype = long_df.schema[group].dataType.simpleString()
    rows = [(by_name[r["column"]], r["p"], r["quantile"]) for r in q]
    return long_df.sparkSession.createDataFrame(rows, f"{group} {gtype}, p double, quantile double")
