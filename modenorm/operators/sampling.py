"""Samples and limits.

``sample_n`` returns exactly ``n`` rows, reproducibly: the rows with the
smallest keyed uniform ``u = h(key, seed)``.  A plain ``orderBy(u).limit(n)``
would merge ``n`` rows from every input partition in one task; instead a
threshold ``tau`` with a wide Chernoff margin keeps about ``n`` candidates
with a pushed-down filter, their count is checked (the result is exact
whenever at least ``n`` survive; otherwise ``tau`` grows), and only the
candidates are ordered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modenorm.functions.rng import uniform

# The reference samples 10,000 rows with seed 42 for the fit.
DEFAULT_SAMPLE_ROWS = 10_000
DEFAULT_SEED = 42


def row_key(df: DataFrame) -> Column:
    """A stable row key for file sources: full file path and row position in the file."""
    return F.concat(F.col("_metadata.file_path"), F.lit(":"), F.col("_metadata.row_index").cast("string"))


def _keys(df: DataFrame, key: str | Sequence[str] | None) -> list[Column]:
    if key is None:
        from pyspark.errors import AnalysisException

        try:
            df.select(F.col("_metadata.row_index")).schema
        except AnalysisException as err:
            raise ValueError("this DataFrame has no file metadata to key rows by: pass key=<unique column>") from err
        return [row_key(df)]
    if isinstance(key, str):
        return [F.col(key)]
    return [F.col(k) for k in key]


def _second_key(df: DataFrame) -> Column:
    """A string for rows without a key: file and row index where the table has them, else a hash of the row."""
    try:
        place = F.concat_ws("\u0001", F.lit("row"), F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
        df.select(place)
        return place
    except AnalysisException:
        # maps have no hash; as text they do
        whole = [F.col(f"`{c}`") if not t.startswith("map") else F.col(f"`{c}`").cast("string") for c, t in df.dtypes]
        return F.concat_ws("\u0001", F.lit("row"), F.xxhash64(*whole).cast("string"))


def sample_n(df: DataFrame, n: int = DEFAULT_SAMPLE_ROWS, seed: int = DEFAULT_SEED,
             key: str | Sequence[str] | None = None, strict: bool = False, total: int | None = None,
             rng: str = "md5") -> DataFrame:
    """B1: exactly ``min(n, rows)`` rows without replacement, a pure function of (key, seed).

    ``key`` must identify rows uniquely (ties in ``u`` are broken by the key).  A row whose key is null draws by a
    second key: its file and place in a file-based table, else a hash of the whole row.
    ``strict=True`` raises when the table has fewer than ``n`` rows.
    ``rng``: ``md5`` (default; reproducible in other engines) or ``hash64``
    (Spark's xxhash64: same guarantees inside Spark, several times cheaper).
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    keys = _keys(df, key)
    key_str = keys[0] if len(keys) == 1 else F.concat_ws("\u0001", *[k.cast("string") for k in keys])
    u = F.coalesce(uniform(key_str, seed, rng), uniform(_second_key(df), seed, rng))
    total = df.count() if total is None else total
    if n > total and strict:
        raise ValueError(f"cannot take a sample of {n} rows from {total}")
    tagged = df.withColumn("__u", u)
    if n >= total:
        return df
    frac = n / total
    # Expected survivors total*tau; a 8-sigma margin makes a retry practically never needed.
    tau = min(1.0, frac + 8.0 * math.sqrt(frac / total) + 16.0 / total)
    from pyspark import StorageLevel

    from modenorm.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    while True:
        # The candidate set is bounded (about n rows): keep it so the scan runs once.
        cand = tagged.where(F.col("__u") < F.lit(tau)).persist(StorageLevel.MEMORY_AND_DISK)
        if tau >= 1.0 or cand.count() >= n:
            break
        cand.unpersist()
        tau = min(1.0, tau * 2.0)
    order = [F.col("__u")] + keys
    # n rows, written to the shared checkpoint folder: later jobs reuse it and lineage is cut.
    out = cand.orderBy(*order).limit(n).drop("__u").checkpoint(eager=True)
    cand.unpersist()
    return out


def head_n(df: DataFrame, n: int, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """B2: the first ``n`` rows by ``order_by`` (default: file order, i.e. file path then row index; nulls first).

    One plan for every size and type: a top-k, which Spark turns into a
    range-partitioned sort when ``n`` is above its own top-k bound.
    """
    if order_by is None:
        cols = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
        # The first n rows in (file, position) order all sit at a position < n inside their file.
        df = df.where(F.col("_metadata.row_index") < F.lit(int(n)))
    else:
        cols = [F.col(c) for c in ([order_by] if isinstance(order_by, str) else order_by)]
    return df.orderBy(*cols).limit(n)


def preview(df: DataFrame, order_by: str | Sequence[str], n: int = 5) -> DataFrame:
    """A few rows in a fixed order."""
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*names).limit(n)
