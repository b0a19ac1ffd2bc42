"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import pickle
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modenorm.session import scratch_path

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names: other columns, whatever their names, are never read."""
    text_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def carried(df: DataFrame, id_col: str, text_col: str, keep) -> tuple[DataFrame, list[str], str]:
    """Id, text and the columns of ``keep``; their names after the text; and their part of a schema.

    A kept column may have any name: id and text are found by place.
    """
    text_batches(df.sparkSession)
    names = [f"keep_{k}" for k in range(len(keep))]
    out = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    *[F.col(c).alias(n) for c, n in zip(keep, names)])
    return out, names, "".join(f", {n} {t}" for n, t in out.dtypes[2:])


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later stages and retries start there."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: rows of an Arrow batch where the session has Spark's default: texts may be long
BATCH_ROWS = 2000
#: bytes of one (its last row may go beyond them)
BATCH_BYTES = 2 << 20


def text_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, unless the session sets their size itself."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def worker_cache(name: str, token, build):
    """What ``build()`` gave for (name, token), kept between the tasks of a Python worker process.

    Functions reach the workers by value, so module globals are new in every task.  One operator's cache is kept
    at a time: the next operator's tasks in the same process drop it.
    """
    state = sys.modules.setdefault("_modenorm_llm_worker", types.ModuleType("_modenorm_llm_worker")).__dict__
    if state.get("key") != (name, token):
        state["key"] = state["value"] = None
        trim()  # what the last operator held, before the next one's is built
        state["value"] = build()
        state["key"] = (name, token)
    return state["value"]


def forget(name: str | None) -> None:
    """Drop what :func:`worker_cache` holds for another operator than ``name``."""
    state = sys.modules.setdefault("_modenorm_llm_worker", types.ModuleType("_modenorm_llm_worker")).__dict__
    if state.get("key") is not None and state["key"][0] != name:
        state["key"] = state["value"] = None
        trim()


def trim() -> None:
    """Give memory that is free inside this worker back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run, cache: str | None = None):
    """``run`` over a task's batches, then :func:`trim`; only the cache that ``run`` uses stays in the worker."""
    def wrapped(batches):
        forget(cache)
        yield from run(batches)
        trim()

    return wrapped


def tidy_group(run):
    """``run`` over a group's table, then :func:`trim`; no other operator's cache stays in the worker."""
    def wrapped(table):
        forget(None)
        out = run(table)
        trim()
        return out

    return wrapped


def share(spark: SparkSession, obj):
    """Broadcast an object of this package; the workers need no copy of the package to :func:`shared` it."""
    from pyspark import cloudpickle

    return spark.sparkContext.broadcast(cloudpickle.dumps(obj))


def shared(broadcast):
    return pickle.loads(broadcast.value)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit key (in place where possible)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def text_slices(batch, column: int, limit: int):
    """``(start, stop, values)`` of consecutive rows whose texts sum to about ``limit`` bytes (a longer one alone).

    Only one slice's values are Python objects at a time.
    """
    col = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False) + 16
    start, acc = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and acc + n > limit:
            yield start, i, col.slice(start, i - start).to_pylist()
            start, acc = i, 0
        acc += n
    if start < len(sizes):
        yield start, len(sizes), col.slice(start).to_pylist()
