"""Incremental scoring (H5): the every-minute rerun of the reference as a stream.

New Parquet files in ``src`` are scored with a fixed model and appended to
``dst``; the checkpoint remembers which files were done, so each run scores
only new files (``availableNow`` processes what is there and stops).  The
job is stateless (a projection), so no watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modenorm.operators.model import Mixture
from modenorm.operators.score import score
from modenorm.session import scratch_path


def score_stream(spark: SparkSession, src: str, dst: str, model: Mixture, col: str,
                 checkpoint: str | None = None, keep_overflow: bool = False, max_files_per_trigger: int | None = None,
                 wait: bool = True):
    """Score the files of ``src`` that were not scored into ``dst`` before.

    The checkpoint belongs to ``dst``: without one given it is the folder ``<dst>.checkpoint`` beside it, so a
    second call goes on where the first one ended.
    """
    schema = spark.read.parquet(src).schema
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    folder, pattern = _folder_and_filter(spark, src)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    stream = reader.load(folder)
    scored = score(stream, col, model, keep_overflow=keep_overflow)
    query = (scored.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint or dst.rstrip("/") + ".checkpoint")
             .trigger(availableNow=True).start(dst))
    if wait:
        query.awaitTermination()
    return query


def _folder_and_filter(spark: SparkSession, src: str) -> tuple[str, str | None]:
    """A file source watches folders: a single file becomes (its folder, a filter on its name).

    The file system of the path tells which of the two it is, on any store that Spark reads.
    """
    if "*" in src:
        return src, None
    path = spark._jvm.org.apache.hadoop.fs.Path(src.rstrip("/"))
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isFile():
        return path.getParent().toString(), path.getName()
    return src, None


def stream_to_table(spark: SparkSession, src: str, model: Mixture, col: str) -> DataFrame:
    """Run the stream over ``src`` into a fresh folder of the shared checkpoint dir; return it as a table."""
    dst = scratch_path(spark, "stream-out")
    score_stream(spark, src, dst, model, col)
    return spark.read.parquet(dst)
