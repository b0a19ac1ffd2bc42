"""Scans and sinks (inventory A1-A11).

All readers return lazy DataFrames; column projection and filters written
afterwards reach the Parquet scan through Catalyst (``ReadSchema`` /
``PushedFilters``), so reading one column of a wide table reads one column.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stray index columns written by pandas (header "Unnamed: 0")
# and by Spark for a blank CSV header ("_c0").
INDEX_COLUMNS = ("Unnamed: 0", "_c0")
# Missing-value tokens read as null in CSV input.
NA_TOKENS = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "-NaN", "-nan", "#N/A", "n/a")


def _missing(path: str | Sequence[str], err: Exception) -> FileNotFoundError:
    return FileNotFoundError(f"no input found at {path!r}: {err}")


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A1: Parquet directory, file or glob (or a list of them)."""
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        raise FileNotFoundError("no input paths given")
    try:
        return spark.read.parquet(*paths)
    except AnalysisException as err:  # PATH_NOT_FOUND, UNABLE_TO_INFER_SCHEMA
        raise _missing(path, err) from err


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             na_values: Iterable[str] = NA_TOKENS, integers_as_double: bool = True) -> DataFrame:
    """A2: CSV with header; NA tokens become null; integers read as double.

    The file is read as strings and NA tokens are nulled, with or without a
    schema.  With one, each column is cast to its type (a value that does not
    parse becomes null); columns are matched by place, as Spark's reader does.
    Without one (no inference pass over the data), a column is cast to double
    when every non-null value parses as a number.  That check is one aggregate
    pass, not a driver-side loop.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    try:
        if schema is not None:
            fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
            text = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in fields])).csv(paths)
            tokens = list(na_values)
            return drop_index_cols(text.select([
                F.when(~F.trim(F.col(f"`{f.name}`")).isin(tokens), F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name)
                for f in fields]))
        raw = reader.option("inferSchema", "false").csv(paths)
    except AnalysisException as err:
        raise _missing(path, err) from err
    raw = drop_index_cols(raw)
    tokens = list(na_values)
    nulled = raw.select([
        F.when(F.trim(F.col(f"`{c}`")).isin(tokens), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
        for c in raw.columns
    ])
    # One pass: for every column, count non-null values that do not parse as double.
    probes = [
        F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull()).alias(c)
        for c in nulled.columns
    ]
    if not probes:
        return nulled
    bad = nulled.agg(*probes).first().asDict()
    out = []
    for c in nulled.columns:
        if bad[c] == 0 and integers_as_double:
            out.append(F.col(f"`{c}`").cast("double").alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return nulled.select(out)


def drop_index_cols(df: DataFrame, names: Iterable[str] = INDEX_COLUMNS) -> DataFrame:
    """A3: drop a stray index column if present."""
    present = [c for c in names if c in df.columns]
    return df.drop(*present) if present else df


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """A5: column projection (pruned down to the scan by Catalyst)."""
    return df.select(*cols)


def first_files(spark: SparkSession, df: DataFrame, k: int) -> DataFrame:
    """Restrict a file-based DataFrame to its first ``k`` files by name.

    ``inputFiles`` lists paths from the catalog metadata (no data is read).
    """
    files = sorted(map(unquote, df.inputFiles()))[: max(k, 0)]
    if not files:
        raise FileNotFoundError("no input files")
    return spark.read.parquet(*files)


def source_name(df: DataFrame) -> Column:
    """Each row's input file by its path below the inputs' common folder, folders joined by ``__``.

    A file's name alone where all inputs lie in one folder; files of equal name in different folders differ.
    The folder comes from the paths the scan has listed already.
    """
    folders = [f.rsplit("/", 1)[0].split("/") for f in df.inputFiles()]
    common = list(folders[0]) if folders else []
    for f in folders[1:]:
        while common != f[:len(common)]:
            common.pop()
    depth = len([c for c in common if c]) - bool(common and common[0].endswith(":"))
    path = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), "^[a-zA-Z0-9+.-]+:", ""), F.lit("+"), F.lit("%2B")))
    parts = F.filter(F.split(path, "/"), lambda c: c != "")
    return F.array_join(F.slice(parts, depth + 1, F.size(parts)), "__")


def list_sources(df: DataFrame) -> DataFrame:
    """Input files and their row counts (one aggregate, no data to the driver)."""
    return df.select(source_name(df).alias("file_name")).groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"))


# Size-targeted partitions (the reference's size).
PARTITION_BYTES = 50 * 1024 * 1024


def set_partition_bytes(spark: SparkSession, nbytes: int = PARTITION_BYTES) -> None:
    """Size-targeted input partitions.

    Applies to file scans; after a shuffle AQE coalesces to the advisory size.
    Exchanges with a partition number of their own take it from :func:`sized_partitions`.
    """
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(int(nbytes)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(int(nbytes)))


def row_bytes(df: DataFrame) -> Column:
    """About the bytes a row takes in an exchange: 8 a column, and what strings, binaries and lists hold."""
    def held(c: Column, t: T.DataType) -> Column | None:
        if isinstance(t, (T.StringType, T.BinaryType)):
            return F.octet_length(c)
        if isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.StringType, T.BinaryType)):
            return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + 8 + F.coalesce(F.octet_length(x), F.lit(0)))
        if isinstance(t, (T.ArrayType, T.MapType)):
            return F.size(c) * (16 if isinstance(t, T.MapType) else 8)
        return None

    parts = [held(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]
    total = F.lit(8 * (1 + len(parts))).cast("long")
    for p in parts:
        if p is not None:
            total = total + F.coalesce(p, F.lit(0))
    return total


def sized_partitions(df: DataFrame, nbytes: int | None = None, held: Column | None = None) -> int:
    """Partition number for an exchange of ``df`` whose partitions hold about ``nbytes``.

    Measured by one aggregate over the rows (of ``held``, a row's bytes, if given).  At least the session's number of shuffle partitions.
    """
    total = df.agg(F.sum(row_bytes(df) if held is None else held)).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(total / (nbytes or PARTITION_BYTES)))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy",
                partition_by: Sequence[str] | None = None, max_records_per_file: int | None = None) -> None:
    """Parquet sink, snappy, no index column."""
    w = df.write.mode(mode).option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_chunks(df: DataFrame, path: str, chunk_col: str = "chunk", mode: str = "overwrite",
                 max_records_per_file: int | None = None) -> None:
    """One output folder per chunk (``chunk=<i>``), files capped by record count.

    Tasks keep a writer open for each chunk they meet (up to ``OPEN_WRITERS``,
    beyond that Spark sorts the task's rows), so rows are neither shuffled nor
    sorted; rows of a chunk generated in different tasks simply land in
    several files of the same folder.
    """
    with _open_writers(df.sparkSession):
        write_table(df, path, mode=mode, partition_by=[chunk_col], max_records_per_file=max_records_per_file)


# Files a write task keeps open before it falls back to sorting by folder.
OPEN_WRITERS = 64


@contextmanager
def _settings(spark: SparkSession, values: dict[str, int]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _open_writers(spark: SparkSession):
    return _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_WRITERS})


# Above any input file's size: a file is not cut, and no two share a scan task.
WHOLE_FILE = 1 << 42


def _whole_files(spark: SparkSession):
    """Scans with one task for each input file."""
    return _settings(spark, {"spark.sql.files.maxPartitionBytes": WHOLE_FILE, "spark.sql.files.openCostInBytes": WHOLE_FILE})


def write_per_source(df: DataFrame, path: str, prefix: str = "transformed_", mode: str = "overwrite") -> None:
    """A10: one output folder per input file, named ``source_file=<prefix><name>`` (see :func:`source_name`)."""
    tagged = df.withColumn("source_file", F.concat(F.lit(prefix), source_name(df)))
    with _open_writers(df.sparkSession):
        write_table(tagged, path, mode=mode, partition_by=["source_file"])


# --------------------------------------------------------------------------- named files
def write_named(df: DataFrame, path: str, name: Column, mode: str = "overwrite", compression: str = "snappy",
                by_file: bool = False) -> list[str]:
    """Parquet files of given names: all rows with one ``name`` (a string column) go to ``path/<name>``.

    Rows are dealt by name, so that a name is one task and one file.  With ``by_file`` a name's rows come from one
    input file: the task that scans the file writes them without an exchange, and they are only dealt where ``df``
    reads a file in several tasks (a join, a union with itself).  The files are written to a staging folder
    beside ``path`` and renamed there; only when all have their names does the folder become ``path``, in one
    rename.  A job that fails leaves ``path`` as it was.  Returns the names.
    """
    if mode not in ("overwrite", "error"):
        raise ValueError("mode is overwrite or error")
    spark, target = df.sparkSession, path.rstrip("/")
    staging = f"{target}.staging-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(staging)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    final = hadoop.Path(target)
    if mode == "error" and fs.exists(final):
        raise FileExistsError(target)
    try:
        named = df.withColumn("__name", name)

        def parts_of(folder) -> list:
            return [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]

        def folders() -> list:
            return [s for s in fs.listStatus(at) if s.isDirectory()]

        if by_file:
            with _open_writers(spark), _whole_files(spark):
                write_table(named, staging, compression=compression, partition_by=["__name"])
        if not by_file or any(len(parts_of(folder)) > 1 for folder in folders()):
            with _open_writers(spark):
                write_table(named.repartition(F.col("__name")), staging, compression=compression, partition_by=["__name"])
        names = []
        for folder in folders():
            own = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(
                folder.getPath().getName().partition("=")[2])
            parts = parts_of(folder)
            if len(parts) != 1 or not fs.rename(parts[0], hadoop.Path(at, own)):
                raise OSError(f"{own}: {len(parts)} parts, or no rename")
            fs.delete(folder.getPath(), True)
            names.append(own)
        if fs.exists(final):
            fs.delete(final, True)
        fs.mkdirs(final.getParent())
        if not fs.rename(at, final):
            raise OSError(f"{staging} could not become {target}")
        return sorted(names)
    except BaseException:
        fs.delete(at, True)
        raise


def write_chunk_files(df: DataFrame, path: str, chunk_col: str = "chunk", mode: str = "overwrite") -> list[str]:
    """A9 with a file for each chunk: ``chunk_<i>.parquet``."""
    name = F.concat(F.lit("chunk_"), F.col(f"`{chunk_col}`").cast("string"), F.lit(".parquet"))
    return write_named(df.withColumn("__chunk", F.col(f"`{chunk_col}`")).drop(chunk_col).withColumnRenamed("__chunk", chunk_col),
                       path, name, mode)


def write_source_files(df: DataFrame, path: str, prefix: str = "transformed_", mode: str = "overwrite") -> list[str]:
    """A10 with a file for each input file: ``<prefix><name>`` (see :func:`source_name`)."""
    return write_named(df, path, F.concat(F.lit(prefix), source_name(df)), mode, by_file=True)


def balanced(df: DataFrame, min_fraction: float = 0.5) -> tuple[DataFrame, bool]:
    """Spread an under-split input over the cluster's cores.

    A file of one row group scans as one task, and every per-row operator
    after it runs on one core.  When the scan has fewer partitions than
    ``min_fraction`` x default parallelism (planning only, nothing is read),
    the rows are round-robin repartitioned; large inputs (more splits than
    cores) are returned unchanged.  Returns (frame, whether it was spread).
    """
    n = num_partitions(df)
    try:
        par = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext (remote session): leave the input alone
        return df, False
    if n is None or n >= par * min_fraction:
        return df, False
    return df.repartition(par), True


def num_partitions(df: DataFrame) -> int | None:
    """Planned partition count of ``df`` (planning only); None where the RDD view is unavailable."""
    try:
        return df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. a remote session
        return None
