"""Dataset profile (G1-G6): counts, missing values, describe statistics, size.

Everything except exact quantiles comes from one aggregate over one scan
(the reference ran four separate computations).  Quantiles are approximate
by default (bounded sketches merged map-side, as the reference's library
does); ``exact=True`` uses the distributed rank selection of
:mod:`modenorm.operators.ordstats`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modenorm.operators.ordstats import column_quantiles
from modenorm.sources.io import balanced

QUANTILES = (0.25, 0.5, 0.75)
DESCRIBE_METRICS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
APPROX_ACCURACY = 10000

# Logical byte width of fixed-size types (strings/binary use their byte length).
TYPE_BYTES = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
    T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns of the schema (every integer and floating width)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def _clean(df: DataFrame, c: str) -> Column:
    """Numeric value as double with NaN turned into null (skipped like a missing value)."""
    x = _q(c).cast("double")
    return F.when(~F.isnan(x), x) if _is_float(df, c) else x


def missing_expr(df: DataFrame, c: str) -> Column:
    cond = _q(c).isNull()
    if _is_float(df, c):
        cond = cond | F.isnan(_q(c))
    return F.count_if(cond)


def _bytes_expr(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(_q(c)), F.lit(0)).cast("long")
    for typ, width in TYPE_BYTES.items():
        if isinstance(dt, typ):
            return F.lit(width).cast("long")
    # nested / other types: length of their JSON text as an estimate
    return F.coalesce(F.octet_length(F.to_json(F.struct(_q(c)))), F.lit(0)).cast("long")


def row_count(df: DataFrame) -> DataFrame:
    """G1."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def missing(df: DataFrame) -> DataFrame:
    """Missing values (null, or NaN for floating columns) per column, long form."""
    wide = df.agg(*[missing_expr(df, c).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return wide.selectExpr(f"stack({len(df.columns)}, {stack}) as (column, missing)")


def size_bytes(df: DataFrame) -> DataFrame:
    """Logical data size in bytes and MB (1024^2)."""
    total = None
    for c in df.columns:
        e = _bytes_expr(df, c)
        total = e if total is None else total + e
    agg = df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("bytes"))
    return agg.withColumn("mb", F.col("bytes") / F.lit(1024.0 * 1024.0))


def _describe_aggs(df: DataFrame, cols: Sequence[str], exact: bool) -> list[Column]:
    aggs = []
    for i, c in enumerate(cols):
        x = _clean(df, c)
        aggs += [F.count(x).cast("double").alias(f"count_{i}"), F.avg(x).alias(f"mean_{i}"),
                 F.stddev_samp(x).alias(f"std_{i}"), F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}")]
        if not exact:
            aggs.append(F.percentile_approx(x, list(QUANTILES), APPROX_ACCURACY).alias(f"q_{i}"))
    return aggs


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Count, mean, std, min, 25%, 50%, 75%, max per numeric column (long form)."""
    cols = numeric_columns(df) if cols is None else list(cols)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column string, metric string, value double")
    src, spread = balanced(df.select(*[_q(c) for c in cols]))
    if exact and spread:
        src = src.persist()
    try:
        wide = src.agg(*_describe_aggs(src, cols, exact))
        parts = []
        for i, c in enumerate(cols):
            parts += [f"'{c}', 'count', count_{i}", f"'{c}', 'mean', mean_{i}", f"'{c}', 'std', std_{i}",
                      f"'{c}', 'min', min_{i}", f"'{c}', 'max', max_{i}"]
            if not exact:
                parts += [f"'{c}', '{int(p * 100)}%', q_{i}[{j}]" for j, p in enumerate(QUANTILES)]
        base = wide.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (column, metric, value)")
        if not exact:
            return base
        q = column_quantiles(src, cols, QUANTILES)
        q = q.select("column", F.concat((F.col("p") * 100).cast("int").cast("string"), F.lit("%")).alias("metric"),
                     F.col("quantile").alias("value"))
        # The report is a few rows per column: materialise it before releasing the spread input.
        return spark.createDataFrame(base.unionByName(q).collect(), "column string, metric string, value double")
    finally:
        if exact and spread:
            src.unpersist()


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Full report as (section, column, metric, value), one aggregate pass (+ quantiles)."""
    spark = df.sparkSession
    cols = numeric_columns(df)
    src, spread = balanced(df)
    if exact and spread:
        src = src.persist()
    try:
        aggs = [F.count(F.lit(1)).cast("double").alias("__rows")]
        total = None
        for c in src.columns:
            e = _bytes_expr(src, c)
            total = e if total is None else total + e
        aggs.append((F.coalesce(F.sum(total), F.lit(0)) / F.lit(1024.0 * 1024.0)).alias("__mb"))
        aggs += [missing_expr(src, c).cast("double").alias(f"miss_{i}") for i, c in enumerate(src.columns)]
        aggs += _describe_aggs(src, cols, exact)
        wide = src.agg(*aggs)
        parts = ["'rows', '', 'rows', __rows", "'size', '', 'mb', __mb"]
        parts += [f"'missing', '{c}', 'missing', miss_{i}" for i, c in enumerate(src.columns)]
        for i, c in enumerate(cols):
            parts += [f"'describe', '{c}', 'count', count_{i}", f"'describe', '{c}', 'mean', mean_{i}",
                      f"'describe', '{c}', 'std', std_{i}", f"'describe', '{c}', 'min', min_{i}",
                      f"'describe', '{c}', 'max', max_{i}"]
            if not exact:
                parts += [f"'describe', '{c}', '{int(p * 100)}%', q_{i}[{j}]" for j, p in enumerate(QUANTILES)]
        base = wide.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) as (section, column, metric, value)")
        if not exact or not cols:
            return base
        q = column_quantiles(src, cols, QUANTILES)
        q = q.select(F.lit("describe").alias("section"), "column",
                     F.concat((F.col("p") * 100).cast("int").cast("string"), F.lit("%")).alias("metric"),
                     F.col("quantile").alias("value"))
        return spark.createDataFrame(base.unionByName(q).collect(),
                                     "section string, column string, metric string, value double")
    finally:
        if exact and spread:
            src.unpersist()
