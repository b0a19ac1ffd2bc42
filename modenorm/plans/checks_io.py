"""Check queries for readers, sinks and whole jobs.

Sinks are checked by writing into a fresh folder of the shared checkpoint
directory and reading the result back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from modenorm.functions.rng import keyed_normal_pair_sql
from modenorm.operators import encode as E
from modenorm.operators.decode import decode
from modenorm.operators.fit import fit_modes
from modenorm.operators.model import LAYOUT_SCHEMA
from modenorm.operators.sampling import head_n
from modenorm.operators.scaleup import replicate, scale_up
from modenorm.operators.score import score
from modenorm.plans.catalog import d, q6, r6, register, table
from modenorm.plans.checks_jobs import _E6_SQL, CHUNK, M, _REPL_SQL, _target
from modenorm.plans.checks_profile import _describe_sql
from modenorm.plans.jobs import encoder_job, per_file_frame, profile_job
from modenorm.session import scratch_path
from modenorm.sources.io import (first_files, list_sources, read_csv, read_table, source_name, write_chunk_files,
                                 write_chunks, write_per_source, write_source_files, write_table)


def _scored_cols(df):
    return df.select("event_id", "user_id", "event_type", r6("value").alias("value"),
                     r6("value_Transformed").alias("value_Transformed"), "Mode_Assignment")


@register("a2_csv", f"""
SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(user_id AS DOUBLE) AS user_id, event_type,
       {q6('value')} AS value FROM events""")
def a2_csv(spark, sf_dir):
    """A2 + A3: CSV with a stray index column; integers come back as double, the index column is dropped."""
    path = scratch_path(spark, "csv")
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("Unnamed: 0"), "event_id", "user_id",
                                               "event_type", "value")
    ev.write.option("header", "true").csv(path)
    back = read_csv(spark, path)
    return back.select("event_id", "user_id", "event_type", r6("value").alias("value"))


@register("a2_csv_schema", f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE {q6('value')} END AS value FROM events""")
def a2_csv_schema(spark, sf_dir):
    """A2 with a schema: NA tokens are null in every column, as without one."""
    path = scratch_path(spark, "csv-schema")
    ev = table(spark, sf_dir, "events").select("event_id", *[
        F.when(F.col("event_id") % m == 0, F.lit(token)).otherwise(F.col(c).cast("string")).alias(c)
        for c, m, token in (("user_id", 3, "NA"), ("event_type", 5, "N/A"), ("value", 7, "NaN"))])
    ev.write.option("header", "true").csv(path)
    back = read_csv(spark, path, schema="event_id long, user_id long, event_type string, value double")
    return back.withColumn("value", r6("value"))


@register("a6_first_files", "SELECT event_id, value FROM events")
def a6_first_files(spark, sf_dir):
    df = read_table(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    return first_files(spark, df, 1).select("event_id", "value")


@register("a8_sink", _E6_SQL)
def a8_sink(spark, sf_dir):
    path = scratch_path(spark, "scored")
    write_table(score(table(spark, sf_dir, "events"), "value", M), path)
    return _scored_cols(spark.read.parquet(path))


@register("a9_chunks", f"""
SELECT r.id // {CHUNK} AS chunk, count(*) AS rows
FROM range(0, (SELECT count(*) FROM lineitem)) r(id) GROUP BY 1""")
def a9_chunks(spark, sf_dir):
    path = scratch_path(spark, "chunks")
    rep = replicate(table(spark, sf_dir, "nation"), _target(spark, sf_dir), CHUNK, order_by=["n_nationkey"])
    write_chunks(rep, path)
    # partition values read back as int: the chunk id is a bigint
    return (spark.read.parquet(path).groupBy(F.col("chunk").cast("long").alias("chunk"))
            .agg(F.count(F.lit(1)).alias("rows")))


@register("a10_per_source", "SELECT 'transformed_events.parquet' AS source_file, count(*) AS rows FROM events")
def a10_per_source(spark, sf_dir):
    path = scratch_path(spark, "per-source")
    write_per_source(score(table(spark, sf_dir, "events"), "value", M), path)
    return spark.read.parquet(path).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


@register("a9_chunk_files", f"""
SELECT 'chunk_' || (r.id // {CHUNK}) || '.parquet' AS file_name, count(*) AS rows
FROM range(0, (SELECT count(*) FROM lineitem)) r(id) GROUP BY 1""")
def a9_chunk_files(spark, sf_dir):
    """A9 as single files with the chunks' names."""
    path = scratch_path(spark, "chunk-files")
    write_chunk_files(replicate(table(spark, sf_dir, "nation"), _target(spark, sf_dir), CHUNK, order_by=["n_nationkey"]), path)
    return list_sources(spark.read.parquet(path))


@register("a10_files", _E6_SQL.replace("SELECT event_id,", "SELECT 'transformed_' || 'events.parquet' AS file_name, event_id,", 1))
def a10_files(spark, sf_dir):
    """A10 as single files with the inputs' names."""
    path = scratch_path(spark, "source-files")
    write_source_files(score(table(spark, sf_dir, "events"), "value", M), path)
    back = spark.read.parquet(path)
    return back.select(source_name(back).alias("file_name"), "event_id", "user_id", "event_type", r6("value").alias("value"),
                       r6("value_Transformed").alias("value_Transformed"), "Mode_Assignment")


_C6_SEED = 42


@register("c6_scale_up", _REPL_SQL + f"""
SELECT id, chunk, {q6(f"n_nationkey + {d(0.01)} * {keyed_normal_pair_sql('id', _C6_SEED, 0)[0]}")} AS n_nationkey,
       {q6(f"n_regionkey + {d(0.01)} * {keyed_normal_pair_sql('id', _C6_SEED, 0)[1]}")} AS n_regionkey, n_name FROM rep""")
def c6_scale_up(spark, sf_dir):
    """CSV base -> drop index column -> replicate -> keyed noise -> one folder per chunk; read back."""
    src, dst = scratch_path(spark, "scale-src"), scratch_path(spark, "scale-dst")
    nation = table(spark, sf_dir, "nation")
    nation.select(F.col("n_nationkey").alias("Unnamed: 0"), "*").write.option("header", "true").csv(src)
    scale_up(spark, src, dst, _target(spark, sf_dir), chunk=CHUNK, seed=_C6_SEED, order_by=["n_nationkey"],
             noise="keyed")
    out = spark.read.parquet(dst)
    return out.select("id", F.col("chunk").cast("long").alias("chunk"), r6("n_nationkey").alias("n_nationkey"),
                      r6("n_regionkey").alias("n_regionkey"), "n_name")


_EV_ALL = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_H3_SQL = "\nUNION ALL ".join([
    "SELECT 'rows' AS section, '' AS \"column\", 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events",
    "SELECT 'size', '', 'mb', " + q6("CAST(sum(8 + 8 + 8 + coalesce(strlen(event_type), 0) + 8 + coalesce(strlen(props), 0)) AS DOUBLE)"
                                     " / CAST(1048576.0 AS DOUBLE)") + " FROM events",
    *[f"SELECT 'missing', '{c}', 'missing', CAST(count(*) FILTER (WHERE {c} IS NULL"
      + (" OR isnan(value)" if c == "value" else "") + ") AS DOUBLE) FROM events" for c in _EV_ALL],
    _describe_sql("events", ["event_id", "user_id", "value"], section="describe"),
])


@register("h3_profile", _H3_SQL)
def h3_profile(spark, sf_dir):
    out = profile_job(spark, f"{sf_dir.rstrip('/')}/events.parquet", exact=True)
    return out.withColumn("value", r6("value"))


def _fixture(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    x = F.when(F.col("event_type") == "signup", F.lit(0.0)).otherwise(F.col("value"))
    return ev.select("event_id", "value", "event_type", x.alias("x"))


_SPECS = [E.ColumnSpec("value"), E.ColumnSpec("x", "mixed", (0.0,)), E.ColumnSpec("event_type", "categorical")]


@register("d3_fit_encoder")
def d3_fit_encoder(spark, sf_dir):
    """Fit every column of the fixture on all its rows (iterative: rows-only); returns the layout."""
    enc = E.fit_encoder(_fixture(spark, sf_dir), _SPECS, key="event_id")
    return spark.createDataFrame(E.layout(enc), LAYOUT_SCHEMA)


@register("h2_encoder")
def h2_encoder(spark, sf_dir):
    """H2: fit -> encode -> decode -> lossless round-trip report (rows-only: the fit is iterative)."""
    _enc, _encoded, report = encoder_job(_fixture(spark, sf_dir), _SPECS, key="event_id", lossless=True)
    return report


@register("h4_per_file")
def h4_per_file(spark, sf_dir):
    """H4: fit on the head of the first file, score every row tagged with its output file (rows-only)."""
    return per_file_frame(spark, f"{sf_dir.rstrip('/')}/events.parquet", "value")


@register("h2_restored", f"""
SELECT event_id, {q6('value')} AS value, event_type,
       {q6("CASE WHEN event_type = 'signup' THEN " + d(0.0) + " ELSE value END")} AS x FROM events""")
def h2_restored(spark, sf_dir):
    """An encoder fitted on all rows, encoded without loss, decoded: the table itself."""
    df = _fixture(spark, sf_dir)
    enc = E.fit_encoder(df, _SPECS, key="event_id", max_iter=10)
    back = decode(E.encode(df, enc, "event_id", keep_overflow=True), enc, "event_id")
    return back.select("event_id", r6("value").alias("value"), "event_type", r6("x").alias("x"))


@register("h4_restored", f"SELECT event_id, {q6('value')} AS value, 'transformed_events.parquet' AS source_file FROM events")
def h4_restored(spark, sf_dir):
    """H4 undone: every row of every file with its value (within the clip) and its output file."""
    from modenorm.operators.score import unscore

    src = f"{sf_dir.rstrip('/')}/events.parquet"
    df = read_table(spark, src)
    head = head_n(first_files(spark, df, 1).select("value", "_metadata"), 100_000).select("value")
    model = fit_modes(head, "value", max_iter=10)
    tagged = score(df, "value", model, keep_overflow=True).withColumn("source_file", F.concat(F.lit("transformed_"), source_name(df)))
    return unscore(tagged, "value", model).select("event_id", r6("value_Restored").alias("value"), "source_file")


@register("a10_two_folders", """
SELECT 'transformed_' || part || '__rows.parquet' AS source_file, count(*) AS rows
FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS part FROM events) GROUP BY 1""")
def a10_two_folders(spark, sf_dir):
    """A10 and A11 over folders that hold files of one name: each is a source of its own."""
    base = scratch_path(spark, "sources")
    hadoop = spark._jvm.org.apache.hadoop.fs
    for part, rest in (("even", 0), ("odd", 1)):
        path = f"{base}/{part}"
        table(spark, sf_dir, "events").where(F.col("event_id") % 2 == rest).coalesce(1).write.parquet(path)
        fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        made = next(s.getPath() for s in fs.listStatus(hadoop.Path(path)) if s.getPath().getName().startswith("part-"))
        fs.rename(made, hadoop.Path(f"{path}/rows.parquet"))
    df = read_table(spark, [f"{base}/even", f"{base}/odd"])
    out = scratch_path(spark, "per-source")
    write_per_source(df, out)
    listed = list_sources(df).select(F.concat(F.lit("transformed_"), "file_name").alias("source_file"), "rows")
    return spark.read.parquet(out).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")).intersect(listed)
