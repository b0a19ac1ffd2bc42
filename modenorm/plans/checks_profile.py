"""Check queries for sources, samples and the profile (A, B, G, X1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from modenorm.functions.rng import keyed_normal, keyed_normal_sql, keyed_uniform, keyed_uniform_sql
from modenorm.operators import profile as P
from modenorm.operators.sampling import head_n, preview, sample_n
from modenorm.plans.catalog import q6, r6, register, table
from modenorm.plans.fixed import SEED
from modenorm.sources.io import list_sources, project

LINEITEM_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax"]
LINEITEM_SQL = ("(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                "nullif(l_discount, 0.0) AS l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem)")


def lineitem_missing(spark, sf_dir):
    """Derived fixture: l_discount with its zeros turned into nulls."""
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("l_discount", F.when(F.col("l_discount") != 0.0, F.col("l_discount")))


def _describe_sql(src: str, cols, section: str | None = None) -> str:
    parts = []
    for c in cols:
        metrics = [("count", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"),
                   ("min", f"CAST(min({c}) AS DOUBLE)"), ("max", f"CAST(max({c}) AS DOUBLE)"),
                   ("25%", f"quantile_cont({c}, 0.25)"), ("50%", f"quantile_cont({c}, 0.5)"),
                   ("75%", f"quantile_cont({c}, 0.75)")]
        for m, e in metrics:
            sec = f"'{section}' AS section, " if section else ""
            parts.append(f"SELECT {sec}'{c}' AS \"column\", '{m}' AS metric, {q6(f'CAST({e} AS DOUBLE)')} AS value FROM {src} t")
    return "\nUNION ALL ".join(parts)


def _round_value(df):
    return df.withColumn("value", r6("value"))


# ------------------------------------------------------------------ A
@register("a5_project", "SELECT event_id, value FROM events")
def a5_project(spark, sf_dir):
    return project(table(spark, sf_dir, "events"), "event_id", "value")


@register("a11_sources", "SELECT 'events.parquet' AS file_name, count(*) AS rows FROM events")
def a11_sources(spark, sf_dir):
    return list_sources(table(spark, sf_dir, "events"))


# ------------------------------------------------------------------ X1
@register("x1_keyed", f"""
SELECT event_id, {q6(keyed_uniform_sql('event_id', SEED))} AS u, {q6(keyed_normal_sql('event_id', SEED))} AS z
FROM events""")
def x1_keyed(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id")
    return ev.select("event_id", r6(keyed_uniform("event_id", SEED)).alias("u"),
                     r6(keyed_normal("event_id", SEED)).alias("z"))


# ------------------------------------------------------------------ B
@register("b1_sample_n", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY {keyed_uniform_sql('o_orderkey', SEED)}, o_orderkey LIMIT 10000""")
def b1_sample_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sample_n(orders, 10000, SEED, key="o_orderkey")


@register("b2_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10000")
def b2_head(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return head_n(orders, 10000, order_by="o_orderkey")


@register("b3_preview", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 5")
def b3_preview(spark, sf_dir):
    return preview(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", 5)


# ------------------------------------------------------------------ G
@register("g1_count", "SELECT count(*) AS rows FROM lineitem")
def g1_count(spark, sf_dir):
    return P.row_count(table(spark, sf_dir, "lineitem"))


@register("g2_describe", _describe_sql(LINEITEM_SQL, LINEITEM_NUM))
def g2_describe(spark, sf_dir):
    return _round_value(P.describe(lineitem_missing(spark, sf_dir), exact=True))


_G3_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("g3_missing", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c in ('l_quantity', 'l_extendedprice', 'l_discount', 'l_tax') else "")
    + f") AS missing FROM {LINEITEM_SQL} t" for c in _G3_COLS))
def g3_missing(spark, sf_dir):
    return P.missing(lineitem_missing(spark, sf_dir))


@register("g4_size", f"""
SELECT CAST(sum(8 + 8 + 8 + 4 + 8 + 8 + 8 + 8 + coalesce(strlen(l_returnflag), 0) + coalesce(strlen(l_linestatus), 0) + 8)
         AS BIGINT) AS bytes,
       {q6("CAST(sum(8 + 8 + 8 + 4 + 8 + 8 + 8 + 8 + coalesce(strlen(l_returnflag), 0) + coalesce(strlen(l_linestatus), 0) + 8) AS DOUBLE) / CAST(1048576.0 AS DOUBLE)")} AS mb
FROM lineitem""")
def g4_size(spark, sf_dir):
    out = P.size_bytes(table(spark, sf_dir, "lineitem"))
    return out.select("bytes", r6("mb").alias("mb"))


_CUST_NUM = ["c_custkey", "c_nationkey", "c_acctbal"]
_CUST_ALL = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_G6_SQL = "\nUNION ALL ".join([
    "SELECT 'rows' AS section, '' AS \"column\", 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM customer",
    "SELECT 'size', '', 'mb', " + q6("CAST(sum(8 + coalesce(strlen(c_name), 0) + 4 + 8 + coalesce(strlen(c_mktsegment), 0)) AS DOUBLE)"
                                     " / CAST(1048576.0 AS DOUBLE)") + " FROM customer",
    *[f"SELECT 'missing', '{c}', 'missing', CAST(count(*) FILTER (WHERE {c} IS NULL"
      + (" OR isnan(c_acctbal)" if c == "c_acctbal" else "") + ") AS DOUBLE) FROM customer" for c in _CUST_ALL],
    _describe_sql("customer", _CUST_NUM, section="describe"),
])


@register("g6_profile", _G6_SQL)
def g6_profile(spark, sf_dir):
    return _round_value(P.profile(table(spark, sf_dir, "customer"), exact=True))
