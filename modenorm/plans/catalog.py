"""Registered check queries: one Spark plan and one SQL twin per operator.

Each query reads the driver's tables from ``sf_dir`` (whole tables, no row
caps) and returns a DataFrame whose float outputs are rounded to 6 decimals
so both engines hash the same values.  SQL twins are written independently
in plain SQL (DuckDB dialect); they never call into this package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modenorm.plans.fixed import (HEAVY_TAIL_EVERY, HEAVY_TAIL_FACTOR, MISSING_SENTINEL, MIXED_MODAL,  # noqa: F401
                                  SEED)
from modenorm.sources.io import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# Outputs are rounded to 6 decimals with the same IEEE operations in both engines,
# floor(x * 1e6 + 0.5) / 1e6, so identical inputs give bit-identical outputs
# (the engines' own round() functions disagree at half-way cases).
def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)).cast("double")


def q6(expr: str) -> str:
    return f"(floor(({expr}) * CAST(1000000.0 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1000000.0 AS DOUBLE))"


def d(v: float) -> str:
    """A double literal in SQL."""
    return f"CAST({float(v)!r} AS DOUBLE)"


# ---------------------------------------------------------------- fixtures
def heavy_events(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("value", F.when(F.col("event_id") % HEAVY_TAIL_EVERY == 0,
                                         F.col("value") * F.lit(HEAVY_TAIL_FACTOR)).otherwise(F.col("value")))


HEAVY_SQL = (f"(SELECT event_id, user_id, event_type, CASE WHEN event_id % {HEAVY_TAIL_EVERY} = 0 "
             f"THEN value * {d(HEAVY_TAIL_FACTOR)} ELSE value END AS value FROM events)")


def mixed_events(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    x = (F.when(F.col("event_type") == "signup", F.lit(0.0))
         .when(F.col("event_type") == "error", F.lit(MISSING_SENTINEL)).otherwise(F.col("value")))
    return ev.select("event_id", "event_type", x.alias("x"))


MIXED_SQL = (f"(SELECT event_id, event_type, CASE WHEN event_type = 'signup' THEN {d(0.0)} "
             f"WHEN event_type = 'error' THEN {d(MISSING_SENTINEL)} ELSE value END AS x FROM events)")


# ---------------------------------------------------------------- SQL builders for the twins
def sql_scores(x: str, model, idx) -> list[str]:
    out = []
    for k in idx:
        z = f"(({x}) - {d(model.means[k])}) / {d(model.sds[k])}"
        out.append(f"({d(model.offsets[k])} - {d(0.5)} * (({z}) * ({z})))")
    return out


def sql_argmax(scores: list[str], labels) -> str:
    best = scores[0] if len(scores) == 1 else f"greatest({', '.join(scores)})"
    whens = " ".join(f"WHEN {s} = {best} THEN {lab}" for s, lab in zip(scores, labels))
    return f"CASE {whens} ELSE {labels[-1]} END"


def sql_by_mode(mode: str, values: dict) -> str:
    whens = " ".join(f"WHEN {mode} = {k} THEN {d(v)}" for k, v in values.items())
    return f"CASE {whens} END"


def sql_clip(v: str, lo: float = -0.99, hi: float = 0.99) -> str:
    return f"greatest(least({v}, {d(hi)}), {d(lo)})"
