"""Check queries for scoring (E1-E8, F6, F8) under the fixed model."""

from __future__ import annotations

from pyspark.sql import functions as F

from modenorm.operators import score as S
from modenorm.plans.catalog import (HEAVY_SQL, d, heavy_events, q6, r6, register, sql_argmax, sql_by_mode,
                                    sql_clip, sql_scores, table)
from modenorm.plans.fixed import fixed_model

M = fixed_model("value")
K = M.k
ALL = list(range(K))


def _mode_sql(x="value", idx=ALL):
    return sql_argmax(sql_scores(x, M, idx), idx)


def _norm_sql(x, mode):
    mean = sql_by_mode(mode, {k: M.means[k] for k in ALL})
    sd4 = sql_by_mode(mode, {k: 4.0 * M.sds[k] for k in ALL})
    return f"(({x}) - {mean}) / {sd4}"


def _probs_sql(x, idx):
    s = sql_scores(x, M, idx)
    best = f"greatest({', '.join(s)})"
    e = [f"exp({si} - {best})" for si in s]
    z = " + ".join(e)
    return [f"({ei}) / ({z})" for ei in e]


@register("e1_assign", f"SELECT event_id, CAST({_mode_sql()} AS INTEGER) AS mode FROM events")
def e1_assign(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    return S.assign_mode(ev, "value", M, out="mode").select("event_id", "mode")


@register("e2_probs", "SELECT event_id, " + ", ".join(
    f"{q6(p)} AS p_{k}" for k, p in zip(ALL, _probs_sql("value", ALL))) + " FROM events")
def e2_probs(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    out = S.mode_probs(ev, "value", M, prefix="p_")
    return out.select("event_id", *[r6(f"p_{k}").alias(f"p_{k}") for k in ALL])


@register("e3_normalize", f"""
SELECT event_id, mode, {q6(_norm_sql('value', 'mode'))} AS norm
FROM (SELECT event_id, value, CAST({_mode_sql()} AS INTEGER) AS mode FROM events) t""")
def e3_normalize(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    out = S.normalize(ev, "value", M, mode_col="mode", out="norm")
    return out.select("event_id", "mode", r6("norm").alias("norm"))


@register("e4_normalize_all", "SELECT event_id, " + ", ".join(
    f"{q6(f'(value - {d(M.means[k])}) / {d(4.0 * M.sds[k])}')} AS z_{k}" for k in ALL) + " FROM events")
def e4_normalize_all(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    out = S.normalize_all(ev, "value", M, prefix="z_")
    return out.select("event_id", *[r6(f"z_{k}").alias(f"z_{k}") for k in ALL])


@register("e5_clip", f"""
SELECT event_id, {q6(sql_clip(_norm_sql('value', 'mode')))} AS value_clipped
FROM (SELECT event_id, value, CAST({_mode_sql()} AS INTEGER) AS mode FROM {HEAVY_SQL} h) t""")
def e5_clip(spark, sf_dir):
    ev = heavy_events(spark, sf_dir).select("event_id", "value")
    out = S.normalize(ev, "value", M, mode_col="mode", out="norm")
    return out.select("event_id", r6(S.clip(F.col("norm"))).alias("value_clipped"))


@register("e6_score", f"""
SELECT event_id, user_id, event_type, {q6('value')} AS value,
       {q6(sql_clip(_norm_sql('value', 'Mode_Assignment')))} AS value_Transformed, Mode_Assignment
FROM (SELECT *, CAST({_mode_sql()} AS INTEGER) AS Mode_Assignment FROM {HEAVY_SQL} h) t""")
def e6_score(spark, sf_dir):
    ev = heavy_events(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    out = S.score(ev, "value", M)
    return out.select("event_id", "user_id", "event_type", r6("value").alias("value"),
                      r6("value_Transformed").alias("value_Transformed"), "Mode_Assignment")
