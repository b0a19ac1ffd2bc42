"""Check queries for scale-up, fit statistics, jobs, streaming and the plug-in (C, D1, H, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from modenorm.functions.rng import keyed_normal_pair_sql
from modenorm.operators.fit import Target, fit_modes, pass_statistics, prepare_input, seed_centres
from modenorm.operators.model import model_frame
from modenorm.operators.plugin import NumpyModeScaler, apply_transformer
from modenorm.operators.profile import numeric_columns
from modenorm.operators.score import score, unscore
from modenorm.operators.scaleup import add_noise, chunk_plan, replicate, union_all
from modenorm.plans.catalog import d, q6, r6, register, sql_argmax, sql_by_mode, sql_clip, sql_scores, table
from modenorm.plans.fixed import fixed_model
from modenorm.session import scratch_path
from modenorm.plans.jobs import fit_on_sample, flagship_frame

M = fixed_model("value")
ALL = list(range(M.k))
CHUNK = 7013
NOISE_SEED = 7


def _target(spark, sf_dir) -> int:
    """Scale-up target: as many rows as lineitem (so the work grows with the data)."""
    return table(spark, sf_dir, "lineitem").count()


@register("c2_chunk_plan", f"""
WITH t AS (SELECT count(*) AS n FROM lineitem)
SELECT r.c AS chunk, r.c * {CHUNK} AS start, least(CAST({CHUNK} AS BIGINT), t.n - r.c * {CHUNK}) AS rows
FROM t, range(0, (SELECT (n + {CHUNK - 1}) // {CHUNK} FROM t)) r(c)""")
def c2_chunk_plan(spark, sf_dir):
    return chunk_plan(spark, _target(spark, sf_dir), CHUNK)


_REPL_SQL = f"""
WITH t AS (SELECT count(*) AS n FROM lineitem),
b AS (SELECT *, row_number() OVER (ORDER BY n_nationkey) - 1 AS idx FROM nation),
nb AS (SELECT count(*) AS nb FROM nation),
ids AS (SELECT r.id, r.id // {CHUNK} AS chunk, r.id % {CHUNK} AS pos FROM range(0, (SELECT n FROM t)) r(id)),
rep AS (SELECT ids.id, ids.chunk, ids.pos, b.n_nationkey, b.n_name, b.n_regionkey
        FROM ids, nb, b WHERE b.idx = ids.pos % nb.nb)
"""


@register("c3_replicate", _REPL_SQL + "SELECT id, chunk, pos, n_nationkey, n_name, n_regionkey FROM rep")
def c3_replicate(spark, sf_dir):
    return replicate(table(spark, sf_dir, "nation"), _target(spark, sf_dir), CHUNK, order_by=["n_nationkey"])


@register("c3_file_order", f"""
WITH t AS (SELECT count(*) AS n FROM lineitem), b AS (SELECT count(*) AS nb FROM events)
SELECT e.event_id, e.value, (n // {CHUNK}) * ({CHUNK} // nb + CASE WHEN {CHUNK} % nb > e.i THEN 1 ELSE 0 END)
       + (n % {CHUNK}) // nb + CASE WHEN (n % {CHUNK}) % nb > e.i THEN 1 ELSE 0 END AS copies
FROM (SELECT event_id, value, row_number() OVER (ORDER BY file_row_number) - 1 AS i
      FROM (SELECT *, row_number() OVER () AS file_row_number FROM events)) e, t, b
WHERE copies > 0""")
def c3_file_order(spark, sf_dir):
    """C3 over a base in file order: how often each base row comes back."""
    rep = replicate(table(spark, sf_dir, "events").select("event_id", "value"), _target(spark, sf_dir), CHUNK, strategy="explode")
    return rep.groupBy("event_id", "value").agg(F.count(F.lit(1)).alias("copies"))


@register("c4_noise", _REPL_SQL + f"""
SELECT id, {q6(f"n_nationkey + {d(0.01)} * {keyed_normal_pair_sql('id', NOISE_SEED, 0)[0]}")} AS n_nationkey,
       {q6(f"n_regionkey + {d(0.01)} * {keyed_normal_pair_sql('id', NOISE_SEED, 0)[1]}")} AS n_regionkey, n_name FROM rep""")
def c4_noise(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    rep = replicate(nation, _target(spark, sf_dir), CHUNK, order_by=["n_nationkey"])
    num = numeric_columns(nation)
    noisy = add_noise(rep, num, sd=0.01, seed=NOISE_SEED, key="id")
    return noisy.select("id", *[r6(c).alias(c) for c in num], "n_name")


@register("c5_union", """
SELECT event_id AS id, value FROM events UNION ALL SELECT o_orderkey AS id, o_totalprice AS value FROM orders""")
def c5_union(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "value")
    od = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"))
    return union_all([ev, od])


def _suff_sql():
    s = sql_scores("value", M, ALL)
    best = f"greatest({', '.join(f's{k}' for k in ALL)})"
    lz = f"best + ln({' + '.join(f'exp(s{k} - best)' for k in ALL)})"
    parts = [f"SELECT {k} AS mode, {q6(f'sum(r{k})')} AS n, {q6(f'sum(r{k} * value) / sum(r{k})')} AS mean, "
             f"{q6(f'sum(r{k} * value * value) / sum(r{k})')} AS meansq FROM r" for k in ALL]
    return (f"WITH s AS (SELECT value, {', '.join(f'{x} AS s{k}' for k, x in enumerate(s))} FROM events), "
            f"b AS (SELECT *, {best} AS best FROM s), l AS (SELECT *, {lz} AS lz FROM b), "
            f"r AS (SELECT value, {', '.join(f'exp(s{k} - lz) AS r{k}' for k in ALL)} FROM l)\n"
            + "\nUNION ALL ".join(parts))


@register("d1_suffstats", _suff_sql())
def d1_suffstats(spark, sf_dir):
    """One pass of the fit's own E-step code under the fixed model (uncentred sums)."""
    out = pass_statistics(table(spark, sf_dir, "events"), "value", M, center=0.0)
    return out.select("mode", r6("n").alias("n"), r6(F.col("s") / F.col("n")).alias("mean"),
                      r6(F.col("q") / F.col("n")).alias("meansq"))


@register("d1_fit")
def d1_fit(spark, sf_dir):
    """D1 on the whole events.value column (no SQL twin: iterative)."""
    model = fit_modes(table(spark, sf_dir, "events"), "value")
    return model_frame(spark, [model])


_PASSES = 2


def _digamma_sql(x: str) -> str:
    """Digamma as its asymptotic series twelve steps up."""
    y = f"(({x}) + 12)"
    steps = " + ".join(f"1 / (({x}) + {i})" for i in range(12))
    return (f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6)"
            f" + 1 / (240 * {y} ** 8) - ({steps}))")


def _passes_sql() -> str:
    """Seeding counts at the fixed model's means, the update, and ``_PASSES`` passes, from the published equations."""
    seeds = sorted(M.means)
    mids = [(a + b) / 2 for a, b in zip(seeds, seeds[1:])]
    label = " + ".join(f"CASE WHEN x > {d(m)} THEN 1 ELSE 0 END" for m in mids)
    ctes = [f"rows AS (SELECT CAST(value AS DOUBLE) AS x FROM events WHERE value IS NOT NULL AND isfinite(value))",
            "stats AS (SELECT avg(x) AS m0, var_samp(x) AS c0 FROM rows)",
            f"hard AS (SELECT {label} AS j, x - m0 AS xc FROM rows, stats)",
            "h0 AS (SELECT j, CAST(count(*) AS DOUBLE) AS n, sum(xc) AS s, sum(xc * xc) AS q FROM hard GROUP BY j)",
            f"slots AS (SELECT CAST(range AS INTEGER) AS j FROM range(0, {M.k}))",
            "full0 AS (SELECT slots.j, coalesce(n, 0) AS n, coalesce(s, 0) AS s, coalesce(q, 0) AS q "
            "FROM slots LEFT JOIN h0 USING (j))",
            "sums0 AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, j) - 1 AS INTEGER) AS k, n, s, q FROM full0)"]
    for i in range(_PASSES + 1):
        ctes += [
            f"u{i} AS (SELECT k, n + {d(2.220446049250313e-15)} AS nk, s, q, "
            f"coalesce(sum(n + {d(2.220446049250313e-15)}) OVER (ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) "
            f"AS tail FROM sums{i})",
            f"v{i} AS (SELECT k, 1 + nk AS beta, s / nk AS xb, nk, 1 + nk AS a, {d(0.001)} + tail AS b, "
            f"greatest(q / nk - (s / nk) * (s / nk), 0) + {d(1e-6)} AS sk FROM u{i})",
            f"p{i} AS (SELECT k, a, b, beta, m0 + nk * xb / beta AS mean, "
            f"(c0 + nk * sk + nk / beta * xb * xb) / beta AS var FROM v{i}, stats)",
            f"o{i} AS (SELECT *, {_digamma_sql('a')} - {_digamma_sql('a + b')} + coalesce(sum({_digamma_sql('b')} - "
            f"{_digamma_sql('a + b')}) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lw FROM p{i})",
            f"f{i} AS (SELECT k, a, b, mean, var, lw - 0.5 * ln(2 * pi()) - 0.5 * ln(var) - 0.5 * ln(beta) + 0.5 * (ln(2) + "
            f"{_digamma_sql('0.5 * beta')} - 1 / beta) AS off FROM o{i})"]
        if i < _PASSES:
            ctes += [
                f"sc{i} AS (SELECT r.i, r.x, k, off - 0.5 * (x - mean) * (x - mean) / var AS score "
                f"FROM (SELECT row_number() OVER () AS i, x FROM rows) r, f{i})",
                f"e{i} AS (SELECT i, x, k, exp(score - max(score) OVER (PARTITION BY i)) AS e FROM sc{i})",
                f"r{i} AS (SELECT x, k, e / sum(e) OVER (PARTITION BY i) AS r FROM e{i})",
                f"sums{i + 1} AS (SELECT k, sum(r) AS n, sum(r * (x - m0)) AS s, sum(r * (x - m0) * (x - m0)) AS q "
                f"FROM r{i}, stats GROUP BY k)"]
    return ("WITH " + ",\n".join(ctes)
            + f"\nSELECT k AS mode, {q6('mean')} AS mean, {q6('sqrt(var)')} AS sd, {q6('off')} AS log_offset FROM f{_PASSES}")


@register("d1_passes", _passes_sql())
def d1_passes(spark, sf_dir):
    """Seeding from given centres, update and two passes of the fit itself against the equations in SQL."""
    model = fit_modes(table(spark, sf_dir, "events"), "value", max_iter=_PASSES, tol=0.0, centres=sorted(M.means))
    return model_frame(spark, [model]).select("mode", r6("mean").alias("mean"), r6("sd").alias("sd"),
                                              r6("offset").alias("log_offset"))


def _seed_sql() -> str:
    return f"SELECT CAST({M.k} AS INTEGER) AS centres, TRUE AS settled, TRUE AS ordered, CAST(count(value) AS BIGINT) AS rows, {q6('avg(value)')} AS mean, {q6('stddev_samp(value)')} AS sd FROM events WHERE isfinite(value)"


@register("d10_seeding", _seed_sql())
def d10_seeding(spark, sf_dir):
    """Rows, mean and sd put together from the exact bin moments; the centres are a fixed point of k-means over
    all rows (one more step moves none by more than 0.005 sd), in order."""
    ev = table(spark, sf_dir, "events").select("value")
    inp = prepare_input(ev, [Target("value", F.col("value"))])
    try:
        centres, info = seed_centres(inp, M.k)
    finally:
        inp.unpersist()
    st, c = inp.stats[0], centres[0]
    near = F.array_min(F.transform(F.array(*map(F.lit, c)), lambda m: F.struct(F.abs(F.col("value") - m).alias("d"), m.alias("c"))))
    moved = ev.where("value IS NOT NULL AND abs(value) < double('infinity')").groupBy(near["c"].alias("c")).agg(F.avg("value").alias("m"))
    far = moved.agg(F.max(F.abs(F.col("m") - F.col("c"))).alias("far"), F.count("*").alias("n"))
    sd = st.var ** 0.5
    return far.select(F.col("n").cast("int").alias("centres"), (F.lit(info[0]["seed_settled"]) & (F.col("far") <= 0.005 * sd)).alias("settled"),
                      F.lit(c == sorted(c)).alias("ordered"), F.lit(int(st.n)).cast("long").alias("rows"),
                      r6(F.lit(st.mean)).alias("mean"), r6(F.lit(sd)).alias("sd"))


@register("h1_flagship")
def h1_flagship(spark, sf_dir):
    """H1: seeded 10,000-row sample -> fit -> score every events row (no SQL twin: the fit is iterative)."""
    return flagship_frame(spark, sf_dir)


@register("h1_restored", f"SELECT event_id, user_id, event_type, {q6('value')} AS value FROM events")
def h1_restored(spark, sf_dir):
    """H1 with overflow kept, undone: every row comes back with its value under the fitted modes."""
    ev = table(spark, sf_dir, "events")
    model = fit_on_sample(ev, "value", key="event_id", max_iter=20)
    back = unscore(score(ev, "value", model, keep_overflow=True), "value", model)
    return back.select("event_id", "user_id", "event_type", r6("value_Restored").alias("value"))


_E6_MODE = sql_argmax(sql_scores("value", M, ALL), ALL)
_E6_NORM = (f"(value - {sql_by_mode('m', {k: M.means[k] for k in ALL})}) / "
            f"{sql_by_mode('m', {k: 4.0 * M.sds[k] for k in ALL})}")
_E6_SQL = f"""
SELECT event_id, user_id, event_type, {q6('value')} AS value, {q6(sql_clip(_E6_NORM))} AS value_Transformed,
       m AS Mode_Assignment
FROM (SELECT event_id, user_id, event_type, value, CAST({_E6_MODE} AS INTEGER) AS m FROM events) t"""


@register("h5_stream", _E6_SQL)
def h5_stream(spark, sf_dir):
    from modenorm.streaming.stream import stream_to_table

    out = stream_to_table(spark, f"{sf_dir.rstrip('/')}/events.parquet", M, "value")
    return out.select("event_id", "user_id", "event_type", r6("value").alias("value"),
                      r6("value_Transformed").alias("value_Transformed"), "Mode_Assignment")


@register("h5_two_runs", _E6_SQL)
def h5_two_runs(spark, sf_dir):
    """H5 run twice with its own checkpoint over a growing folder of several files: new files once, none twice."""
    from modenorm.streaming.stream import score_stream

    src, dst = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-out")
    ev = table(spark, sf_dir, "events")
    for rest in (0, 1):
        ev.where(F.col("event_id") % 2 == rest).repartition(3).write.mode("append").parquet(src)
        score_stream(spark, src, dst, M, "value")
    return spark.read.parquet(dst).select("event_id", "user_id", "event_type", r6("value").alias("value"),
                                          r6("value_Transformed").alias("value_Transformed"), "Mode_Assignment")


@register("u1_plugin", _E6_SQL)
def u1_plugin(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    out = apply_transformer(ev, NumpyModeScaler(M), "value")
    return out.select("event_id", "user_id", "event_type", r6("value").alias("value"),
                      r6("value_Transformed").alias("value_Transformed"), "Mode_Assignment")
