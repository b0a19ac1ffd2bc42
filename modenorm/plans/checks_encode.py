"""Check queries for fit-side tables, the encoder and the decoder.

The fixture frame holds ``event_id``, ``value`` (continuous), ``x`` (mixed:
signup -> 0, error -> missing sentinel, else value) and ``event_type``
(categorical).  Mixture parameters are the fixed model; kept modes, slot
ranks and categories are derived from the data on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from modenorm.functions.rng import keyed_uniform_sql
from modenorm.operators import encode as E
from modenorm.operators.decode import decode
from modenorm.operators.evaluate import roundtrip_report
from modenorm.operators.fit import mode_counts
from modenorm.operators.model import DEFAULT_EPS, significant_modes
from modenorm.operators.score import kept_probs, sample_mode, unscore, score
from modenorm.plans.catalog import (HEAVY_TAIL_EVERY, HEAVY_TAIL_FACTOR, MISSING_SENTINEL, MIXED_MODAL, SEED, d, q6,
                                    r6, register, sql_argmax, sql_clip, sql_scores, table)
from modenorm.plans.fixed import fixed_model

M = fixed_model("value")
K = M.k
ALL = list(range(K))
SPECS = (E.ColumnSpec("value"), E.ColumnSpec("x", "mixed", MIXED_MODAL), E.ColumnSpec("event_type", "categorical"))
N_MODAL = len(MIXED_MODAL)


def fixture(spark, sf_dir, heavy=False):
    ev = table(spark, sf_dir, "events")
    v = F.col("value")
    if heavy:
        v = F.when(F.col("event_id") % HEAVY_TAIL_EVERY == 0, v * F.lit(HEAVY_TAIL_FACTOR)).otherwise(v)
    x = (F.when(F.col("event_type") == "signup", F.lit(0.0))
         .when(F.col("event_type") == "error", F.lit(MISSING_SENTINEL)).otherwise(v))
    return ev.select("event_id", v.alias("value"), x.alias("x"), "event_type")


def encoder_for(spark, sf_dir, heavy=False):
    df = fixture(spark, sf_dir, heavy)
    models = {"value": fixed_model("value"), "x": fixed_model("x"), "x#all": fixed_model("x", "all")}
    # md5 draws: the form the SQL twin reproduces
    return df, E.fit_encoder(df, SPECS, key="event_id", seed=SEED, models=models, rng="md5")


# ----------------------------------------------------------------------------- SQL twin
def _base_sql(heavy=False):
    v = "value"
    if heavy:
        v = f"CASE WHEN event_id % {HEAVY_TAIL_EVERY} = 0 THEN value * {d(HEAVY_TAIL_FACTOR)} ELSE value END"
    return (f"base AS (SELECT event_id, event_type, v AS value, CASE WHEN event_type = 'signup' THEN {d(0.0)} "
            f"WHEN event_type = 'error' THEN {d(MISSING_SENTINEL)} ELSE v END AS x "
            f"FROM (SELECT event_id, event_type, {v} AS v FROM events) e0)")


def _draw_sql(col: str, seed: int, modal=()):
    """CTEs computing <col>_pos (kept position), <col>_mode, <col>_pre, <col>_val, <col>_raw."""
    s = sql_scores(col, M, ALL)
    hard = sql_argmax(s, ALL)
    notmodal = f"{col} NOT IN ({', '.join(d(v) for v in modal)})" if modal else "TRUE"
    cte = []
    cte.append(f"{col}_hard AS (SELECT CAST({hard} AS INTEGER) AS m, count(*) AS n FROM base WHERE {notmodal} GROUP BY 1)")
    weights = ", ".join(f"({k}, {d(M.weights[k])})" for k in ALL)
    cte.append(f"{col}_w(m, weight) AS (VALUES {weights})")
    cte.append(f"{col}_kept AS (SELECT w.m, (w.weight > {d(DEFAULT_EPS)} AND coalesce(h.n, 0) > 0) AS kept "
               f"FROM {col}_w w LEFT JOIN {col}_hard h ON w.m = h.m)")
    flags = ", ".join(f"max(CASE WHEN m = {k} AND kept THEN 1 ELSE 0 END) = 1 AS k{k}" for k in ALL)
    nk = " + ".join(f"CAST(k{k} AS INTEGER)" for k in ALL)
    cte.append(f"{col}_kf AS (SELECT *, {nk} AS nkept FROM (SELECT {flags} FROM {col}_kept) f)")
    ss = ", ".join(f"{s[k]} AS s{k}" for k in ALL)
    cte.append(f"{col}_s AS (SELECT b.*, {ss} FROM base b)")
    cte.append(f"{col}_b AS (SELECT *, greatest({', '.join(f's{k}' for k in ALL)}) AS best FROM {col}_s)")
    ee = ", ".join(f"exp(s{k} - best) AS e{k}" for k in ALL)
    cte.append(f"{col}_e AS (SELECT *, {ee} FROM {col}_b)")
    cte.append(f"{col}_z AS (SELECT *, {' + '.join(f'e{k}' for k in ALL)} AS z FROM {col}_e)")
    qq = ", ".join(f"CASE WHEN k{k} THEN e{k} / z + {d(1e-6)} ELSE {d(0.0)} END AS q{k}" for k in ALL)
    cte.append(f"{col}_q AS (SELECT t.*, f.*, {qq} FROM {col}_z t, {col}_kf f)")
    cte.append(f"{col}_qz AS (SELECT *, {' + '.join(f'q{k}' for k in ALL)} AS qz FROM {col}_q)")
    cums, parts = [], []
    for k in ALL:
        parts.append(f"q{k} / qz")
        cums.append(f"({' + '.join(parts)}) AS c{k}")
    cte.append(f"{col}_c AS (SELECT *, {', '.join(cums)} FROM {col}_qz)")
    u = keyed_uniform_sql("event_id", seed)
    cte.append(f"{col}_t AS (SELECT *, {u} * c{K - 1} AS tt FROM {col}_c)")
    # position among kept modes and the mode itself
    before = {k: " + ".join([f"CAST(k{j} AS INTEGER)" for j in range(k)]) or "0" for k in ALL}
    whens_m = " ".join(f"WHEN k{k} AND c{k} > tt THEN {k}" for k in ALL)
    lastk = " ".join(f"WHEN k{k} THEN {k}" for k in reversed(ALL))
    cte.append(f"{col}_m AS (SELECT *, CASE {whens_m} ELSE (CASE {lastk} END) END AS dmode FROM {col}_t)")
    pos = " ".join(f"WHEN dmode = {k} THEN {before[k]}" for k in ALL)
    mean = " ".join(f"WHEN dmode = {k} THEN {d(M.means[k])}" for k in ALL)
    sd4 = " ".join(f"WHEN dmode = {k} THEN {d(4.0 * M.sds[k])}" for k in ALL)
    raw = f"({col} - (CASE {mean} END)) / (CASE {sd4} END)"
    if modal:
        idx = " ".join(f"WHEN {col} = {d(v)} THEN {i}" for i, v in enumerate(modal))
        # modal values: nearest mode of the all-values model (the fixed model), sentinel -> 0
        mv = []
        for v in modal:
            if v == MISSING_SENTINEL:
                mv.append(f"WHEN {col} = {d(v)} THEN {d(0.0)}")
            else:
                dist = [f"abs({d(v)} - {d(m)})" for m in M.means]
                near = sql_argmax([f"(-{x})" for x in dist], ALL)
                mm = " ".join(f"WHEN ({near}) = {k} THEN ({d(v)} - {d(M.means[k])}) / {d(4.0 * M.sds[k])}" for k in ALL)
                mv.append(f"WHEN {col} = {d(v)} THEN {sql_clip(f'(CASE {mm} END)')}")
        cte.append(f"{col}_p AS (SELECT *, CASE WHEN {col} IN ({', '.join(d(v) for v in modal)}) THEN NULL "
                   f"ELSE CAST(dmode AS INTEGER) END AS {col}_mode, "
                   f"CASE WHEN {col} IN ({', '.join(d(v) for v in modal)}) THEN CASE {idx} END "
                   f"ELSE {N_MODAL} + (CASE {pos} END) END AS {col}_pre, "
                   f"CASE WHEN {col} IN ({', '.join(d(v) for v in modal)}) THEN NULL ELSE {raw} END AS {col}_raw, "
                   f"CASE WHEN {col} IN ({', '.join(d(v) for v in modal)}) THEN CASE {' '.join(mv)} END "
                   f"ELSE {sql_clip(raw)} END AS {col}_val FROM {col}_m)")
        n_slots = f"{N_MODAL} + nkept"
    else:
        cte.append(f"{col}_p AS (SELECT *, CAST(dmode AS INTEGER) AS {col}_mode, CASE {pos} END AS {col}_pre, "
                   f"{raw} AS {col}_raw, {sql_clip(raw)} AS {col}_val FROM {col}_m)")
        n_slots = "nkept"
    cte.append(f"{col}_pc AS (SELECT {col}_pre AS pre, count(*) AS n FROM {col}_p GROUP BY 1)")
    cte.append(f"{col}_rk AS (SELECT pre, n, CAST(row_number() OVER (ORDER BY n DESC, pre) - 1 AS INTEGER) AS slot "
               f"FROM {col}_pc)")
    cte.append(f"{col}_enc AS (SELECT p.event_id, p.{col}_mode, p.{col}_pre, p.{col}_raw, p.{col}_val, "
               f"r.slot AS {col}_slot, p.dmode AS {col}_dmode, p.nkept AS {col}_nkept FROM {col}_p p "
               f"JOIN {col}_rk r ON p.{col}_pre = r.pre)")
    return cte, n_slots


def _cat_sql():
    return ["cat_rk AS (SELECT event_type AS category, count(*) AS rows, "
            "CAST(row_number() OVER (ORDER BY count(*) DESC, event_type ASC NULLS LAST) - 1 AS INTEGER) AS slot "
            "FROM base GROUP BY event_type)"]


def _with(heavy=False, value=True, mixed=False, cat=False):
    ctes = [_base_sql(heavy)]
    if value:
        ctes += _draw_sql("value", SEED)[0]
    if mixed:
        ctes += _draw_sql("x", SEED + 1, MIXED_MODAL)[0]
    if cat:
        ctes += _cat_sql()
    return "WITH " + ",\n".join(ctes) + "\n"


def _restore_sql(col, modal=()):
    mean = " ".join(f"WHEN {col}_dmode = {k} THEN {d(M.means[k])}" for k in ALL)
    sd4 = " ".join(f"WHEN {col}_dmode = {k} THEN {d(4.0 * M.sds[k])}" for k in ALL)
    r = f"greatest(least({col}_val, {d(1.0)}), {d(-1.0)}) * (CASE {sd4} END) + (CASE {mean} END)"
    if modal:
        back = " ".join(f"WHEN {col}_pre = {i} THEN {d(v)}" for i, v in enumerate(modal))
        r = f"CASE WHEN {col}_pre < {len(modal)} THEN (CASE {back} END) ELSE {r} END"
    return r


# ----------------------------------------------------------------------------- D5-D9
@register("d5_nonmodal", f"""
SELECT event_id, x FROM (SELECT event_id, CASE WHEN event_type = 'signup' THEN {d(0.0)}
  WHEN event_type = 'error' THEN {d(MISSING_SENTINEL)} ELSE value END AS x FROM events) t
WHERE x NOT IN ({', '.join(d(v) for v in MIXED_MODAL)})""")
def d5_nonmodal(spark, sf_dir):
    df = fixture(spark, sf_dir)
    return df.where(E.is_continuous(F.col("x"), MIXED_MODAL)).select("event_id", "x")


@register("d6_mode_counts", f"""
SELECT CAST({sql_argmax(sql_scores('value', M, ALL), ALL)} AS INTEGER) AS mode, count(*) AS rows
FROM events GROUP BY 1""")
def d6_mode_counts(spark, sf_dir):
    return mode_counts(table(spark, sf_dir, "events"), "value", M)


@register("d7_kept", _with() + "SELECT w.m AS mode, w.weight AS weight, coalesce(h.n, 0) AS rows, k.kept AS kept "
          "FROM value_w w LEFT JOIN value_hard h ON w.m = h.m JOIN value_kept k ON w.m = k.m")
def d7_kept(spark, sf_dir):
    """D7 by the encoder's own pass."""
    code = E.ColumnCode(name="value", kind="continuous", model=M)
    counts = E._hard_counts(table(spark, sf_dir, "events"), [code])["value"]
    model = significant_modes(M, counts, DEFAULT_EPS)
    # K rows; the counts behind them come from the distributed pass above
    return spark.createDataFrame([(k, M.weights[k], counts.get(k, 0), model.kept[k]) for k in ALL],
                                 "mode int, weight double, rows long, kept boolean")


@register("d8_inventory", f"""
SELECT 'value' AS col, 'continuous' AS kind, CAST(NULL AS BIGINT) AS size, min(value) AS min, max(value) AS max FROM events
UNION ALL
SELECT 'x', 'mixed', CAST(NULL AS BIGINT), min(x), max(x) FROM (SELECT CASE WHEN event_type = 'signup' THEN {d(0.0)}
  WHEN event_type = 'error' THEN {d(MISSING_SENTINEL)} ELSE value END AS x FROM events) t
UNION ALL
SELECT 'event_type', 'categorical', count(DISTINCT event_type) + max(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END),
  CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM events""")
def d8_inventory(spark, sf_dir):
    inv = E.column_inventory(fixture(spark, sf_dir), SPECS)
    return inv.select("col", "kind", "size", "min", "max")


@register("d9_layout", _with(value=True, mixed=True, cat=True) + f"""
SELECT col, CAST(block AS INTEGER) AS block, CAST(start AS INTEGER) AS start, CAST(width AS INTEGER) AS width, activation
FROM (
  SELECT 'value' AS col, 0 AS block, 0 AS start, 1 AS width, 'tanh' AS activation
  UNION ALL SELECT 'value', 1, 1, (SELECT max(value_nkept) FROM value_enc), 'softmax'
  UNION ALL SELECT 'x', 0, 1 + (SELECT max(value_nkept) FROM value_enc), 1, 'tanh'
  UNION ALL SELECT 'x', 1, 2 + (SELECT max(value_nkept) FROM value_enc), {N_MODAL} + (SELECT max(x_nkept) FROM x_enc), 'softmax'
  UNION ALL SELECT 'event_type', 0, 2 + (SELECT max(value_nkept) FROM value_enc) + {N_MODAL} + (SELECT max(x_nkept) FROM x_enc),
    (SELECT count(*) FROM cat_rk), 'softmax'
) t""")
def d9_layout(spark, sf_dir):
    _df, enc = encoder_for(spark, sf_dir)
    return E.layout_frame(spark, enc)


# ----------------------------------------------------------------------------- E7-E16
@register("e7_kept_probs", _with() + "SELECT event_id, " + ", ".join(
    f"{q6(f'q{k} / qz')} AS pp_{k}" for k in range(9)) + " FROM value_qz")
def e7_kept_probs(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    model = enc.column("value").model
    out = kept_probs(df.select("event_id", "value"), "value", model, prefix="pp_")
    return out.select("event_id", *[r6(f"pp_{k}").alias(f"pp_{k}") for k in model.kept_modes()])


@register("e8_sample_mode", _with() + "SELECT event_id, value_dmode AS sampled_mode FROM value_enc")
def e8_sample_mode(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    model = enc.column("value").model
    out = sample_mode(df.select("event_id", "value"), "value", model, key="event_id", seed=SEED)
    return out.select("event_id", "sampled_mode")


@register("e9_onehot", _with() + "SELECT event_id, " + ", ".join(
    f"CASE WHEN value_slot = {i} THEN {d(1.0)} ELSE {d(0.0)} END AS oh_{i}" for i in range(9)) + " FROM value_enc")
def e9_onehot(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    code = enc.column("value")
    out = E.encode(df, E.Encoder([code]), "event_id")
    oh = E.one_hot(F.col("value_slot"), code.n_slots)
    return out.select("event_id", *[oh[i].alias(f"oh_{i}") for i in range(code.n_slots)])


@register("e10_rank", _with() + "SELECT pre, n AS rows, slot FROM value_rk")
def e10_rank(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    code = enc.column("value")
    counts = E._slot_counts(df, [code], F.col("event_id"))["value"]
    rows = [(p, counts.get(p, 0), s) for s, p in enumerate(code.order) if counts.get(p, 0) > 0]
    # The rank table is K rows; the counts behind it come from the distributed pass above.
    return spark.createDataFrame(rows, "pre int, rows long, slot int")


@register("e11_nearest", "SELECT event_id, CAST(" + sql_argmax(
    [f"(-abs(value - {d(m)}))" for m in M.means], ALL) + " AS INTEGER) AS nearest FROM events")
def e11_nearest(spark, sf_dir):
    """E11's own function (the encoder applies it to modal values) over every value."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            near = E.nearest_modes(M, b.column(1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near, pa.int32())], names=["event_id", "nearest"])

    return table(spark, sf_dir, "events").select("event_id", "value").mapInArrow(run, "event_id long, nearest int")


@register("e12_modal", _with(mixed=True, value=False) + f"SELECT event_id, {q6('x_val')} AS x_value FROM x_enc "
          f"WHERE x_pre < {N_MODAL}")
def e12_modal(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    out = E.encode(df, E.Encoder([enc.column("x")]), "event_id", keep=["x"])
    return (out.where(F.col("x").isin(list(MIXED_MODAL)))
            .select("event_id", r6("x_value").alias("x_value")))


@register("e13_mixed", _with(mixed=True, value=False) + f"SELECT event_id, {q6('x_val')} AS x_value, x_slot FROM x_enc")
def e13_mixed(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    out = E.encode(df, E.Encoder([enc.column("x")]), "event_id")
    return out.select("event_id", r6("x_value").alias("x_value"), "x_slot")


@register("e14_categories", _with(value=False, cat=True) + "SELECT category, rows, slot FROM cat_rk")
def e14_categories(spark, sf_dir):
    return E.category_index(table(spark, sf_dir, "events"), "event_type")


@register("e15_cat_onehot", _with(value=False, cat=True) + "SELECT b.event_id, r.slot AS event_type_slot "
          "FROM base b LEFT JOIN cat_rk r ON b.event_type IS NOT DISTINCT FROM r.category")
def e15_cat_onehot(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    return E.encode(df, E.Encoder([enc.column("event_type")]), "event_id")


@register("e15_onehot_block", _with(value=False, cat=True) + f"""
SELECT b.event_id, CAST(p.slot AS INTEGER) AS pos, CASE WHEN r.slot = p.slot THEN {d(1.0)} ELSE {d(0.0)} END AS hot
FROM base b LEFT JOIN cat_rk r ON b.event_type IS NOT DISTINCT FROM r.category, cat_rk p""")
def e15_onehot_block(spark, sf_dir):
    """The whole one-hot block of a categorical column, a row for each entry."""
    df, enc = encoder_for(spark, sf_dir)
    out = E.encode(df, E.Encoder([enc.column("event_type")]), "event_id", form="dense")
    return out.select("event_id", F.posexplode("encoded").alias("pos", "hot"))


_ENTRIES_SQL = _with(mixed=True, cat=True) + f"""
, sizes AS (SELECT (SELECT max(value_nkept) FROM value_enc) AS a, {N_MODAL} + (SELECT max(x_nkept) FROM x_enc) AS b,
                   (SELECT count(*) FROM cat_rk) AS c),
entries AS (
  SELECT event_id, 0 AS pos, value_val AS v FROM value_enc
  UNION ALL SELECT event_id, 1 + value_slot, {d(1.0)} FROM value_enc
  UNION ALL SELECT event_id, 1 + a, x_val FROM x_enc, sizes
  UNION ALL SELECT event_id, 2 + a + x_slot, {d(1.0)} FROM x_enc, sizes
  UNION ALL SELECT b.event_id, 2 + a + s.b + r.slot, {d(1.0)} FROM base b JOIN cat_rk r ON b.event_type IS NOT DISTINCT FROM r.category, sizes s)
SELECT event_id, CAST(2 + a + b + c AS INTEGER) AS width, CAST(pos AS INTEGER) AS pos, {q6('v')} AS v FROM entries, sizes WHERE v <> 0"""


def _entries(out, array):
    rows = out.select("event_id", F.size(array).alias("width"), F.posexplode(array).alias("pos", "v"))
    return rows.where("v <> 0").select("event_id", "width", "pos", r6("v").alias("v"))


@register("e16_dense", _ENTRIES_SQL)
def e16_dense(spark, sf_dir):
    """E16, dense form: every entry that is not zero, and the width."""
    df, enc = encoder_for(spark, sf_dir)
    return _entries(E.encode(df, enc, "event_id", form="dense"), F.col("encoded"))


@register("e16_vector", _ENTRIES_SQL)
def e16_vector(spark, sf_dir):
    """E16, ML vector form."""
    from pyspark.ml.functions import vector_to_array

    df, enc = encoder_for(spark, sf_dir)
    return _entries(E.encode(df, enc, "event_id", form="vector"), vector_to_array(F.col("encoded")))


@register("e16_sparse", _ENTRIES_SQL)
def e16_sparse(spark, sf_dir):
    """E16, sparse form."""
    df, enc = encoder_for(spark, sf_dir)
    out = E.encode(df, enc, "event_id", form="sparse").select("event_id", "encoded.*")
    rows = out.select("event_id", "size", F.inline(F.arrays_zip("indices", "values")))
    return rows.select("event_id", F.col("size").alias("width"), F.col("indices").alias("pos"), r6("values").alias("v"))


@register("e16_encode", _with(mixed=True, cat=True) + f"""
SELECT v.event_id, {q6('v.value_val')} AS value_value, v.value_slot, {q6('x.x_val')} AS x_value, x.x_slot,
       r.slot AS event_type_slot
FROM value_enc v JOIN x_enc x ON v.event_id = x.event_id JOIN base b ON b.event_id = v.event_id
LEFT JOIN cat_rk r ON b.event_type IS NOT DISTINCT FROM r.category""")
def e16_encode(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    out = E.encode(df, enc, "event_id")
    return out.select("event_id", r6("value_value").alias("value_value"), "value_slot",
                      r6("x_value").alias("x_value"), "x_slot", "event_type_slot")


# ----------------------------------------------------------------------------- F1-F8
@register("f1_decode", _with() + f"SELECT event_id, {q6(_restore_sql('value'))} AS value FROM value_enc")
def f1_decode(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    sub = E.Encoder([enc.column("value")])
    out = decode(E.encode(df, sub, "event_id"), sub, "event_id")
    return out.select("event_id", r6("value").alias("value"))


@register("f2_decode_mixed", _with(mixed=True, value=False)
          + f"SELECT event_id, {q6(_restore_sql('x', MIXED_MODAL))} AS x FROM x_enc")
def f2_decode_mixed(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    sub = E.Encoder([enc.column("x")])
    out = decode(E.encode(df, sub, "event_id"), sub, "event_id")
    return out.select("event_id", r6("x").alias("x"))


@register("f3_decode_cat", "SELECT event_id, event_type FROM events")
def f3_decode_cat(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    sub = E.Encoder([enc.column("event_type")])
    return decode(E.encode(df, sub, "event_id"), sub, "event_id")


@register("f5_decode_all", _with(mixed=True) + f"""
SELECT v.event_id, {q6(_restore_sql('value'))} AS value, {q6(_restore_sql('x', MIXED_MODAL))} AS x, b.event_type
FROM value_enc v JOIN x_enc x ON v.event_id = x.event_id JOIN base b ON b.event_id = v.event_id""")
def f5_decode_all(spark, sf_dir):
    df, enc = encoder_for(spark, sf_dir)
    out = decode(E.encode(df, enc, "event_id", form="dense"), enc, "event_id")
    return out.select("event_id", r6("value").alias("value"), r6("x").alias("x"), "event_type")


_HEAVY_MODE = sql_argmax(sql_scores("value", M, ALL), ALL)
_HMEAN = " ".join(f"WHEN m = {k} THEN {d(M.means[k])}" for k in ALL)
_HSD4 = " ".join(f"WHEN m = {k} THEN {d(4.0 * M.sds[k])}" for k in ALL)


@register("f6_unscore", f"""
SELECT event_id, {q6(f"greatest(least(t, {d(1.0)}), {d(-1.0)}) * (CASE {_HSD4} END) + (CASE {_HMEAN} END)")} AS value_Restored
FROM (SELECT event_id, m, {sql_clip(f"(value - (CASE {_HMEAN} END)) / (CASE {_HSD4} END)")} AS t
      FROM (SELECT event_id, value, CAST({_HEAVY_MODE} AS INTEGER) AS m FROM (SELECT event_id,
        CASE WHEN event_id % {HEAVY_TAIL_EVERY} = 0 THEN value * {d(HEAVY_TAIL_FACTOR)} ELSE value END AS value
        FROM events) h) s) u""")
def f6_unscore(spark, sf_dir):
    df = fixture(spark, sf_dir, heavy=True).select("event_id", "value")
    out = unscore(score(df, "value", M), "value", M)
    return out.select("event_id", r6("value_Restored").alias("value_Restored"))


def _report_sql(lossless: bool) -> str:
    parts = []
    for col, modal in (("value", ()), ("x", MIXED_MODAL)):
        restored = _restore_sql(col, modal)
        if lossless:
            restored = f"CASE WHEN abs({col}_raw) > {d(0.99)} THEN b.{col} ELSE {restored} END"
        parts.append(f"""SELECT '{col}' AS col, coalesce(e.{col}_mode, -1) AS mode, count(*) AS rows,
  CAST(sum(CASE WHEN abs({col}_raw) > {d(0.99)} THEN 1 ELSE 0 END) AS BIGINT) AS clipped,
  {q6(f'max(abs(({restored}) - b.{col}))')} AS max_abs_err,
  {q6(f'avg(abs(({restored}) - b.{col}))')} AS mean_abs_err
FROM {col}_enc e JOIN base b ON b.event_id = e.event_id GROUP BY 1, 2""")
    return _with(heavy=True, mixed=True) + "\nUNION ALL\n".join(parts)


def _report(spark, sf_dir, lossless):
    df, enc = encoder_for(spark, sf_dir, heavy=True)
    rep = roundtrip_report(df, enc, "event_id", lossless=lossless)
    return rep.select("col", "mode", "rows", "clipped", r6("max_abs_err").alias("max_abs_err"),
                      r6("mean_abs_err").alias("mean_abs_err"))


@register("f7_roundtrip", _report_sql(False))
def f7_roundtrip(spark, sf_dir):
    return _report(spark, sf_dir, False)


@register("f8_lossless", _report_sql(True))
def f8_lossless(spark, sf_dir):
    return _report(spark, sf_dir, True)
