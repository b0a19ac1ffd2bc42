"""Reversible encoder for continuous, mixed and categorical columns.

Fitted state per column is tiny (K modes, a few modal values) except the
category list, which stays a DataFrame ``(category, slot)`` and enters the
plan through a join (broadcast only below a checked size).  Encoding is a
projection: keyed mode draws, literal lookups, clipping.

Compact form (default) per column: ``<col>_value`` (double, absent for
categorical) and ``<col>_slot`` (int): the slot of the chosen mode (or modal
value / category) in the frequency-ranked one-hot block.  ``dense`` form
concatenates value and one-hot blocks into one ``array<double>``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modenorm.functions.rng import uniform
from modenorm.operators.model import DEFAULT_EPS, Mixture, significant_modes
from modenorm.operators.score import CLIP, PROB_FLOOR, SCALE_SDS, clip, draw_from, extend, is_valid, lookup

# Category tables are broadcast into the encode/decode joins only below both bounds.
BROADCAST_CATEGORIES = 100_000
BROADCAST_CATEGORY_BYTES = 64 * 1024 * 1024
# Fixed value: the reference's marker for a missing value inside a mixed column.
MISSING_SENTINEL = -9999999.0


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str = "continuous"           # continuous | mixed | categorical
    modal: tuple[float, ...] = ()      # mixed: values encoded as their own slots

    def __post_init__(self):
        if self.kind not in ("continuous", "mixed", "categorical"):
            raise ValueError(f"unknown column kind {self.kind!r}")


@dataclass
class ColumnCode:
    """Fitted encoding of one column."""

    name: str
    kind: str
    model: Mixture | None = None            # continuous / mixed (non-modal part), with kept flags
    model_all: Mixture | None = None        # mixed: fitted on all values
    modal: tuple[float, ...] = ()
    modal_values: tuple[float, ...] = ()
    categories: DataFrame | None = None     # categorical: (category, rows, slot)
    n_categories: int = 0
    category_bytes: int = 0
    order: tuple[int, ...] = ()             # order[slot] = pre-slot (mode position / modal index)
    seed: int = 42
    rng: str = "hash64"                     # keyed uniform of the mode draw: hash64 (fast) or md5 (portable)
    info: dict = field(default_factory=dict)

    @property
    def kept(self) -> list[int]:
        return self.model.kept_modes() if self.model is not None else []

    @property
    def n_slots(self) -> int:
        if self.kind == "categorical":
            return self.n_categories
        return len(self.modal) + len(self.kept)

    def broadcast_categories(self) -> bool:
        return self.n_categories <= BROADCAST_CATEGORIES and self.category_bytes <= BROADCAST_CATEGORY_BYTES

    def rank_of(self) -> dict[int, int]:
        return {pre: slot for slot, pre in enumerate(self.order)}


@dataclass
class Encoder:
    columns: list[ColumnCode]

    def column(self, name: str) -> ColumnCode:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)


def _x(name: str) -> Column:
    return F.col(f"`{name}`").cast("double")


def _lit(v: float) -> Column:
    return F.lit(float(v))


def _case(key: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        val = F.lit(v)
        expr = F.when(key == F.lit(k), val) if expr is None else expr.when(key == F.lit(k), val)
    if expr is None:
        return F.lit(default)
    return expr if default is None else expr.otherwise(F.lit(default))


# --------------------------------------------------------------------------- D5, D8, E11, E12, E14
def is_continuous(x: Column, modal: Sequence[float]) -> Column:
    """The value is not one of the modal values."""
    if not modal:
        return F.lit(True)
    return ~x.isin([float(v) for v in modal])


def column_inventory(df: DataFrame, specs: Sequence[ColumnSpec]) -> DataFrame:
    """Kind, size (categories, null counted as one), min, max and modal values per column.

    One aggregate for the numeric columns; a grouped count for each categorical one (no row is duplicated).
    """
    def modal(s):
        return (F.array(*[_lit(v) for v in s.modal]) if s.modal else F.array().cast("array<double>")).alias("modal")

    def row(s, size, low, high):
        return [F.lit(s.name).alias("col"), F.lit(s.kind).alias("kind"), size.cast("long").alias("size"),
                low.cast("double").alias("min"), high.cast("double").alias("max"), modal(s)]

    none, parts = F.lit(None), []
    numeric = [(i, s) for i, s in enumerate(specs) if s.kind != "categorical"]
    if numeric:
        wide = df.agg(*[f(_x(s.name)).alias(f"{n}_{i}") for i, s in numeric for n, f in (("min", F.min), ("max", F.max))])
        parts.append(wide.select(F.inline(F.array(*[
            F.struct(*row(s, none, F.col(f"min_{i}"), F.col(f"max_{i}"))) for i, s in numeric]))))
    for s in specs:
        if s.kind == "categorical":
            parts.append(df.groupBy(F.col(f"`{s.name}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
                         .agg(F.count(F.lit(1)).alias("size")).select(*row(s, F.col("size"), none, none)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def category_index(df: DataFrame, col: str) -> DataFrame:
    """Categories by descending frequency (ties: smaller value first, null last) -> slot."""
    from modenorm.operators.ordstats import dense_index

    counts = df.groupBy(F.col(f"`{col}`").alias("category")).agg(F.count(F.lit(1)).alias("rows"))
    idx = dense_index(counts, [F.col("rows").desc(), F.col("category").asc_nulls_last()], out="slot")
    return idx.withColumn("slot", F.col("slot").cast("int"))


def nearest_modes(model: Mixture, values):
    """For each value of an array the mode whose mean is closest (first on ties)."""
    import numpy as np

    return np.abs(np.asarray(values, float)[None, :] - np.array(model.means)[:, None]).argmin(axis=0)


def nearest_mode(model: Mixture, value: float) -> int:
    return int(nearest_modes(model, [value])[0])


def modal_values(model_all: Mixture, modal: Sequence[float]) -> tuple[float, ...]:
    """Normalized value of each modal value by its nearest mode; the missing sentinel gets 0."""
    out = []
    for v in modal:
        if v == MISSING_SENTINEL:
            out.append(0.0)
            continue
        k = nearest_mode(model_all, v)
        z = (v - model_all.means[k]) / (SCALE_SDS * model_all.sds[k])
        out.append(max(min(z, CLIP), -CLIP))
    return tuple(out)


# --------------------------------------------------------------------------- E7, E8 (pre-slot draw)
def draw_position(df: DataFrame, x: Column, model: Mixture, key: Column, seed: int, out: str,
               rng: str = "hash64") -> DataFrame:
    """E8 with a uniform keyed by (row key, seed): ``hash64`` (Spark's xxhash64, default) or ``md5`` (as elsewhere)."""
    u = F.when(key.isNull(), F.raise_error(F.lit("the row key is null")).cast("double")).otherwise(uniform(key, seed, rng))
    return draw_from(df, x, u, model, out)


def _mode_of_position(pos: Column, kept: Sequence[int]) -> Column:
    return lookup(pos, list(kept))


def _norm_by_mode(x: Column, mode: Column, model: Mixture) -> Column:
    mean = lookup(mode, [float(m) for m in model.means])
    sd4 = lookup(mode, [float(SCALE_SDS * s) for s in model.sds])
    return (x - mean) / sd4


# --------------------------------------------------------------------------- pre-slot and value per column
def _pre_columns(df: DataFrame, code: ColumnCode, key: Column, keep_overflow: bool = False) -> DataFrame:
    """Adds ``__<col>_pre`` (pre-rank slot) and ``__<col>_val`` (clipped value) [+ overflow]."""
    name = code.name
    pre, val, raw = f"__{name}_pre", f"__{name}_val", f"__{name}_raw"
    x = _x(name)
    if code.kind == "categorical":
        raise ValueError("categorical columns are encoded by join")
    if code.model is None or not code.kept:
        # No continuous mode (every fitted value was modal): only modal slots exist.
        modal_idx = _case(x, {float(v): i for i, v in enumerate(code.modal)})
        modal_val = _case(x, {float(v): float(code.modal_values[i]) for i, v in enumerate(code.modal)})
        df = df.withColumn(pre, modal_idx.cast("int")).withColumn(val, modal_val.cast("double"))
        if keep_overflow:  # a value without a slot is kept as it is
            df = df.withColumn(f"__{name}_ovf", F.when(is_valid(x) & modal_idx.isNull(), x).cast("double"))
        return df
    kept = code.kept
    df = draw_position(df, x, code.model, key, code.seed, f"__{name}_pos", rng=code.rng)
    pos = F.col(f"__{name}_pos")
    steps = [(f"__{name}_m", _mode_of_position(pos, kept))]
    norm = _norm_by_mode(x, F.col(f"__{name}_m"), code.model)
    n_modal = len(code.modal)
    if code.kind == "mixed" and n_modal:
        modal_idx = _case(x, {float(v): i for i, v in enumerate(code.modal)})
        modal_val = _case(x, {float(v): float(code.modal_values[i]) for i, v in enumerate(code.modal)})
        is_modal = x.isin([float(v) for v in code.modal])
        steps.append((raw, F.when(is_modal, F.lit(None).cast("double")).otherwise(norm)))
        steps.append((pre, F.when(~is_valid(x), F.lit(None)).when(is_modal, modal_idx)
                      .otherwise(pos + F.lit(n_modal)).cast("int")))
        steps.append((val, F.when(~is_valid(x), F.lit(None).cast("double")).when(is_modal, modal_val)
                      .otherwise(clip(F.col(raw)))))
    else:
        steps.append((raw, F.when(is_valid(x), norm)))
        steps.append((pre, F.when(is_valid(x), pos).cast("int")))
        steps.append((val, clip(F.col(raw))))
    if keep_overflow:
        steps.append((f"__{name}_ovf", F.when(F.abs(F.col(raw)) > _lit(CLIP), x)))
    df = extend(df, steps)
    return df.drop(f"__{name}_pos", f"__{name}_m", raw)


# --------------------------------------------------------------------------- fit
def fit_encoder(df: DataFrame, specs: Sequence[ColumnSpec], key: str, sample_rows: int | None = None,
                seed: int = 42, eps: float = DEFAULT_EPS, k: int = 10, max_iter: int = 200,
                models: dict[str, Mixture] | None = None, rng: str = "hash64", **fit_kw) -> Encoder:
    """D3: fit every column; mixed columns get two models (all values; non-modal values).

    ``models`` may supply fitted models (``name`` -> main model, ``name#all``
    -> mixed all-values model) instead of fitting.  Kept modes (D7) and slot
    ranks (E10) are computed on ``df`` in one grouped pass each.
    """
    from modenorm.operators.fit import Target, fit_targets
    from modenorm.operators.sampling import sample_n

    models = dict(models or {})
    targets = []
    for s in specs:
        x = _x(s.name)
        if s.kind == "continuous" and s.name not in models:
            targets.append(Target(s.name, x))
        elif s.kind == "mixed":
            if f"{s.name}#all" not in models:
                targets.append(Target(f"{s.name}#all", x))
            if s.name not in models:
                targets.append(Target(s.name, x, is_continuous(x, s.modal)))
    if targets:
        fit_df = df if sample_rows is None else sample_n(df, sample_rows, seed, key=key, rng=rng)
        states = fit_targets(fit_df, targets, k=k, max_iter=max_iter, allow_empty=True, **fit_kw)
        for name, st in states.items():
            base = name.split("#")[0]
            models[name] = st.to_mixture(base, "all" if name.endswith("#all") else "main")
    from modenorm.session import checkpoint_dir
    from modenorm.sources.io import balanced

    checkpoint_dir(df.sparkSession)
    full, spread = balanced(df)
    if spread:
        full = full.persist()
    try:
        return _fit_codes(full, specs, key, seed, eps, models, rng)
    finally:
        if spread:
            full.unpersist()


def _fit_codes(df: DataFrame, specs: Sequence[ColumnSpec], key: str, seed: int, eps: float,
               models: dict[str, Mixture], rng: str) -> Encoder:
    codes: list[ColumnCode] = []
    for i, s in enumerate(specs):
        if s.kind == "categorical":
            # Written to the shared checkpoint folder: encode/decode join it without recomputing the counts.
            cats = category_index(df, s.name).checkpoint(eager=True)
            size = cats.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(
                F.octet_length(F.col("category").cast("string")) + F.lit(16)), F.lit(0)).alias("b")).first()
            n_cat = size["n"]
            codes.append(ColumnCode(name=s.name, kind=s.kind, categories=cats, n_categories=n_cat,
                                    category_bytes=int(size["b"]),
                                    seed=seed + i, rng=rng))  # a category's slot is its place
            continue
        m = models.get(s.name)
        if m is None and s.kind == "continuous":
            raise ValueError(f"no valid values to fit for {s.name!r}")
        m_all = models.get(f"{s.name}#all") if s.kind == "mixed" else None
        mv = modal_values(m_all, s.modal) if s.kind == "mixed" else ()
        codes.append(ColumnCode(name=s.name, kind=s.kind, model=m, model_all=m_all, modal=tuple(s.modal),
                                modal_values=mv, seed=seed + i, rng=rng))
    numeric = [c for c in codes if c.kind != "categorical"]
    fitted = [c for c in numeric if c.model is not None]
    if fitted:
        counts = _hard_counts(df, fitted)
        for c in fitted:
            c.model = significant_modes(c.model, counts.get(c.name, {}), eps)
    if numeric:
        ranks = _slot_counts(df, numeric, F.col(f"`{key}`"))
        for c in numeric:
            cnt = ranks.get(c.name, {})
            pres = list(range(c.n_slots))
            c.order = tuple(sorted(pres, key=lambda p: (-cnt.get(p, 0), p)))
    return Encoder(codes)


@dataclass(frozen=True)
class _Plain:
    """What a task needs of a column's code: plain numbers."""

    modal: tuple[float, ...]
    model: Mixture | None
    kept: tuple[int, ...]


def _plain(c: ColumnCode) -> _Plain:
    model = None if c.model is None else Mixture(c.name, c.model.means, c.model.sds, c.model.offsets, c.model.weights)
    return _Plain(tuple(float(v) for v in c.modal), model, tuple(c.kept))


def _block_scores(model: Mixture, x):
    """Log scores (modes x rows), with the operations of :func:`mode_scores`."""
    import numpy as np

    z = (x[None, :] - np.array(model.means)[:, None]) / np.array(model.sds)[:, None]
    return np.array(model.offsets)[:, None] - 0.5 * (z * z)


def _hard_block(code: _Plain, x, u):
    """Hard modes of the non-modal values."""
    import numpy as np

    x = x[~np.isin(x, code.modal)] if code.modal else x
    return _block_scores(code.model, x).argmax(axis=0), code.model.k


def _pre_block(code: _Plain, x, u):
    """Pre-rank slots under the draws ``u``: what :func:`_pre_columns` gives."""
    import numpy as np

    n_modal = len(code.modal)
    pre = np.full(len(x), -1)
    if code.model is not None and code.kept:
        score = _block_scores(code.model, x)
        e = np.exp(score - score.max(axis=0))
        q = e[list(code.kept)] / e.sum(axis=0) + PROB_FLOOR
        c = np.cumsum(q / q.sum(axis=0), axis=0)
        over = c > u * c[-1]
        pre = np.where(over.any(axis=0), over.argmax(axis=0), len(code.kept) - 1) + n_modal
    for i, v in reversed(list(enumerate(code.modal))):
        pre[x == v] = i
    return pre[pre >= 0], n_modal + len(code.kept)


def _histograms(df: DataFrame, codes: Sequence[ColumnCode], block, key: Column | None) -> dict[str, dict[int, int]]:
    """Counts by column and number that ``block`` gives the rows: tasks count all columns in one pass, an aggregate
    adds their (column, number) counts.  The plan does not grow with columns x modes."""
    import numpy as np

    plain = [_plain(c) for c in codes]
    draws = key is not None

    def run(batches):
        import pyarrow as pa

        total = [np.zeros(0, np.int64) for _ in plain]
        for b in batches:
            for t, code in enumerate(plain):
                x = b.column(t).to_numpy(zero_copy_only=False)
                ok = ~np.isnan(x)
                u = b.column(len(plain) + t).to_numpy(zero_copy_only=False)[ok] if draws else None
                got, width = block(code, x[ok], u)
                if not len(total[t]):
                    total[t] = np.zeros(max(width, 1), np.int64)
                total[t] += np.bincount(got, minlength=len(total[t]))
        for t, n in enumerate(total):
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t, np.int32)), pa.array(own.astype(np.int32)),
                                              pa.array(n[own])], names=["t", "slot", "n"])

    nan = _lit(float("nan"))
    cols = [F.coalesce(_x(c.name), nan).alias(f"x{t}") for t, c in enumerate(codes)]
    if draws:
        keyed = F.when(key.isNull(), F.raise_error(F.lit("the row key is null")).cast("double"))
        cols += [keyed.otherwise(uniform(key, c.seed, c.rng)).alias(f"u{t}") for t, c in enumerate(codes)]
    rows = (df.select(*cols).mapInArrow(run, "t int, slot int, n long").groupBy("t", "slot")
            .agg(F.sum("n").alias("n")).collect())  # columns x modes numbers
    out: dict[str, dict[int, int]] = {c.name: {} for c in codes}
    for r in rows:
        out[codes[r["t"]].name][r["slot"]] = r["n"]
    return out


def _hard_counts(df: DataFrame, codes: Sequence[ColumnCode]) -> dict[str, dict[int, int]]:
    """Hard-mode counts of every main model on its own (non-modal) rows."""
    return _histograms(df, codes, _hard_block, None)


def _slot_counts(df: DataFrame, codes: Sequence[ColumnCode], key: Column) -> dict[str, dict[int, int]]:
    """Frequency of each pre-rank slot under the encoder's draws."""
    return _histograms(df, codes, _pre_block, key)


# --------------------------------------------------------------------------- encode
def encode(df: DataFrame, encoder: Encoder, key: str, form: str = "compact", keep: Sequence[str] = (),
           keep_overflow: bool = False, strict: bool = False, on_null: str = "null") -> DataFrame:
    """Encode every column of ``encoder``.

    ``strict`` makes the job fail at a category that the fit has not seen (else: null slot, zero block);
    ``on_null="error"`` at a null or NaN in a numeric column (else: null).

    Output: ``key``, ``keep`` columns, then per column ``<col>_value``/``<col>_slot``
    (compact), or one ``encoded`` column: an array (dense), an ML vector (vector), or a struct ``size, indices,
    values`` of the entries that are not zero (sparse: its size does not grow with the number of categories).  With ``keep_overflow`` the
    raw value of clipped rows is kept in ``<col>_overflow`` (F8).
    """
    cur = df
    out_cols = [F.col(f"`{key}`")] + [F.col(f"`{c}`") for c in keep if c != key]
    for c in encoder.columns:
        if c.kind == "categorical":
            cats = c.categories.select(F.col("category").alias(f"__{c.name}_cat"), F.col("slot").alias(f"__{c.name}_slot"))
            right = F.broadcast(cats) if c.broadcast_categories() else cats
            cur = cur.join(right, F.col(f"`{c.name}`").eqNullSafe(F.col(f"__{c.name}_cat")), "left")
            slot = F.col(f"__{c.name}_slot").cast("int")
            if strict:
                slot = F.when(slot.isNull(), F.raise_error(F.concat(F.lit(f"unseen category in {c.name}: "), F.coalesce(
                    F.col(f"`{c.name}`").cast("string"), F.lit("null")))).cast("int")).otherwise(slot)
            out_cols.append(slot.alias(f"{c.name}_slot"))
            continue
        cur = _pre_columns(cur, c, F.col(f"`{key}`"), keep_overflow=keep_overflow)
        rank = c.rank_of()
        slot = lookup(F.col(f"__{c.name}_pre"), [rank[p] for p in range(c.n_slots)]).cast("int")
        if on_null == "error":
            slot = F.when(is_valid(_x(c.name)), slot).otherwise(
                F.raise_error(F.lit(f"null or NaN in {c.name}")).cast("int"))
        out_cols += [F.col(f"__{c.name}_val").alias(f"{c.name}_value"), slot.alias(f"{c.name}_slot")]
        if keep_overflow:
            out_cols.append(F.col(f"__{c.name}_ovf").alias(f"{c.name}_overflow"))
    res = cur.select(*out_cols)
    if form == "compact":
        return res
    if form == "dense":
        return to_dense(res, encoder, key, keep)
    if form == "sparse":
        return to_sparse(res, encoder, key, keep)
    if form == "vector":
        from pyspark.ml.functions import array_to_vector

        dense = to_dense(res, encoder, key, keep)
        return dense.withColumn("encoded", array_to_vector(F.col("encoded")))
    raise ValueError(f"unknown form {form!r}")


def one_hot(slot: Column, width: int) -> Column:
    """One-hot block of ``width`` doubles (all zero for a null slot)."""
    if width <= 0:
        return F.array().cast("array<double>")
    # one expression whatever the width
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.when(i == slot, 1.0).otherwise(0.0))


def to_dense(compact: DataFrame, encoder: Encoder, key: str, keep: Sequence[str] = ()) -> DataFrame:
    parts = []
    for c in encoder.columns:
        if c.kind != "categorical":
            parts.append(F.array(F.coalesce(F.col(f"`{c.name}_value`"), _lit(0.0))))
        parts.append(one_hot(F.col(f"`{c.name}_slot`"), c.n_slots))
    cols = [F.col(f"`{key}`")] + [F.col(f"`{k}`") for k in keep if k != key]
    return compact.select(*cols, F.concat(*parts).alias("encoded"))


def to_sparse(compact: DataFrame, encoder: Encoder, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """The dense encoding's entries that are not zero, by ascending index."""
    entries, width = [], 0
    for c in encoder.columns:
        if c.kind != "categorical":
            value = F.col(f"`{c.name}_value`")
            entries.append(F.struct(F.lit(width).alias("i"), F.coalesce(value, _lit(0.0)).alias("v")))
            width += 1
        slot = F.col(f"`{c.name}_slot`")
        entries.append(F.struct((slot + F.lit(width)).alias("i"), F.when(slot.isNotNull(), 1.0).otherwise(0.0).alias("v")))
        width += c.n_slots
    held = F.filter(F.array(*entries), lambda e: e["v"] != 0.0)
    cols = [F.col(f"`{key}`")] + [F.col(f"`{k}`") for k in keep if k != key]
    return (compact.select(*cols, held.alias("__held"))
            .select(*cols, F.struct(F.lit(width).alias("size"), F.col("__held.i").alias("indices"),
                                    F.col("__held.v").alias("values")).alias("encoded")))


def layout(encoder: Encoder) -> list[tuple[str, int, int, int, str]]:
    """(col, block, start, width, activation) of the dense encoding."""
    rows, start = [], 0
    for c in encoder.columns:
        if c.kind != "categorical":
            rows.append((c.name, 0, start, 1, "tanh"))
            start += 1
            rows.append((c.name, 1, start, c.n_slots, "softmax"))
            start += c.n_slots
        else:
            rows.append((c.name, 0, start, c.n_slots, "softmax"))
            start += c.n_slots
    return rows


def layout_frame(spark, encoder: Encoder) -> DataFrame:
    from modenorm.operators.model import LAYOUT_SCHEMA

    return spark.createDataFrame(layout(encoder), LAYOUT_SCHEMA)


# --------------------------------------------------------------------------- persistence
_COLUMNS_SCHEMA = ("idx int, name string, kind string, modal array<double>, modal_values array<double>, "
                   "slot_order array<int>, seed int, rng string, n_categories long, category_bytes long")


def save_encoder(spark, encoder: Encoder, path: str, mode: str = "overwrite") -> None:
    """Persist a fitted encoder: column table, model table and one category table per categorical column.

    All parts are small Parquet tables (categories may be large; they are
    written by Spark, never collected).
    """
    from modenorm.operators.model import model_frame

    base = path.rstrip("/")
    rows = [(i, c.name, c.kind, [float(v) for v in c.modal], [float(v) for v in c.modal_values],
             [int(o) for o in c.order], int(c.seed), c.rng, int(c.n_categories), int(c.category_bytes))
            for i, c in enumerate(encoder.columns)]
    spark.createDataFrame(rows, _COLUMNS_SCHEMA).coalesce(1).write.mode(mode).parquet(f"{base}/columns")
    models = []
    for c in encoder.columns:
        if c.model is not None:
            models.append(c.model)
        if c.model_all is not None:
            models.append(c.model_all)
    if models:
        model_frame(spark, models).coalesce(1).write.mode(mode).parquet(f"{base}/models")
    for i, c in enumerate(encoder.columns):
        if c.kind == "categorical":
            c.categories.write.mode(mode).parquet(f"{base}/categories/{i}")


def load_encoder(spark, path: str) -> Encoder:
    """Read an encoder written by :func:`save_encoder`."""
    import os

    from modenorm.operators.model import load_model

    base = path.rstrip("/")
    cols = sorted(spark.read.parquet(f"{base}/columns").collect(), key=lambda r: r["idx"])
    try:
        models = load_model(spark, f"{base}/models")
    except Exception:  # noqa: BLE001 - only categorical columns: no model table
        models = {}
    codes = []
    for r in cols:
        code = ColumnCode(name=r["name"], kind=r["kind"], modal=tuple(r["modal"]), modal_values=tuple(r["modal_values"]),
                          order=tuple(r["slot_order"]), seed=r["seed"], rng=r["rng"],
                          n_categories=r["n_categories"], category_bytes=r["category_bytes"])
        if r["kind"] == "categorical":
            code.categories = spark.read.parquet(os.path.join(base, "categories", str(r["idx"])))
        else:
            code.model = models.get((r["name"], "main"))
            code.model_all = models.get((r["name"], "all"))
        codes.append(code)
    return Encoder(codes)
