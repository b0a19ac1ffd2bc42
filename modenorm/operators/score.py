"""Scoring (E1-E8, E17, E18): mode assignment and normalization as column expressions.

The model enters as literals, so a scored table is one ``Project`` over the
scan: no shuffle, no Python worker, one whole-stage-codegen span.  Per-mode
scores are materialised as temporary columns in an inner projection so the
argmax and the softmax reuse them (Catalyst does not collapse a projection
that would duplicate non-trivial expressions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modenorm.functions.rng import keyed_uniform
from modenorm.operators.model import Mixture

# Fixed values of the reference's normalization: values are scaled by
# 4 standard deviations of the chosen mode and clipped to +-0.99; sampling
# probabilities get 1e-6 added before renormalising.
SCALE_SDS = 4.0
CLIP = 0.99
PROB_FLOOR = 1e-6


def _lit(v: float) -> Column:
    return F.lit(float(v))


def extend(df: DataFrame, cols: Sequence[tuple[str, Column]], drop: Sequence[str] = ()) -> DataFrame:
    """Add a chain of columns in one ``select``: later columns may use earlier ones by name.

    Lateral column aliases are split by the analyzer into stacked projections
    (each intermediate computed once), but the plan is analysed once instead
    of once per ``withColumn`` call.  Existing columns with a new name are
    replaced; ``drop`` removes temporaries afterwards.
    """
    names = [n for n, _ in cols]
    clash = [n for n in names if n in df.columns]
    base = df.drop(*clash) if clash else df
    out = base.select("*", *[c.alias(n) for n, c in cols])
    return out.drop(*drop) if drop else out


def value_col(df: DataFrame, col: str) -> Column:
    """The input column as double; raises for non-numeric input."""
    field = next((f for f in df.schema.fields if f.name == col), None)
    if field is None:
        raise ValueError(f"column {col!r} not found")
    if not isinstance(field.dataType, T.NumericType):
        raise ValueError(f"column {col!r} must be numeric, found {field.dataType.simpleString()}")
    return F.col(f"`{col}`").cast("double")


def is_valid(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def mode_scores(x: Column, model: Mixture, modes: Sequence[int] | None = None) -> list[Column]:
    """Log score of each mode: offset_k - 0.5 * ((x - mean_k) / sd_k)^2."""
    idx = range(model.k) if modes is None else modes
    out = []
    for k in idx:
        z = (x - _lit(model.means[k])) / _lit(model.sds[k])
        out.append(_lit(model.offsets[k]) - _lit(0.5) * (z * z))
    return out


def _greatest(cols: Sequence[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def _mode_list(model: Mixture, modes: str | Sequence[int]) -> list[int]:
    if modes == "all":
        return list(range(model.k))
    if modes == "kept":
        kept = model.kept_modes()
        if not kept:
            raise ValueError("model keeps no mode")
        return kept
    return list(modes)


def _score_steps(x: Column, model: Mixture, idx: Sequence[int], prefix: str) -> list[tuple[str, Column]]:
    return [(f"{prefix}{k}", F.when(is_valid(x), sc)) for k, sc in zip(idx, mode_scores(x, model, idx))]


def assign_mode(df: DataFrame, col: str, model: Mixture, out: str = "Mode_Assignment",
                modes: str | Sequence[int] = "all") -> DataFrame:
    """Hard mode = argmax of the score, the lower mode wins ties; null/NaN -> null."""
    x = value_col(df, col)
    idx = _mode_list(model, modes)
    steps = _score_steps(x, model, idx, "__s")
    s = [F.col(n) for n, _ in steps]
    steps.append(("__best", _greatest(s)))
    whens = None
    for c, lab in zip(s, idx):
        cond = c == F.col("__best")
        whens = F.when(cond, F.lit(lab)) if whens is None else whens.when(cond, F.lit(lab))
    steps.append((out, F.when(s[0].isNotNull(), whens.otherwise(F.lit(idx[-1]))).cast("int")))
    return extend(df, steps, drop=[f"__s{k}" for k in idx] + ["__best"])


def mode_probs(df: DataFrame, col: str, model: Mixture, prefix: str = "p_",
               modes: str | Sequence[int] = "all") -> DataFrame:
    """Posterior probability of every mode (stable softmax of the scores)."""
    x = value_col(df, col)
    idx = _mode_list(model, modes)
    steps = _score_steps(x, model, idx, "__s")
    s = [F.col(n) for n, _ in steps]
    steps.append(("__best", _greatest(s)))
    steps += [(f"__e{k}", F.exp(c - F.col("__best"))) for k, c in zip(idx, s)]
    total = None
    for k in idx:
        total = F.col(f"__e{k}") if total is None else total + F.col(f"__e{k}")
    steps.append(("__z", total))
    steps += [(f"{prefix}{k}", F.col(f"__e{k}") / F.col("__z")) for k in idx]
    return extend(df, steps, drop=[f"__s{k}" for k in idx] + [f"__e{k}" for k in idx] + ["__best", "__z"])


def lookup(idx: Column, values: Sequence) -> Column:
    """``values[idx]`` for a 0-based integer column via one constant map.

    The index is referenced once (no CASE chain), so substituting a deep
    expression for it stays linear.  Unknown or null indexes give null.
    """
    pairs = []
    for i, v in enumerate(values):
        if v is None:
            continue
        pairs += [F.lit(i), F.lit(v)]
    if not pairs:
        return F.lit(None)
    return F.try_element_at(F.create_map(*pairs), idx.cast("int"))


def fence(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Optimizer fence around columns that end a deep chain of derived ones.

    Catalyst pushes filters through projections by substituting every alias
    with its expression; over a chain whose columns each reuse several
    earlier ones (softmax -> cumulative sums -> draw) that substitution grows
    exponentially.  A generator's outputs are not substituted, while filters
    on the other columns still move below it into the scan; ``inline`` over
    one struct is one row in, one row out, inside whole-stage codegen.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select(*rest, F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in cols]))))


def sql_double(v: float) -> str:
    """An exact double literal in Spark SQL (constant-folded)."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def posterior_steps(p: str, model: Mixture) -> list[str]:
    """E7 as SQL steps (lateral aliases) from the value ``<p>x``: ``<p>q<k>`` of the kept modes and their sum ``<p>qz``.

    Softmax over all modes, floor, kept modes only; ``<p>q<k> / <p>qz`` is the kept posterior.
    """
    kept, d, xs = model.kept_modes(), sql_double, f"{p}x"
    if not kept:
        raise ValueError(f"model of {model.col!r} keeps no mode")
    ex = []
    for k in range(model.k):
        z = f"(({xs} - {d(model.means[k])}) / {d(model.sds[k])})"
        ex.append(f"{d(model.offsets[k])} - {d(0.5)} * ({z} * {z}) AS {p}s{k}")
    ex.append((f"greatest({', '.join(f'{p}s{k}' for k in range(model.k))})" if model.k > 1 else f"{p}s0")
              + f" AS {p}b")
    ex += [f"exp({p}s{k} - {p}b) AS {p}e{k}" for k in range(model.k)]
    ex.append(" + ".join(f"{p}e{k}" for k in range(model.k)) + f" AS {p}z")
    ex += [f"{p}e{k} / {p}z + {d(PROB_FLOOR)} AS {p}q{k}" for k in kept]
    ex.append(" + ".join(f"{p}q{k}" for k in kept) + f" AS {p}qz")
    return ex


def draw_from(df: DataFrame, x: Column, u: Column, model: Mixture, out: str) -> DataFrame:
    """E7 + E8: position (within kept modes) of the mode that the uniform ``u`` draws from the kept posteriors.

    The chain of derived columns is one ``selectExpr`` (lateral aliases), so building the plan costs one call
    into the JVM rather than hundreds.
    """
    kept, p = model.kept_modes(), "__" + out
    names = [c for c in df.columns if c != out]
    base = extend(df.select(*[F.col(f"`{c}`") for c in names]), [(f"{p}x", x), (f"{p}u", u)])
    ex = posterior_steps(p, model)
    terms = []
    for k in kept:
        terms.append(f"{p}q{k} / {p}qz")
        ex.append(" + ".join(terms) + f" AS {p}c{k}")
    ex.append(f"{p}u * {p}c{kept[-1]} AS {p}t")
    whens = " ".join(f"WHEN {p}c{k} > {p}t THEN {pos}" for pos, k in enumerate(kept))
    ex.append(f"CAST(CASE WHEN {p}x IS NOT NULL AND NOT isnan({p}x) THEN (CASE {whens} ELSE {len(kept) - 1} END) "
              f"END AS INT) AS `{out}`")
    return fence(base.selectExpr("*", *ex).select(*[F.col(f"`{c}`") for c in names], F.col(f"`{out}`")), [out])


def _select_by_mode(mode: Column, values: dict[int, float]) -> Column:
    keys = sorted(values)
    if keys == list(range(len(keys))):
        return lookup(mode, [float(values[k]) for k in keys])
    expr = None
    for k, v in values.items():
        expr = F.when(mode == F.lit(k), _lit(v)) if expr is None else expr.when(mode == F.lit(k), _lit(v))
    return expr


def normalized(x: Column, mode: Column, model: Mixture) -> Column:
    """(x - mean[mode]) / (4 * sd[mode]) with the mode's parameters as literals."""
    mean = _select_by_mode(mode, {k: model.means[k] for k in range(model.k)})
    sd4 = _select_by_mode(mode, {k: SCALE_SDS * model.sds[k] for k in range(model.k)})
    return (x - mean) / sd4


def clip(c: Column, lo: float = -CLIP, hi: float = CLIP) -> Column:
    """E5: clip to [lo, hi]; null and NaN stay null / NaN (no silent rank of NaN)."""
    return F.when(c.isNull() | F.isnan(c), c).otherwise(F.greatest(F.least(c, _lit(hi)), _lit(lo)))


def normalize(df: DataFrame, col: str, model: Mixture, mode_col: str = "Mode_Assignment",
              out: str = "norm") -> DataFrame:
    """Normalize by the row's own mode (unclipped)."""
    if mode_col not in df.columns:
        df = assign_mode(df, col, model, out=mode_col)
    return df.withColumn(out, normalized(value_col(df, col), F.col(mode_col), model))


def normalize_all(df: DataFrame, col: str, model: Mixture, prefix: str = "z_") -> DataFrame:
    """The value normalized against every mode."""
    x = value_col(df, col)
    return df.withColumns({
        f"{prefix}{k}": (x - _lit(model.means[k])) / _lit(SCALE_SDS * model.sds[k]) for k in range(model.k)
    })


def score(df: DataFrame, col: str, model: Mixture | None, keep_overflow: bool = False,
          mode_col: str = "Mode_Assignment", on_null: str = "null") -> DataFrame:
    """E6 (+F8): append ``<col>_Transformed`` (double) and ``Mode_Assignment`` (int).

    Integer input is cast to double first.  Null/NaN input gives null value
    and null mode; ``on_null='error'`` makes the job fail instead.  With
    ``keep_overflow`` a nullable ``<col>_Overflow`` keeps the raw value of
    every clipped row, so decoding is lossless.
    """
    if model is None:
        raise ValueError("model has not been fitted: call fit first")  # E17
    x = value_col(df, col)
    scored = assign_mode(df, col, model, out=mode_col)
    norm = normalized(x, F.col(mode_col), model)
    if on_null == "error":
        norm = F.when(is_valid(x), norm).otherwise(F.raise_error(F.lit(f"null or NaN in {col}")))
    tcol = f"{col}_Transformed"
    steps = [("__norm", norm), (tcol, clip(F.col("__norm")))]
    if keep_overflow:
        steps.append((f"{col}_Overflow", F.when(F.abs(F.col("__norm")) > _lit(CLIP), x).cast("double")))
    scored = extend(scored, steps)
    cols = [c for c in df.columns if c not in (tcol, mode_col)] + [tcol, mode_col]
    if keep_overflow:
        cols.append(f"{col}_Overflow")
    return scored.select(*[F.col(f"`{c}`") for c in cols])


def unscore(df: DataFrame, col: str, model: Mixture, mode_col: str = "Mode_Assignment",
            out: str | None = None) -> DataFrame:
    """invert the scored table: clip(v,-1,1) * 4 * sd[mode] + mean[mode] (overflow wins)."""
    v = F.col(f"`{col}_Transformed`")
    mode = F.col(mode_col)
    mean = _select_by_mode(mode, {k: model.means[k] for k in range(model.k)})
    sd4 = _select_by_mode(mode, {k: SCALE_SDS * model.sds[k] for k in range(model.k)})
    inv = clip(v, -1.0, 1.0) * sd4 + mean
    if f"{col}_Overflow" in df.columns:
        inv = F.coalesce(F.col(f"`{col}_Overflow`"), inv)
    return df.withColumn(out or f"{col}_Restored", inv)


def kept_probs(df: DataFrame, col: str, model: Mixture, prefix: str = "pp_") -> DataFrame:
    """Posteriors (over all modes) restricted to kept modes, +1e-6, renormalised: the draw's own steps."""
    tagged = extend(df, [("__x", value_col(df, col))]).selectExpr("*", *posterior_steps("__", model))
    return tagged.select(*df.columns, *[(F.col(f"__q{k}") / F.col("__qz")).alias(f"{prefix}{k}") for k in model.kept_modes()])


def sample_mode(df: DataFrame, col: str, model: Mixture, key: str | Column, seed: int = 42,
                out: str = "sampled_mode") -> DataFrame:
    """Draw a kept mode from E7 by inverse CDF on a keyed uniform.

    The draw depends only on the row key and the seed, never on partitioning.
    """
    drawn = draw_from(df, value_col(df, col), keyed_uniform(key, seed), model, out)
    return drawn.withColumn(out, lookup(F.col(out), model.kept_modes()).cast("int"))
