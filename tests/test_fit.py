import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from modenorm.functions.rng import keyed_normal
from modenorm.functions.special import digamma
from modenorm.operators import fit as FT
from modenorm.operators.fit import Target, fit_modes, fit_targets
from tests.conftest import SF01
from tests.dense_twin import fit as dense_fit


def test_digamma_identities():
    assert abs(digamma(1.0) + 0.5772156649015329) < 1e-12
    for x in (0.3, 1.7, 12.5, 300.0):
        assert abs(digamma(x + 1) - digamma(x) - 1 / x) < 1e-12


def _hard_init(x, centres, counts_order):
    mids = (np.asarray(centres[:-1]) + np.asarray(centres[1:])) / 2
    lab = np.searchsorted(mids, x, side="left")
    r = np.zeros((len(x), len(centres)))
    r[np.arange(len(x)), lab] = 1.0
    return r[:, counts_order]


def test_matches_dense_twin(spark):
    """The distributed passes equal the dense twin, seeding included."""
    df = spark.read.parquet(f"{SF01}/events.parquet").select("value")
    iters = 25
    targets = [Target("value", F.col("value"))]
    x = np.array([r[0] for r in df.collect()])
    inp = FT.prepare_input(df, targets, compress=False)
    centres = np.array(FT.seed_centres(inp, 10)[0][0])
    inp.unpersist()
    st = fit_targets(df.repartition(3), targets, max_iter=iters, compress=False, centres=centres, accelerate=False)["value"]
    lab = np.searchsorted((centres[:-1] + centres[1:]) / 2, x)
    counts = np.bincount(lab, minlength=10)
    # seeding: one more k-means step hardly moves a centre
    assert np.abs(np.bincount(lab, weights=x, minlength=10) / counts - centres).max() < 0.05 * x.std()
    order = sorted(range(10), key=lambda j: (-counts[j], centres[j]))
    ref = dense_fit(x, _hard_init(x, centres, order), max_iter=iters)
    assert st.n_iter == len(ref["history"])
    np.testing.assert_allclose(st.means, ref["m"], rtol=1e-7, atol=1e-7)
    np.testing.assert_allclose(st.var, ref["var"], rtol=1e-7, atol=1e-9)
    assert abs(st.lower_bound - ref["history"][-1]) <= 1e-7 * abs(ref["history"][-1])
    # the bound never decreases (beyond rounding)
    h = np.array(ref["history"])
    assert np.all(np.diff(h) > -1e-6 * np.abs(h[1:]))


def test_no_grouped_map_in_the_fit_plan(spark):
    df = spark.read.parquet(f"{SF01}/events.parquet")
    inp = FT.Prepared(FT.wide_input(df, [Target("value", F.col("value"))]), [0], None, {})
    plan = FT._pass_frame(inp, {0: FT._hard_sums(0.0, [1.0, 2.0])})._jdf.queryExecution().toString()
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan and "partial_sum" in plan


def plain_centres(x, k, steps=10_000):
    """k-means over all values, from the K quantiles."""
    x = np.sort(x)
    c = x[np.minimum(((np.arange(k) + 0.5) / k * len(x)).astype(int), len(x) - 1)]
    for _ in range(steps):
        lab = np.searchsorted((c[:-1] + c[1:]) / 2, x)
        n = np.bincount(lab, minlength=k)
        new = np.where(n > 0, np.bincount(lab, weights=x, minlength=k) / np.maximum(n, 1), c)
        moved, c = np.abs(new - c).max(), new
        if moved <= 1e-3 * x.std(ddof=1):
            break
    return c


@pytest.mark.parametrize("table, col", [("lineitem", "l_extendedprice"), ("events", "value"), ("lineitem", "l_quantity")])
def test_seeding_over_bins_equals_k_means_over_rows(spark, monkeypatch, table, col):
    df = spark.read.parquet(f"{SF01}/{table}.parquet").select(F.col(col).cast("double").alias("x"))
    passes = []
    one = FT._pass
    monkeypatch.setattr(FT, "_pass", lambda *a: passes.append(1) or one(*a))
    inp = FT.prepare_input(df, [Target("x", F.col("x"))])
    centres, info = FT.seed_centres(inp, 10)
    inp.unpersist()
    x = np.array([r.x for r in df.collect()])
    assert np.abs(np.array(centres[0]) - plain_centres(x, 10)).max() <= 2e-3 * x.std()
    assert len(passes) == 2 and info[0]["seed_settled"] and info[0]["seed_last_move"] <= 2e-3
    assert abs(inp.stats[0].mean - x.mean()) <= 1e-9 * abs(x.mean()) and abs(inp.stats[0].var - x.var(ddof=1)) <= 1e-9 * x.var()


def test_accelerated_fit_reaches_the_plain_bound_in_a_third_of_the_passes(spark):
    """At the default 200 iterations; the bound never falls."""
    df = spark.read.parquet(f"{SF01}/events.parquet").select("value")
    x = np.array([r[0] for r in df.collect()])
    fast = fit_targets(df, [Target("value", F.col("value"))])["value"]
    assert fast.n_iter <= FT.DEFAULT_MAX_ITER
    assert np.all(np.diff(fast.history) >= -1e-9 * np.abs(fast.history[1:]))
    inp = FT.prepare_input(df, [Target("value", F.col("value"))])
    centres = np.array(FT.seed_centres(inp, 10)[0][0])
    inp.unpersist()
    lab = np.searchsorted((centres[:-1] + centres[1:]) / 2, x)
    counts = np.bincount(lab, minlength=10)
    order = sorted(range(10), key=lambda j: (-counts[j], centres[j]))
    ref = dense_fit(x, _hard_init(x, centres, order), max_iter=FT.DEFAULT_MAX_ITER)
    assert fast.lower_bound >= ref["history"][-1] - FT.DEFAULT_TOL
    reached = next(i for i, b in enumerate(fast.history) if b >= ref["history"][-1] - FT.DEFAULT_TOL) + 1
    assert reached + fast.info["jumps_back"] <= len(ref["history"]) / 3
    assert fast.info["passes"] <= 0.4 * len(ref["history"])


def test_two_hundred_columns_share_each_pass(spark):
    """A plan of the same few operators, whatever the number of columns; each column's fit equals its own."""
    base = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "value").limit(2000)
    df = base.select(*[(F.col("value") * (1 + i % 7) + i).alias(f"c{i}") for i in range(200)])
    targets = [Target(f"c{i}", F.col(f"c{i}")) for i in range(200)]
    inp = FT.prepare_input(df, targets)
    many, few = (FT._pass_frame(inp, {t: FT._hard_sums(0.0, [1.0, 2.0]) for t in range(n)})._jdf.queryExecution()
                 .executedPlan() for n in (200, 2))
    count = lambda p: sum(1 for line in p.treeString().split("\n") if line.strip())
    inp.unpersist()
    assert count(many) == count(few)
    wide = fit_targets(df, targets, max_iter=3)
    alone = fit_targets(df, [targets[9]], max_iter=3)["c9"]
    assert len(wide) == 200
    np.testing.assert_allclose(wide["c9"].means, alone.means, rtol=1e-6)


def test_infinite_values_are_left_out(spark):
    rows = [(float(v),) for v in range(50)]
    clean = fit_modes(spark.createDataFrame(rows, "x double"), "x", k=2, max_iter=5)
    odd = fit_modes(spark.createDataFrame(rows + [(math.inf,), (-math.inf,), (math.nan,), (None,)], "x double"), "x", k=2, max_iter=5)
    np.testing.assert_allclose(clean.means, odd.means, rtol=1e-9)


def test_weights_sum_to_one_and_compression_invariant(spark):
    df = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_quantity")   # 50 distinct values
    a = fit_modes(df, "l_quantity", max_iter=8, compress=True)
    b = fit_modes(df, "l_quantity", max_iter=8, compress=False)
    assert abs(sum(a.weights) - 1) < 1e-12
    np.testing.assert_allclose(a.means, b.means, rtol=1e-8)
    np.testing.assert_allclose(a.sds, b.sds, rtol=1e-8)


def test_planted_mixture_recovered(spark):
    n = 30000
    ids = spark.range(n)
    comp = F.col("id") % 3
    z = keyed_normal("id", 11)
    x = (F.when(comp == 0, F.lit(-10.0) + z).when(comp == 1, F.lit(0.0) + z).otherwise(F.lit(25.0) + 2.0 * z))
    df = ids.select(x.alias("x"))
    m = fit_modes(df, "x", k=6, max_iter=60, tol=1e-7, tol_mode="per_row")
    # Variational fits may split a true component over several modes: compare per true component.
    truth = [-10.0, 0.0, 25.0]
    groups = {t: [0.0, 0.0] for t in truth}
    for w, mu in zip(m.weights, m.means):
        if w < 1e-3:
            continue
        t = min(truth, key=lambda c: abs(c - mu))
        groups[t][0] += w
        groups[t][1] += w * mu
    for t, (w, wm) in groups.items():
        assert abs(w - 1 / 3) < 0.02
        assert abs(wm / w - t) < 0.2


def test_constant_and_tiny_inputs(spark):
    df = spark.createDataFrame([(5.0,)] * 50, "x double")
    m = fit_modes(df, "x", k=3, max_iter=20)
    assert all(not math.isnan(v) for v in m.means)
    one = spark.createDataFrame([(1.0,)], "x double")
    m1 = fit_modes(one, "x", k=10, max_iter=5)   # K > distinct values
    assert m1.k == 10
    empty = spark.createDataFrame([], "x double")
    with pytest.raises(ValueError):
        fit_modes(empty, "x")


def test_type_guard(spark):
    df = spark.createDataFrame([("a",)], "s string")
    with pytest.raises(ValueError):
        fit_modes(df, "s")


def test_targets_sharing_passes_equal_separate_fits(spark):
    """Two targets fitted in the same distributed passes equal their separate fits."""
    df = spark.read.parquet(f"{SF01}/events.parquet")
    both = fit_targets(df, [Target("all", F.col("value")),
                            Target("view", F.col("value"), F.col("event_type") == "view")],
                       max_iter=8, compress=False)
    alone = fit_targets(df.where(F.col("event_type") == "view"), [Target("view", F.col("value"))],
                        max_iter=8, compress=False)
    np.testing.assert_allclose(both["view"].means, alone["view"].means, rtol=1e-9)
    np.testing.assert_allclose(both["view"].var, alone["view"].var, rtol=1e-9)


def test_single_mode_fit_and_score(spark):
    from modenorm.operators.score import score

    df = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "value")
    m = fit_modes(df, "value", k=1, max_iter=5)
    assert m.k == 1 and abs(m.weights[0] - 1.0) < 1e-12
    out = score(df, "value", m)
    assert out.where(F.col("Mode_Assignment") != 0).count() == 0
