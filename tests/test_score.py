import math

import pytest
from pyspark.sql import functions as F

from modenorm.operators.score import assign_mode, clip, score, unscore
from modenorm.plans.fixed import fixed_model
from tests.conftest import SF001, SF01

M = fixed_model("value")

# Expected hard-mode counts of events.value under the fixed model (modes 0..9).
EXPECTED = {
    SF001: [135, 177, 236, 145, 111, 102, 56, 27, 10, 1],
    SF01: [1390, 1819, 2337, 1507, 1152, 840, 497, 320, 126, 12],
}
EXPECTED_HEAVY = {
    SF001: ([135, 176, 236, 145, 111, 102, 56, 26, 10, 3], 2),
    SF01: ([1387, 1817, 2334, 1504, 1148, 837, 497, 319, 128, 29], 16),
}


def _counts(df):
    got = dict(df.groupBy("Mode_Assignment").count().collect())
    return [got.get(k, 0) for k in range(10)]


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_fixed_model_counts(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    out = score(ev, "value", M)
    assert _counts(out) == EXPECTED[sf]
    heavy = ev.withColumn("value", F.when(F.col("event_id") % 500 == 0, F.col("value") * 40).otherwise(F.col("value")))
    out = score(heavy, "value", M, keep_overflow=True)
    counts, clipped = EXPECTED_HEAVY[sf]
    assert _counts(out) == counts
    assert out.where(F.col("value_Overflow").isNotNull()).count() == clipped
    r = out.agg(F.min("value_Transformed"), F.max("value_Transformed")).first()
    assert -0.99 <= r[0] and r[1] <= 0.99


def test_lossless_unscore(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    heavy = ev.withColumn("value", F.when(F.col("event_id") % 500 == 0, F.col("value") * 40).otherwise(F.col("value")))
    out = unscore(score(heavy, "value", M, keep_overflow=True), "value", M)
    err = out.agg(F.max(F.abs(F.col("value_Restored") - F.col("value")))).first()[0]
    assert err < 1e-9


def test_null_nan_and_integer_input(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 14.0)], "id int, v double")
    out = score(df, "v", M).orderBy("id").collect()
    assert out[0]["v_Transformed"] is None and out[0]["Mode_Assignment"] is None
    assert out[1]["Mode_Assignment"] is None
    assert out[2]["Mode_Assignment"] == 1
    ints = spark.createDataFrame([(14,)], "v int")
    got = score(ints, "v", M).first()
    assert got["v_Transformed"] != 0.0 and abs(got["v_Transformed"] - (14 - 13.1) / (4 * 5.5)) < 1e-12


def test_guards(spark):
    df = spark.createDataFrame([("a",)], "s string")
    with pytest.raises(ValueError):
        score(df, "s", M)
    with pytest.raises(ValueError):
        score(spark.createDataFrame([(1.0,)], "x double"), "x", None)


def test_ties_pick_lower_mode(spark):
    from modenorm.operators.model import Mixture

    m = Mixture(col="x", means=(0.0, 2.0), sds=(1.0, 1.0), offsets=(0.0, 0.0), weights=(0.5, 0.5))
    out = assign_mode(spark.createDataFrame([(1.0,)], "x double"), "x", m).first()
    assert out["Mode_Assignment"] == 0


def test_clip_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,), (-5.0,)], "x double")
    vals = [r[0] for r in df.select(clip(F.col("x"))).collect()]
    assert math.isnan(vals[0]) and vals[1] == 0.99 and vals[2] == -0.99


def test_scoring_plan_is_map_only(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    plan = score(ev.select("event_id", "value"), "value", M)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "ArrowEval" not in plan


def test_on_null_error_fails_the_job(spark):
    df = spark.createDataFrame([(1, 3.0), (2, float("nan"))], "id int, v double")
    with pytest.raises(Exception) as err:
        score(df, "v", M, on_null="error").collect()
    assert "null or NaN in v" in str(err.value)
    assert score(df.where("id = 1"), "v", M, on_null="error").count() == 1
