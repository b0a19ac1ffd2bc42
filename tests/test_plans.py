"""Physical-plan checks: pruning, pushdown, no unexpected shuffles."""

from pyspark.sql import functions as F

from modenorm.operators import fit as FT
from modenorm.operators.scaleup import replicate
from modenorm.operators.score import score
from modenorm.plans.fixed import fixed_model
from tests.conftest import SF001, SF01


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_scan_is_pruned_and_filtered(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    out = score(ev.where(F.col("event_id") < 100).select("event_id", "value"), "value", fixed_model())
    plan = _plan(out)
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert "PushedFilters: [IsNotNull(event_id), LessThan(event_id,100)]" in plan
    assert "Exchange" not in plan


def test_fit_pass_is_one_row_a_task_and_one_aggregate(spark):
    df = spark.read.parquet(f"{SF01}/events.parquet").select("value")
    tg = [FT.Target("value", F.col("value"))]
    inp = FT.prepare_input(df, tg, compress=False)
    try:
        m = fixed_model()
        sums = FT._soft_sums(inp.stats[0].mean, m.offsets, m.means, m.sds)
        plan = _plan(FT._pass_frame(inp, {0: sums}))
        assert "InMemoryTableScan" in plan              # every pass reads the persisted input, not the files
        assert "MapInArrow" in plan and "FlatMapGroups" not in plan
        assert plan.count("HashAggregate") >= 2          # partial (map side) + final
        assert "Join" not in plan
    finally:
        inp.unpersist()


def test_replicate_plans(spark):
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    small = _plan(replicate(nation, 1000, 100, order_by=["n_nationkey"], strategy="broadcast"))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    fan = replicate(nation, 1000, 100, order_by=["n_nationkey"], strategy="explode")
    plan = _plan(fan)
    # the only join is the base index's: partition offsets, a row for each partition
    assert "Generate" in plan and plan.count("BroadcastHashJoin") <= 1 and "SortMergeJoin" not in plan
    assert fan.count() == 1000
