"""Results that must not depend on sizes, keys or where files lie."""

import math

import pytest
from pyspark.sql import functions as F

from modenorm.operators import encode as E
from modenorm.operators.decode import decode
from modenorm.operators.model import Mixture
from modenorm.operators.ordstats import column_quantiles
from modenorm.operators.plugin import NumpyModeScaler, apply_transformer
from modenorm.operators.sampling import head_n, sample_n
from modenorm.operators.score import score
from modenorm.session import checkpoint_dir
from modenorm.streaming.stream import score_stream

MODEL = Mixture.from_weights("x", [0.0, 50.0], [1.0, 5.0], [0.5, 0.5])


def test_sample_is_complete_with_null_keys(spark):
    df = spark.createDataFrame([(None if k < 950 else k, float(k)) for k in range(1000)], "id long, x double")
    for rng in ("md5", "hash64"):
        out = sample_n(df, 100, key="id", rng=rng)
        assert out.count() == 100
        assert sample_n(df, 970, key="id", rng=rng).count() == 970


def test_keyless_sample_over_files_of_one_name(spark, tmp_dir):
    for k in range(6):
        spark.range(k * 50, k * 50 + 50).coalesce(1).write.parquet(f"{tmp_dir}/part={k}")
    out = sample_n(spark.read.parquet(tmp_dir), 60, seed=3)
    assert out.select("id").distinct().count() == 60


@pytest.mark.parametrize("rows", [1000, 20])
def test_head_keeps_nulls_and_takes_strings(spark, rows):
    df = spark.createDataFrame([(None if k % 50 == 0 else f"v{k:04d}", k) for k in range(rows)], "s string, k int")
    out = [r.s for r in head_n(df, 30, ["s", "k"]).collect()]
    ref = sorted((r.s for r in df.collect()), key=lambda s: (s is not None, s or ""))[:30]
    assert out == ref


def test_category_slots_put_null_last(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "v string")
    slots = {r.category: r.slot for r in E.category_index(df, "v").collect()}
    assert slots == {"c": 0, "a": 1, "b": 2, None: 3}


def test_inventory_duplicates_no_row(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", None, 2.0), ("b", "x", None)], "v string, w string, n double")
    inv = E.column_inventory(df, [E.ColumnSpec("v", "categorical"), E.ColumnSpec("w", "categorical"), E.ColumnSpec("n")])
    assert {(r.col, r["size"], r.min, r.max) for r in inv.collect()} == {("v", 2, None, None), ("w", 2, None, None), ("n", None, 1.0, 2.0)}
    assert "Expand" not in inv._jdf.queryExecution().executedPlan().toString()


def test_null_row_key_is_an_error(spark):
    df = spark.createDataFrame([(1, 1.0), (4, 49.0), (None, 2.0)], "id long, x double")
    enc = E.fit_encoder(df.where("id IS NOT NULL"), [E.ColumnSpec("x")], key="id", models={"x": MODEL})
    with pytest.raises(Exception, match="row key is null"):
        E.encode(df, enc, "id").collect()


def test_value_without_a_kept_mode_is_not_lost(spark):
    df = spark.createDataFrame([(k, 0.0) for k in range(20)], "id long, x double")
    enc = E.fit_encoder(df, [E.ColumnSpec("x", "mixed", (0.0,))], key="id", max_iter=3)
    more = spark.createDataFrame([(1, 0.0), (2, 7.5), (3, None)], "id long, x double")
    back = decode(E.encode(more, enc, "id", keep_overflow=True), enc, "id")
    assert {r.id: r.x for r in back.collect()} == {1: 0.0, 2: 7.5, 3: None}


def test_filters_reach_the_scan_below_the_draw(spark):
    from tests.conftest import SF01

    ev = spark.read.parquet(f"{SF01}/events.parquet").withColumnRenamed("value", "x")
    enc = E.fit_encoder(ev, [E.ColumnSpec("x")], key="event_id", models={"x": MODEL})
    plan = E.encode(ev, enc, "event_id", keep=["event_type"]).where("event_type = 'click' AND x_slot = 1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,click)" in text and len(text) < 40_000


def test_strict_encoding(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 49.0)], "id long, v string, x double")
    enc = E.fit_encoder(df, [E.ColumnSpec("v", "categorical"), E.ColumnSpec("x")], key="id", models={"x": MODEL})
    new = spark.createDataFrame([(3, "z", None)], "id long, v string, x double")
    assert E.encode(new, enc, "id").collect()[0].v_slot is None
    with pytest.raises(Exception, match="unseen category in v: z"):
        E.encode(new, enc, "id", strict=True).collect()
    with pytest.raises(Exception, match="null or NaN in x"):
        E.encode(new, enc, "id", on_null="error").collect()
    assert E.encode(df, enc, "id", strict=True, on_null="error").count() == 2


def test_large_base_is_not_broadcast(spark, monkeypatch):
    from modenorm.operators import scaleup

    base = spark.range(500).withColumnRenamed("id", "k")
    monkeypatch.setattr(scaleup, "BROADCAST_BASE_ROWS", 100)
    with pytest.raises(ValueError, match="too large to broadcast"):
        scaleup.replicate(base, 1700, 600, order_by=["k"], strategy="broadcast")


def test_plugin_nulls_equal_the_column_path(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, math.nan), (4, 49.0)], "id int, x double")
    a = {r.id: (r.x_Transformed, r.Mode_Assignment) for r in apply_transformer(df, NumpyModeScaler(MODEL), "x").collect()}
    b = {r.id: (r.x_Transformed, r.Mode_Assignment) for r in score(df, "x", MODEL).collect()}
    assert a[2] == a[3] == b[2] == b[3] == (None, None)
    assert a[1] == pytest.approx(b[1]) and a[4] == pytest.approx(b[4])


def test_stream_goes_on_without_a_checkpoint_given(spark, tmp_dir):
    src, dst = f"file:{tmp_dir}/in.parquet", f"{tmp_dir}/out"
    for k in range(2):
        spark.range(k * 100, k * 100 + 100).select("id", F.col("id").cast("double").alias("x")).repartition(2).write.mode(
            "append").parquet(src)
        score_stream(spark, src, dst, MODEL, "x")
    got = spark.read.parquet(dst)
    assert got.count() == 200 and got.select("id").distinct().count() == 200


def test_quantile_rounds_need_no_job_per_column(spark):
    df = spark.range(5000).select(*[((F.col("id") * (7 + 2 * k)) % 5003).cast("double").alias(f"c{k}") for k in range(4)])
    tracker = spark.sparkContext.statusTracker()

    def jobs(cols, group):
        spark.sparkContext.setJobGroup(group, group)
        out = column_quantiles(df, cols, [0.25, 0.5]).collect()
        return len(tracker.getJobIdsForGroup(group)), {(r["column"], r["p"]): r["quantile"] for r in out}

    one, _ = jobs(["c0"], "one")
    four, found = jobs(["c0", "c1", "c2", "c3"], "four")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert four == one
    for k in range(4):
        values = sorted(r[0] for r in df.select(f"c{k}").collect())
        assert found[f"c{k}", 0.5] == pytest.approx((values[2499] + values[2500]) / 2)


def test_checkpoint_folder_is_needed_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_exchanges_are_sized_by_measured_bytes(spark, monkeypatch):
    from modenorm.operators.ordstats import dense_index
    from modenorm.sources import io

    df = spark.range(4000).select("id", F.repeat(F.lit("x"), 1000).alias("s"), F.array(F.lit("yy"), F.lit(None)).alias("a"))
    own = 8 * 4 + 1000 + 18
    assert df.agg(F.sum(io.row_bytes(df))).first()[0] == 4000 * own
    assert io.sized_partitions(df) == 8  # the session's number, at least
    assert io.sized_partitions(df, 100_000) == math.ceil(4000 * own / 100_000)
    assert io.sized_partitions(df.limit(0)) == 8
    monkeypatch.setattr(io, "PARTITION_BYTES", 100_000)
    rows = dense_index(df, ["id"]).select("id", "idx", F.spark_partition_id().alias("p"), F.length("s").alias("n")).collect()
    assert all(r.id == r.idx for r in rows) and len(rows) == 4000
    held = {}
    for r in rows:
        held[r.p] = held.get(r.p, 0) + r.n
    assert len(held) > 30 and max(held.values()) < 200_000


def test_command_line_sizes_input_partitions(spark, tmp_dir):
    from modenorm.__main__ import main

    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k) for k in keys]
    spark.range(200_000).select("id", F.rand(1).alias("Amount")).coalesce(1).write.option("parquet.block.size", 1 << 18).parquet(tmp_dir + "/t")
    try:
        n = spark.read.parquet(tmp_dir + "/t").rdd.getNumPartitions()
        assert main(["--partition-mb", "0.25", "profile", tmp_dir + "/t"], spark) == 0
        assert spark.conf.get(keys[0]) == str(1 << 18)
        assert spark.read.parquet(tmp_dir + "/t").rdd.getNumPartitions() > n
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
