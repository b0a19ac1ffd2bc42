import os
import shutil

import pytest
from pyspark.sql import functions as F

from modenorm.operators.model import load_model, save_model
from modenorm.operators.plugin import NumpyModeScaler, apply_transformer
from modenorm.operators.score import score
from modenorm.plans.fixed import fixed_model
from modenorm.plans.jobs import normalize_job
from modenorm.streaming.stream import score_stream
from tests.conftest import SF001

M = fixed_model("value")


def test_stream_equals_batch_and_is_incremental(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    shutil.copy(f"{SF001}/events.parquet", os.path.join(src, "a.parquet"))
    dst, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    score_stream(spark, src, dst, M, "value", checkpoint=ckpt)
    got = spark.read.parquet(dst)
    want = score(spark.read.parquet(src), "value", M)
    cols = ["event_id", "value_Transformed", "Mode_Assignment"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())
    # a second file arrives: only it is scored
    spark.read.parquet(f"{SF001}/events.parquet").withColumn("event_id", F.col("event_id") + 10**6) \
        .write.parquet(os.path.join(tmp_dir, "b"))
    for f in os.listdir(os.path.join(tmp_dir, "b")):
        if f.endswith(".parquet"):
            shutil.copy(os.path.join(tmp_dir, "b", f), os.path.join(src, "b.parquet"))
    score_stream(spark, src, dst, M, "value", checkpoint=ckpt)
    out = spark.read.parquet(dst)
    assert out.count() == 2000 and out.select("event_id").distinct().count() == 2000


def test_plugin_equals_native(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("event_id", "value")
    a = apply_transformer(ev, NumpyModeScaler(M), "value").orderBy("event_id").collect()
    b = score(ev, "value", M).orderBy("event_id").collect()
    assert [r["Mode_Assignment"] for r in a] == [r["Mode_Assignment"] for r in b]
    assert max(abs(x["value_Transformed"] - y["value_Transformed"]) for x, y in zip(a, b)) < 1e-12


def test_normalize_job_and_model_roundtrip(spark, tmp_dir):
    dst, mpath = os.path.join(tmp_dir, "scored"), os.path.join(tmp_dir, "model")
    model = normalize_job(spark, f"{SF001}/events.parquet", dst, col="value", key="event_id", model_path=mpath,
                          max_iter=30)
    out = spark.read.parquet(dst)
    assert out.count() == 1000 and "value_Transformed" in out.columns
    loaded = load_model(spark, mpath)[("value", "main")]
    assert loaded.means == model.means and loaded.sds == model.sds


def test_fit_on_sample_without_key_and_per_file_job(spark, tmp_dir):
    from modenorm.plans.jobs import fit_on_sample, per_file_job

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    a = fit_on_sample(ev, "value", sample_rows=500, max_iter=20)
    b = fit_on_sample(ev.repartition(3), "value", sample_rows=500, max_iter=20)
    assert a.means == b.means                 # the file-position key does not depend on partitioning
    dst = os.path.join(tmp_dir, "per-file")
    per_file_job(spark, f"{SF001}/events.parquet", dst, col="value", head_rows=400, max_iter=20)
    out = spark.read.parquet(dst)
    assert out.count() == 1000
    assert [f for f in os.listdir(dst) if f[0] not in "._"] == ["transformed_events.parquet"]


def test_command_line(spark, tmp_dir, capsys):
    from modenorm.__main__ import main

    dst = os.path.join(tmp_dir, "cli-scored")
    assert main(["normalize", f"{SF001}/events.parquet", dst, "--col", "value", "--key", "event_id",
                 "--max-iter", "10", "--model-path", os.path.join(tmp_dir, "cli-model")], spark=spark) == 0
    assert spark.read.parquet(dst).count() == 1000
    assert main(["profile", f"{SF001}/nation.parquet"], spark=spark) == 0
    out = capsys.readouterr().out
    assert "rows" in out and "n_nationkey" in out
    enc_dst = os.path.join(tmp_dir, "cli-enc")
    assert main(["encode", f"{SF001}/events.parquet", enc_dst, "--key", "event_id", "--continuous", "value",
                 "--categorical", "event_type", "--lossless"], spark=spark) == 0
    assert spark.read.parquet(os.path.join(enc_dst, "encoded")).count() == 1000


def test_named_files_and_the_per_file_command(spark, tmp_dir):
    from modenorm.__main__ import main
    from modenorm.sources.io import write_named

    for k, n in enumerate((300, 200)):
        (spark.range(n).select("id", (F.col("id") % 17 + k).cast("double").alias("Amount")).coalesce(1)
         .write.parquet(f"{tmp_dir}/raw{k}"))
        part = next(f for f in os.listdir(f"{tmp_dir}/raw{k}") if f.startswith("part-"))
        os.makedirs(f"{tmp_dir}/in", exist_ok=True)
        os.link(f"{tmp_dir}/raw{k}/{part}", f"{tmp_dir}/in/day {k}.parquet")
    assert main(["per-file", f"{tmp_dir}/in", f"{tmp_dir}/out", "--max-iter", "3"], spark=spark) == 0
    names = [f for f in sorted(os.listdir(f"{tmp_dir}/out")) if f[0] not in "._"]
    assert names == ["transformed_day 0.parquet", "transformed_day 1.parquet"]
    assert [spark.read.parquet(f"{tmp_dir}/out/{n}").count() for n in names] == [300, 200]
    # a job that fails leaves the folder as it was, and nothing beside it
    bad = spark.read.parquet(f"{tmp_dir}/in").withColumn("x", F.when(F.col("id") == 150, F.raise_error(F.lit("no"))).otherwise(1))
    with pytest.raises(Exception):
        write_named(bad, f"{tmp_dir}/out", F.lit("one.parquet"))
    assert [f for f in sorted(os.listdir(f"{tmp_dir}/out")) if f[0] not in "._"] == names
    assert not [f for f in os.listdir(tmp_dir) if "staging" in f]


def test_null_keys_draw_by_a_second_key(spark, tmp_dir):
    from modenorm.operators.sampling import sample_n

    spark.range(1000).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("k"), F.col("id").alias("v")).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    shares = []
    for seed in range(50):
        got = sample_n(df if seed % 2 else df.select("k", "v"), 100, seed, key="k", total=1000).collect()
        assert len(got) == 100
        shares.append(sum(r.k is None for r in got))
    sd = (100 * 0.2 * 0.8 * 0.9) ** 0.5
    assert abs(sum(shares) / 50 - 20) < 3 * sd / 50 ** 0.5 and max(abs(s - 20) for s in shares) < 4.5 * sd


def test_csv_schema_and_no_schema_agree(spark, tmp_dir):
    from modenorm.sources.io import read_csv

    with open(f"{tmp_dir}/t.csv", "w") as f:
        f.write("a,b\n1,NaN\nNA,2.5\n3, nan \n,null\n")
    free = [tuple(r) for r in read_csv(spark, f"{tmp_dir}/t.csv").collect()]
    typed = [tuple(r) for r in read_csv(spark, f"{tmp_dir}/t.csv", schema="a double, b double").collect()]
    assert free == typed == [(1.0, None), (None, 2.5), (3.0, None), (None, None)]


def test_an_input_file_is_written_by_the_task_that_scans_it(spark, tmp_dir, monkeypatch):
    from modenorm.sources import io

    spark.range(4000).select("id", (F.col("id") * 7).alias("v")).coalesce(1).write.option("parquet.block.size", "4096").parquet(f"{tmp_dir}/raw")
    part = next(f for f in os.listdir(f"{tmp_dir}/raw") if f.startswith("part-"))
    os.makedirs(f"{tmp_dir}/in")
    for n in ("a.parquet", "b.parquet"):
        os.link(f"{tmp_dir}/raw/{part}", f"{tmp_dir}/in/{n}")
    plans, write = [], io.write_table

    def seen(df, *args, **more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *args, **more)

    monkeypatch.setattr(io, "write_table", seen)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")  # several scan tasks a file
    try:
        df = spark.read.parquet(f"{tmp_dir}/in")
        assert df.rdd.getNumPartitions() > 4
        names = ["transformed_a.parquet", "transformed_b.parquet"]
        assert io.write_source_files(df, f"{tmp_dir}/out") == names
        assert len(plans) == 1 and "Exchange" not in plans[0]
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "2048"
        for n in names:
            assert sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out/{n}").collect())) == [(k, k * 7) for k in range(4000)]
        # rows of a file that several tasks hold still end in one file
        tagged = df.withColumn("__file", io.source_name(df))
        assert io.write_named(tagged.unionByName(tagged), f"{tmp_dir}/twice", F.col("__file"), by_file=True) == ["a.parquet", "b.parquet"]
        assert len(plans) == 3 and "Exchange" in plans[2]
        assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/twice/a.parquet").collect()) == [k // 2 for k in range(8000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
