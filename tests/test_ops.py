import math

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from modenorm.operators.ordstats import dense_index, exact_quantiles
from modenorm.operators.profile import describe, profile
from modenorm.operators.sampling import head_n, sample_n
from modenorm.operators.scaleup import add_noise, chunk_plan, replicate
from modenorm.sources.io import drop_index_cols, list_sources, read_csv, read_table
from tests.conftest import SF001, SF01


def test_sample_exact_and_deterministic(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    a = sample_n(orders, 1234, 42, key="o_orderkey")
    b = sample_n(orders.repartition(5), 1234, 42, key="o_orderkey")
    ka = sorted(r[0] for r in a.select("o_orderkey").collect())
    kb = sorted(r[0] for r in b.select("o_orderkey").collect())
    assert len(ka) == 1234 and ka == kb
    assert sample_n(orders, 10**6, 42, key="o_orderkey").count() == orders.count()
    with pytest.raises(ValueError):
        sample_n(orders, 10**6, 42, key="o_orderkey", strict=True)


def test_head_large_n_uses_threshold(spark):
    li = spark.read.parquet(f"{SF01}/orders.parquet")
    got = [r[0] for r in head_n(li.repartition(600), 12000, "o_orderkey").select("o_orderkey").collect()]
    want = sorted(r[0] for r in li.select("o_orderkey").collect())[:12000]
    assert sorted(got) == want


def test_dense_index_and_quantiles(spark):
    vals = np.random.default_rng(1).normal(size=3000)
    vals[:1000] = 7.0          # one hot value holding a third of the rows
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(vals)], "g int, v double")
    idx = dense_index(df, ["v"], group_by=["g"]).collect()
    for g in (0, 1):
        got = sorted(r["idx"] for r in idx if r["g"] == g)
        assert got == list(range(len(got)))
    q = {(r["g"], r["p"]): r["quantile"] for r in exact_quantiles(df, "g", "v", [0.1, 0.5, 0.9]).collect()}
    for g in (0, 1):
        sub = vals[np.arange(len(vals)) % 2 == g]
        for p in (0.1, 0.5, 0.9):
            assert abs(q[(g, p)] - np.quantile(sub, p)) < 1e-12


def test_describe_approx_close_to_exact(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_extendedprice", "l_quantity")
    ex = {(r[0], r[1]): r[2] for r in describe(li, exact=True).collect()}
    ap = {(r[0], r[1]): r[2] for r in describe(li, exact=False).collect()}
    assert set(ex) == set(ap)
    for k, v in ex.items():
        assert abs(ap[k] - v) <= 0.01 * max(1.0, abs(v)) + 200
    assert len(profile(spark.read.parquet(f"{SF001}/customer.parquet")).collect()) > 10


def test_replicate_strategies_agree(spark):
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    a = replicate(nation, 137, 60, order_by=["n_nationkey"], strategy="broadcast")
    b = replicate(nation, 137, 60, order_by=["n_nationkey"], strategy="explode")
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert ra == rb and len(ra) == 137
    # 60 + 60 + 17 rows, each chunk restarting at base row 0
    per_chunk = dict(a.groupBy("chunk").count().collect())
    assert per_chunk == {0: 60, 1: 60, 2: 17}
    first = {r["chunk"]: r["n_nationkey"] for r in a.where(F.col("pos") == 0).collect()}
    assert set(first.values()) == {0}
    assert chunk_plan(spark, 0, 10).count() == 0
    with pytest.raises(ValueError):
        replicate(nation.limit(0), 10, 5)


def test_noise_is_keyed(spark):
    df = spark.range(1000).withColumn("x", F.lit(1.0))
    a = add_noise(df, ["x"], sd=0.01, seed=3).orderBy("id").collect()
    b = add_noise(df.repartition(3), ["x"], sd=0.01, seed=3).orderBy("id").collect()
    assert a == b
    xs = np.array([r["x"] for r in a])
    assert abs(xs.mean() - 1.0) < 0.002 and abs(xs.std() - 0.01) < 0.002


def test_csv_reader(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in.csv")
    with open(path, "w") as f:
        f.write(",Amount,Kind,Count\n0,1.5,a,3\n1,NA,b,\n2,2.5,NA,7\n")
    df = read_csv(spark, path)
    assert "_c0" not in df.columns and "Unnamed: 0" not in df.columns
    types = dict(df.dtypes)
    assert types["Amount"] == "double" and types["Count"] == "double" and types["Kind"] == "string"
    rows = df.orderBy("Count").collect()
    assert sum(r["Amount"] is None for r in rows) == 1
    assert drop_index_cols(df).columns == df.columns


def test_missing_input_raises(spark):
    with pytest.raises(FileNotFoundError):
        read_table(spark, "/nonexistent/path/x.parquet")


def test_list_sources(spark):
    df = read_table(spark, [f"{SF001}/events.parquet", f"{SF01}/events.parquet"])
    got = {r["file_name"]: r["rows"] for r in list_sources(df).collect()}
    # two files of one name in different folders are two sources
    assert got == {"sf0.001__events.parquet": 1000, "sf0.01__events.parquet": 10000}


def test_csv_with_schema_and_partition_sizing(spark, tmp_dir):
    from modenorm.sources.io import set_partition_bytes

    path = os.path.join(tmp_dir, "s.csv")
    with open(path, "w") as f:
        f.write("Unnamed: 0,Amount\n0,1.5\n1,NaN\n2,\n")
    df = read_csv(spark, path, schema="`Unnamed: 0` int, Amount double")
    assert df.columns == ["Amount"]
    vals = [r[0] for r in df.collect()]
    assert vals == [1.5, None, None]    # NaN and empty are missing, as without a schema
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        set_partition_bytes(spark, 1024 * 1024)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(1024 * 1024)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quantiles_of_awkward_values(spark):
    """Both signs, both zeros, infinities, nulls, NaN, a hot value, tiny and huge numbers; empty columns have no rows."""
    from modenorm.operators.ordstats import column_quantiles, key_value, ordered_keys

    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.lognormal(size=700), -rng.lognormal(size=700), [0.0, -0.0, 1e-310, -1e-310, 1e300, -1e300],
                           np.full(900, 7.0), [np.inf, -np.inf]])
    assert np.array([key_value(int(k)) for k in ordered_keys(vals)]).tolist() == (vals + 0.0).tolist()
    assert (np.argsort(ordered_keys(vals), kind="stable") == np.argsort(vals, kind="stable")).all()
    rows = [(float(v), None, float(v) * 2) for v in vals] + [(None, None, None), (math.nan, None, math.nan)]
    df = spark.createDataFrame(rows, "v double, none double, w double").repartition(5)
    probs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    got = {(r["column"], r["p"]): r["quantile"] for r in column_quantiles(df, ["v", "none", "w"], probs).collect()}
    assert len(got) == 2 * len(probs)
    for p in probs:
        assert got["v", p] == pytest.approx(np.quantile(vals, p), rel=1e-12)
        assert got["w", p] == pytest.approx(np.quantile(vals * 2, p), rel=1e-12)
    assert column_quantiles(df.limit(0), ["v"], probs).collect() == []


def test_index_from_file_metadata(spark, tmp_dir):
    from modenorm.operators.ordstats import file_index

    spark.range(1000).withColumn("x", F.col("id") * 2).repartition(5).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t").select("x")
    got = file_index(df, "k")
    assert got.columns == ["x", "k"] and sorted(r.k for r in got.collect()) == list(range(1000))
    assert "Sort" not in got._jdf.queryExecution().executedPlan().toString().replace("SortAggregate", "").split("Broadcast")[0]
    assert file_index(df.where("x > 7"), "k") is None and file_index(spark.range(5).toDF("x"), "k") is None


def test_sample_without_key_needs_file_source(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 1.0)
    with pytest.raises(ValueError):
        sample_n(df, 10, 42)
    assert sample_n(df, 10, 42, key="id").count() == 10
