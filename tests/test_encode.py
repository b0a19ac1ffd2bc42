import pytest
from pyspark.sql import functions as F

from modenorm.operators import encode as E
from modenorm.operators.decode import decode
from modenorm.operators.evaluate import roundtrip_report
from modenorm.plans.checks_encode import SPECS, encoder_for, fixture
from tests.conftest import SF001


@pytest.fixture(scope="module")
def enc(spark):
    return encoder_for(spark, SF001, heavy=True)


def test_compact_roundtrip_unclipped_rows_exact(spark, enc):
    df, encoder = enc
    out = E.encode(df, encoder, "event_id", keep=["value", "x", "event_type"])
    back = decode(out, encoder, "event_id", keep=["value", "x", "event_type", "value_value"], suffix="_r")
    bad = back.where((F.abs(F.col("value_value")) < 0.99) & (F.abs(F.col("value_r") - F.col("value")) > 1e-9)).count()
    assert bad == 0
    assert back.where(~F.col("event_type_r").eqNullSafe(F.col("event_type"))).count() == 0
    # modal values come back exactly
    assert back.where(F.col("x").isin([0.0, -9999999.0]) & (F.col("x_r") != F.col("x"))).count() == 0


def test_lossless_report_has_zero_error(spark, enc):
    df, encoder = enc
    rep = roundtrip_report(df, encoder, "event_id", lossless=True).collect()
    assert max(r["max_abs_err"] for r in rep) < 1e-9
    lossy = roundtrip_report(df, encoder, "event_id", lossless=False).collect()
    assert sum(r["clipped"] for r in lossy if r["col"] == "value") == 2
    assert sum(r["rows"] for r in lossy if r["col"] == "value") == df.count()


def test_dense_form_one_hot_blocks(spark, enc):
    df, encoder = enc
    dense = E.encode(df, encoder, "event_id", form="dense")
    width = sum(w for _c, _b, _s, w, _a in E.layout(encoder))
    rows = dense.collect()
    assert all(len(r["encoded"]) == width for r in rows)
    for name, block, start, w, act in E.layout(encoder):
        if act == "softmax":
            for r in rows[:200]:
                assert sum(r["encoded"][start:start + w]) == 1.0


def test_encoding_independent_of_partitioning(spark, enc):
    df, encoder = enc
    a = E.encode(df, encoder, "event_id").orderBy("event_id").collect()
    b = E.encode(df.repartition(7), encoder, "event_id").orderBy("event_id").collect()
    assert a == b


def test_unseen_category_and_null(spark, enc):
    _df, encoder = enc
    sub = E.Encoder([encoder.column("event_type")])
    df = spark.createDataFrame([(1, "never"), (2, None), (3, "view")], "event_id long, event_type string")
    out = {r["event_id"]: r["event_type_slot"] for r in E.encode(df, sub, "event_id").collect()}
    assert out[1] is None and out[2] is None and out[3] is not None
    back = {r["event_id"]: r["event_type"] for r in decode(E.encode(df, sub, "event_id"), sub, "event_id").collect()}
    assert back[1] is None and back[3] == "view"


def test_fit_encoder_end_to_end(spark):
    df = fixture(spark, SF001)
    encoder = E.fit_encoder(df, SPECS, key="event_id", max_iter=50)
    for c in encoder.columns:
        if c.kind != "categorical":
            assert 0 < len(c.kept) <= 10
            assert sorted(c.order) == list(range(c.n_slots))
    rep = roundtrip_report(df, encoder, "event_id", lossless=True).collect()
    assert max(r["max_abs_err"] for r in rep) < 1e-6


def test_vector_form(spark, enc):
    df, encoder = enc
    vec = E.encode(df, encoder, "event_id", form="vector").orderBy("event_id").first()["encoded"]
    dense = E.encode(df, encoder, "event_id", form="dense").orderBy("event_id").first()["encoded"]
    assert list(vec.toArray()) == dense


def test_mixed_column_without_continuous_part(spark):
    """§2.J item 9: no kept continuous mode -> only modal slots, exact round trip."""
    rows = [(i, 0.0 if i % 3 else -9999999.0, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, x double, value double")
    specs = [E.ColumnSpec("x", "mixed", (-9999999.0, 0.0)), E.ColumnSpec("value")]
    encoder = E.fit_encoder(df, specs, key="event_id", max_iter=20)
    code = encoder.column("x")
    assert code.kept == [] and code.n_slots == 2
    # modal values are matched by value, whatever the position of the sentinel
    assert code.modal_values[0] == 0.0
    rep = {r["col"]: r for r in roundtrip_report(df, encoder, "event_id").collect() if r["col"] == "x"}
    assert rep["x"]["max_abs_err"] == 0.0 and rep["x"]["rows"] == 300


def test_all_null_continuous_column_raises(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "event_id long, v double")
    with pytest.raises(ValueError):
        E.fit_encoder(df, [E.ColumnSpec("v")], key="event_id", max_iter=5)


def test_hash64_draw_is_keyed_and_follows_posteriors(spark):
    from modenorm.operators.score import kept_probs
    from modenorm.plans.fixed import fixed_model

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "value")
    model = fixed_model("value").with_kept([True] * 9 + [False])
    draw = E.draw_position(ev, F.col("value"), model, F.col("event_id"), 7, "pos", rng="hash64")
    again = E.draw_position(ev.repartition(5), F.col("value"), model, F.col("event_id"), 7, "pos", rng="hash64")
    a = dict(draw.select("event_id", "pos").collect())
    assert a == dict(again.select("event_id", "pos").collect())
    got = {}
    for v in a.values():
        got[v] = got.get(v, 0) + 1
    pp = kept_probs(ev, "value", model, prefix="pp_")
    expect = pp.agg(*[F.sum(f"pp_{k}").alias(str(k)) for k in range(9)]).first().asDict()
    for k in range(9):
        e = expect[str(k)]
        assert abs(got.get(k, 0) - e) <= 5 * (e ** 0.5) + 5


def test_save_and_load_encoder(spark, enc, tmp_dir):
    import os

    df, encoder = enc
    path = os.path.join(tmp_dir, "encoder")
    E.save_encoder(spark, encoder, path)
    loaded = E.load_encoder(spark, path)
    a = E.encode(df, encoder, "event_id").orderBy("event_id").collect()
    b = E.encode(df, loaded, "event_id").orderBy("event_id").collect()
    assert a == b
    back = decode(E.encode(df, loaded, "event_id"), loaded, "event_id").orderBy("event_id").collect()
    assert len(back) == df.count()
