import numpy as np

from modenorm.llm import block_ann


def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            near = sorted(((-float(np.cumsum(x * y)[-1]), i) for i, y in ok if i != q and len(y) == len(x)))[:k]
            if near:
                out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return out


def found(df, k):
    out = {}
    for r in sorted(block_ann.search(df, k).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def vectors(n, dim, seed):
    v = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    return [(i, [float(c) for c in x]) for i, x in enumerate(v)]


def test_equals_brute_force_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(block_ann, "QUERY_GROUP", 8)
    monkeypatch.setattr(block_ann, "CANDIDATE_GROUP", 150)
    monkeypatch.setattr(block_ann, "BLOCK", 32)
    rows = vectors(600, 24, 5)
    for i in range(200, 420):  # one vector held by a third of all rows
        rows[i] = (i, rows[40][1])
    rows += [(900, None), (920, []), (940, [0.0] * 24), (960, [float("nan")] * 24), (980, [float("inf")] + [1.0] * 23),
             (901, [None] + [1.0] * 23), (None, rows[0][1]), (1000, [1.0, 2.0]), (1001, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(df, 20) == brute(rows, 20)


def test_wide_range_of_lengths_and_few_candidates(spark):
    rows = [(i, [c * 10.0 ** (i % 7) for c in v]) for i, v in vectors(61, 5, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df, 20) == brute(rows, 20)
    few = spark.createDataFrame(rows[:4] + rows[:2], "vec_id long, embedding array<double>")
    assert found(few, 20) == brute(rows[:4], 20)


def test_empty_and_other_columns(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert block_ann.search(empty).collect() == []
    rows = [(i, v, i, "x") for i, v in vectors(30, 4, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score long, v string")
    assert found(df, 3) == brute([r[:2] for r in rows], 3)


def test_bounds_hold():
    rnd = np.random.default_rng(3)
    q, x = rnd.normal(size=(40, 16)), rnd.normal(size=(60, 16)) * rnd.uniform(0.01, 100, (60, 1))
    q8, qs, qe = block_ann.quantise(q)
    x8, xs, xe = block_ann.quantise(x)
    estimate = (q8.astype(float) @ x8.astype(float).T) * qs[:, None] * xs[None]
    slack = (np.linalg.norm(q8 * qs[:, None], axis=1)[:, None] * xe[None]
             + qe[:, None] * np.linalg.norm(x, axis=1)[None])
    assert (np.abs(q @ x.T - estimate) <= slack * (1 + 1e-9) + 1e-12).all()
