import random

import pytest
from pyspark.sql import functions as F

from modenorm.llm import jaccard_join, quality_cascade, repeat_parse, shard_hash
from modenorm.llm.components import components
from tests.llm import brute


def near_copies(seed, groups=25):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 4, 5, 6, 7, 9, 10, 15, 20, 40, 80, 150]))]
        for k in range(rnd.randint(1, 14)):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                at, op = rnd.randrange(len(words)), rnd.random()
                if op < 0.4:
                    words[at] = rnd.choice(vocabulary)
                elif op < 0.6:
                    words.insert(at, rnd.choice(vocabulary))
                elif op < 0.8 and len(words) > 1:
                    words.pop(at)
                else:
                    words += words[-3:]
            rows.append((len(rows) * 7, "  ".join(words) if k % 2 else "\n".join(words).upper()))
    rnd.shuffle(rows)
    return rows + [(90001, None), (90002, ""), (90003, " \n\t ")]


@pytest.mark.parametrize("seed, block, first", [(97, 500_000, 3), (33, 120, 1)])
def test_jaccard_groups_equal_brute_force(spark, monkeypatch, seed, block, first):
    """With blocks of 120 shingles most groups are cut into many tiles."""
    monkeypatch.setattr(jaccard_join, "BLOCK_CODES", block)
    monkeypatch.setattr(jaccard_join, "FIRST_KEYS", first)
    rows = near_copies(seed)
    out = jaccard_join.group(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.jaccard_groups(rows)


def test_jaccard_edges(spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(3, "a b", 1), (3, "a b", 2), (1, "A  B", 3), (None, "a b", 4), (5, long, 5), (4, long + " more", 6), (9, None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    out = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_join.group(df).collect())
    assert out == [("1", 1, 1), ("3", 1, 1), ("3", 1, 1), ("4", 29997, 4), ("5", 29996, 4), ("9", 0, 9), ("None", 1, None)]
    assert jaccard_join.group(df.limit(0)).collect() == []


def test_a_chain_of_copies_just_above_and_below_the_threshold(spark, monkeypatch):
    """Many copies of one text, each with some words changed: most pairs are near 80 %, on both sides of it."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2])):
            words[rnd.randrange(60)] = f"z{rnd.randrange(400)}"
        rows.append((k, " ".join(words)))
    monkeypatch.setattr(jaccard_join, "BLOCK_CODES", 2000)
    out = jaccard_join.group(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.jaccard_groups(rows)


def test_small_and_large_sets_both_occur(spark):
    rows = near_copies(5, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    need = "CAST(ceil(80 * n / 100D) AS LONG)"
    sets = jaccard_join.shared_shingles(docs, 6).where(f"size(codes) >= {need}").withColumn(
        "q", F.expr(f"size(codes) - {need} + 1"))
    assert 1 <= jaccard_join.boundary(sets) < 145
    assert sets.where(f"n > {jaccard_join.boundary(sets)}").count() > 0
    assert jaccard_join.boundary(sets.limit(0)) == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 199), (199, 198), (7, 7)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 140)}, 198: 198, 199: 198, 200: 198}


def passages(seed):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "and", "alpha", "Überé", "漢字", "x", "gamma,", "delta.\n", "  "] + [f"w{i}" for i in range(60)]

    def text(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    shared = [text(rnd.randint(8, 60)) for _ in range(10)]
    rows = []
    for k in range(160):
        op = rnd.random()
        if op < 0.3:
            t = text(rnd.randint(0, 80))
        elif op < 0.7:
            t = text(rnd.randint(0, 40)) + " " + rnd.choice(shared) + " " + text(rnd.randint(0, 40))
        elif op < 0.8 and rows:
            t = rnd.choice(rows)[1]
        elif op < 0.9:
            t = "ab" * rnd.randint(0, 200) + text(3)
        else:
            t = " ".join(rnd.choice(shared) for _ in range(4))
        rows.append((k * 3, t))
    rows += [(5, None), (7, ""), (None, rows[10][1]), (None, None), (rows[20][0], rows[20][1]), (rows[40][0], rows[41][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot, slice_bytes, phrases", [(512, 2 << 20, 1_000_000), (2, 3000, 10)])
def test_repeats_equal_brute_force(spark, monkeypatch, hot, slice_bytes, phrases):
    monkeypatch.setattr(repeat_parse, "HOT_ENTRIES", hot)
    monkeypatch.setattr(repeat_parse, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(repeat_parse, "PARTITION_PHRASES", phrases)
    rows = passages(hot)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    out = [tuple(r) for r in repeat_parse.remove_repeats(df, result="kept_sha256").collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(out, key=order) == sorted(brute.repeats_removed(rows), key=order)


def test_repeat_text_keeps_whole_characters_and_columns(spark):
    passage = "é" * 24 + "abc"
    rows = [(1, passage + " one", "a"), (2, "ñ" + passage + " two", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone string")
    out = {r.doc_id: (r.text, r.gone) for r in repeat_parse.remove_repeats(df, keep=("gone",), result="text").collect()}
    assert out[1] == (passage + " one", "a") and out[2][1] == "b" and "�" not in out[2][0]
    assert repeat_parse.remove_repeats(df.limit(0)).collect() == []


def test_a_very_long_text_and_its_copy(spark):
    rnd = random.Random(8)
    long = " ".join(f"{rnd.random():.9f}" for _ in range(60_000))
    rows = [(2, long), (1, long[300_000:]), (3, "short")]
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in repeat_parse.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: (len(long) - 300_000, 0, 0), 2: (len(long), len(long) - 300_000, 1), 3: (5, 0, 0)}


def test_quality_counts_equal_brute_force(spark):
    rnd = random.Random(4)
    parts = ["a", "bb", "ccc|", "d#d", "É", "漢", "\n", "\n", "\t", " ", "\x0b", "\x0c", "x y z a b c d e f g ", "line one\n"]
    rows = [(k, "".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 120)))) for k in range(300)]
    rows += [(900, None), (901, ""), (None, "x " * 50), (902, "word " * 40_000), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, words int")
    out = sorted((str(r[0]), *r[1:]) for r in (tuple(x) for x in quality_cascade.judge(df).collect()))
    ref = []
    for i, t in rows:
        q = brute.quality(t)
        ref.append((str(i), *q, q[0] < 20 or 100 * q[4] > 30 * q[0]))
    assert [r[:7] for r in out] == sorted(ref)
    assert all(not (r[6] and r[7]) for r in out)
    assert quality_cascade.judge(df.limit(0)).collect() == []


def test_quality_sample_is_bounded_by_rows_and_spread(spark):
    rows = [(k, f"text {k}") for k in range(2000)] + [(None, "x")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sample = quality_cascade.sample_rows(df, "doc_id", "text")
    assert sample.count() == quality_cascade.SAMPLE
    assert "Coalesce" not in sample._jdf.queryExecution().executedPlan().toString()
    hot = spark.createDataFrame([(7, "hot")] * 4000 + [(8, "one")], "doc_id long, text string")
    assert quality_cascade.sample_rows(hot, "doc_id", "text").count() < 2 * quality_cascade.SAMPLE
    assert quality_cascade.sample_rows(df.where("doc_id IS NULL"), "doc_id", "text").count() == 0


def test_quality_order_follows_rejections_and_cost(spark):
    rows = [(k, "word " * 30) for k in range(200)]
    base = quality_cascade.counts(spark.createDataFrame(rows, "doc_id long, text string"))
    dear = "char_length(regexp_replace(repeat(text, 8), '(w)(o)(r)(d)', '$4$3$2$1')) > 0"
    order = quality_cascade.order_rules(base, {"never": "n_words < 0", "dear": dear, "cheap": "n_words > 10"})
    assert order[0] == "cheap"


def test_quality_order_changes_no_verdict(spark):
    rows = [(1, "CAPS AND MORE CAPS " * 6), (2, "fine words of a text that is kept as it should be " * 3 + "end"),
            (3, " ".join(f"w{chr(97 + i % 26)}o#$%" for i in range(40))), (4, " ".join(f"word{i}" for i in range(30)))]
    base = quality_cascade.counts(spark.createDataFrame(rows, "doc_id long, text string"))
    names = list(quality_cascade.RULES)
    for order in (names, names[::-1]):
        out = {r.doc_id: r.rejected_by for r in quality_cascade.cascade(base, quality_cascade.RULES, order).collect()}
        assert out[1] == "capitals" and out[3] == "symbols" and out[4] is None


def test_shards_fit_and_are_as_shallow_as_can_be(spark):
    rnd = random.Random(6)
    rows = [(k, "x" * rnd.randint(0, 400)) for k in range(800)] + [(7000, "y" * 9000), (None, None), (3, "again")]
    out = shard_hash.assign(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, hash int"), 2000).collect()
    assert len(out) == len(rows)
    shards = {}
    for r in out:
        shards.setdefault((r.depth, r.prefix), []).append(r)
    ids = {key: {r.doc_id for r in own} for key, own in shards.items()}
    for (depth, prefix), own in shards.items():
        size = sum(r.n_bytes for r in own)
        assert {r.shard_bytes for r in own} == {size}
        assert size <= 2000 or len(ids[depth, prefix]) == 1
        if depth:  # its parent had to split: with all shards below it, it is too large
            parent = [r for (d, p), rs in shards.items() if d >= depth and p >> (d - depth + 1) == prefix >> 1 for r in rs]
            assert sum(r.n_bytes for r in parent) > 2000
    assert shard_hash.assign(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_write_shards(spark, tmp_dir):
    df = spark.createDataFrame([(k, "x" * 50, "s") for k in range(100)] + [(None, "z", "s")], "doc_id long, text string, shard_bytes string")
    shard_hash.write_shards(df, f"{tmp_dir}/shards", 600)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.count() == 101 and back.select("shard").distinct().count() >= 9


def test_phrases_of_one_trigger_are_told_apart_by_64_bits(spark):
    passage = "the passage that a great many documents hold, word for word."
    rows = [(1, "653218979 " + passage), (2, "723761431 " + passage)]  # upper 32 bits of two phrases' hashes agree
    parse = repeat_parse.Parse([t.encode() for _, t in rows])
    a, b = (set(zip(parse.trigger[parse.doc == k].tolist(), parse.code[parse.doc == k].tolist())) for k in (0, 1))
    assert any(t == u and c >> 32 == d >> 32 and c != d for t, c in a for u, d in b)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = repeat_parse.remove_repeats(df, result="kept_sha256").collect()
    assert sorted(map(tuple, out)) == sorted(brute.repeats_removed(rows))
