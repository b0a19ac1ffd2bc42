import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from modenorm.llm import byte_lang, queries, toxic_cnn
from tests.conftest import SF01
from tests.llm.brute import held_out


def test_language_on_held_out_documents(spark):
    rows = queries.op3_language_id(spark, SF01).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == held_out(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_edges(spark):
    words = {"aa": "lorem ipsum dolor", "bb": "straße über grün"}
    rows = [(k, words["aa" if k % 2 else "bb"] + " " + str(k), "aa" if k % 2 else "bb", 1.0) for k in range(60)]
    rows += [(100, None, "aa", 0.0), (101, "", "bb", 0.0), (102, "123 !! 4", None, 0.0), (None, "lorem ipsum", None, 0.0),
             (1, rows[1][1], "aa", 0.0), (103, "über grün " * 20_000, None, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = byte_lang.predict(df, byte_lang.fit(df)).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append((r.lang_pred, round(r.score, 6)))
    assert got[100] == got[101] == got[102] == [("und", 0.0)]
    assert got[103][0][0] == "bb" and got[None][0][0] == "aa" and got[1][0] == got[1][1]
    nothing = byte_lang.fit(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in byte_lang.predict(df, nothing).collect()} == {"und"}
    assert byte_lang.identify(df.limit(0)).collect() == []


def toxic_rows(n=900, seed=2):
    rnd = random.Random(seed)
    clean = [f"{a}{b}" for a in ("mor", "tel", "vin", "das", "que") for b in ("a", "en", "io", "ust", "er", "ong")]
    rows, labels = [], []
    for k in range(n):
        words = [rnd.choice(clean) + rnd.choice(["", "", ",", "."]) for _ in range(rnd.randint(3, 120))]
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                words.insert(rnd.randrange(len(words)), "grobz" + rnd.choice(["a", "el", "ist", "Ung", "o!", "ert"]))
        rows.append((k, " ".join(words), "aa" if k % 2 else "bb", "s"))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxic_cnn.classify(docs, marks).collect()
    truth = {k: t for k, _, t in labels}
    assert len(out) == len(rows)
    assert all(r.held_out == held_out(r.doc_id, 3, 1) and r.predicted == (r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out]
    caught = [r.predicted for r in held if truth[r.doc_id]]
    false = [r.predicted for r in held if not truth[r.doc_id]]
    assert sum(caught) >= 0.95 * len(caught) and sum(false) <= 0.02 * len(false)


def test_toxicity_edges(spark):
    rows, labels = toxic_rows(300)
    rows += [(1000, None, None, None), (1001, "", None, None), (1002, " \n ", "aa", None), (None, "mora grobza", None, None),
             (5, rows[5][1], "aa", "s"), (1003, "mora telen " * 30_000 + "grobzel", "bb", "s")]
    labels += [(5, None, 1), (5, None, None), (None, 1, 1), (4000, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxic_cnn.fit(docs, marks)
    out = toxic_cnn.score(docs, model, keep=("lang", "toxic")).collect()
    assert len(out) == len(rows)
    empty = [r.score for r in out if r.doc_id in (1000, 1001, 1002)]
    assert len(empty) == 3 and max(empty) <= 0.01
    assert next(r.score for r in out if r.doc_id == 1003) >= 0.7
    assert len({round(r.score, 9) for r in out if r.doc_id == 5}) == 1
    assert {r.score for r in toxic_cnn.score(docs, toxic_cnn.fit(docs, marks.limit(0))).collect()} == {0.0}
    assert toxic_cnn.classify(docs.limit(0), marks).collect() == []


def test_texts_without_a_known_word_are_not_toxic(spark):
    rows, labels = toxic_rows(300)
    rows += [(2000 + k, t, None, None) for k, t in enumerate(["12 34", "zzyzx", "99", "@ qx-9", "漢字 かな"])]
    model = toxic_cnn.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"),
                          spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    docs = spark.createDataFrame(rows[300:], "doc_id long, text string, lang string, source string")
    assert all(r.score < 0.1 for r in toxic_cnn.score(docs, model).collect())


def test_scoring_equals_a_plain_convolution(spark):
    """Pooled table sums against every filter at every place of the text, one by one."""
    rows, labels = toxic_rows(200)
    model = toxic_cnn.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"),
                          spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    texts = [r[1] for r in rows[:40]] + ["one", "mora telen", "grobza"]
    net, table = model.net, toxic_cnn.WordTable(model)
    pooled, empty = table.texts(texts)
    for text, got in zip(texts, pooled):
        met = set(model.met.tolist())
        e = np.array([sum((net.emb[f % toxic_cnn.BUCKETS] for f in toxic_cnn.features(w) if f in met), np.zeros(16)) for w in text.split()])
        want = []
        for w in net.widths:
            at = [[(e[i:i + w] * net.w[w][:, :, f]).sum() for i in range(len(e) - w + 1)] for f in range(net.filters)]
            want += [max(a) if a else -1.0 for a in at]
        assert np.allclose(got, want, atol=1e-4)


def test_language_scoring_equals_a_plain_convolution(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").limit(60)
    langs, net = byte_lang.fit(df)
    scorer = byte_lang.Scorer(net)
    for text in ["", "ab", "über grün. " * 40, *[r.text for r in df.limit(5).collect()]]:
        if not text:
            continue
        windows, _ = byte_lang.windows_of([text.lower().encode()])
        for window, got in zip(windows, scorer.probabilities(windows)):
            e = net.emb[window]
            h = [max((e[i:i + w] * net.w[w][:, :, f]).sum() for i in range(len(e) - w + 1)) for w in net.widths for f in range(net.filters)]
            z = np.maximum(np.array(h) + net.b, 0) @ net.heads["lang"][0] + net.heads["lang"][1]
            assert np.allclose(got, np.exp(z - z.max()) / np.exp(z - z.max()).sum(), atol=1e-4)
            break


def test_language_sample_is_bounded_by_bytes_of_whole_texts(spark, monkeypatch):
    rows = [(k, f"word{k} " * 100, "aa") for k in range(50)] + [(100 + k, "long " * 1000, "bb") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(byte_lang, "LANG_BYTES", 3000)
    got = byte_lang.training_rows(df, F.lit(True), "doc_id", "text", "lang", 400).collect()
    assert {r.text for r in got} <= {r[1] for r in rows} and {r.lang for r in got} == {"aa", "bb"}
    assert sum(len(r.text) for r in got if r.lang == "aa") <= 3000 + 700 and sum(r.lang == "bb" for r in got) == 1


def test_toxicity_learns_from_whole_texts(spark, monkeypatch):
    rows = [(k, "mora telen vinio " * 1500 + f"daser{k} " + ("grobzel" if k % 2 else "quea"), "aa")
            for k in range(80)]  # the toxic word comes after 25,500 characters
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    model = toxic_cnn.fit(docs, marks)
    got = {r.doc_id: r.score for r in toxic_cnn.score(docs, model).collect()}
    assert all((got[k] >= 0.7) == (k % 2 == 1) for k in range(80))
    whole = {r[1] for r in rows}
    monkeypatch.setattr(toxic_cnn, "CLASS_BYTES", 100_000)
    some = toxic_cnn.training_rows(docs, marks, F.lit(True), 2000)
    assert 2 < len(some) < 60 and all(t in whole for t, _, _ in some) and {c for _, c, _ in some} == {0, 1}
    monkeypatch.setattr(toxic_cnn, "CLASS_BYTES", 100)
    assert sorted(c for _, c, _ in toxic_cnn.training_rows(docs, marks, F.lit(True), 2000)) == [0, 1]


def test_every_language_is_learnable(spark):
    rows = [(k, f"text of language {k}", f"l{k:04d}") for k in range(1100)] + [(5000, "common words", "l0000")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = byte_lang.training_rows(df, F.lit(True), "doc_id", "text", "lang", 400).collect()
    assert sorted(r.lang for r in sample) == sorted(r[2] for r in rows)
    langs, net = byte_lang.fit(df)
    assert langs == sorted({r[2] for r in rows}) and net.heads["lang"][0].shape[1] == 1100


def test_every_labelled_text_is_learned_and_every_fold_calibrates(spark, monkeypatch):
    """A toxic word that only documents beyond the first rows hold; the same model whatever the partitions."""
    rows, labels = toxic_rows(1500)
    late = [(3000 + k, " ".join([*rows[k % 1500][1].replace("grobz", "mor").split()[:30], *["zwirk"] * (k % 2), "vinio"]), "cc", "s")
            for k in range(2000)]
    docs = spark.createDataFrame(rows + late, "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame(labels + [(r[0], 1, r[0] % 2) for r in late], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxic_cnn.conv_shards, "SHARD_BYTES", 300_000)
    first = toxic_cnn.label_marks(marks, F.lit(True)).withColumn("toxic", F.when(F.col("doc_id") < 3000, F.col("toxic")).otherwise(0))
    some, _ = toxic_cnn.first_rows(docs.where("doc_id < 3000"), first, 200)
    monkeypatch.setattr(toxic_cnn, "first_rows", lambda *_: (some, False))
    model = toxic_cnn.fit(docs, marks, per_class=200)
    assert model.langs == ["aa", "bb", "cc"]
    assert set(toxic_cnn.features("zwirk")) - {-1} <= set(model.met.tolist())
    new = spark.createDataFrame([(k, f"telen das{'en' if k % 2 else 'ust'} {'zwirk ' if k < 20 else ''}vinio mora")
                                 for k in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxic_cnn.score(new, model).collect()}
    assert sum((got[k] >= 0.7) == (k < 20) for k in got) >= 38, got
    again = toxic_cnn.fit(docs.repartition(7), marks.repartition(3), per_class=200)
    assert np.array_equal(again.net.emb, model.net.emb) and np.array_equal(again.shift, model.shift)


def test_every_text_with_a_language_is_learned(spark, monkeypatch):
    rows = [(k, ("lorem ipsum dolor " if k % 2 else "straße über grün ") * 4 + str(k), "aa" if k % 2 else "bb") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = []
    real = byte_lang.conv_shards.learn

    def spy(dealt, *rest):
        learned.extend(r.id for r in dealt.collect())
        return real(dealt, *rest)

    monkeypatch.setattr(byte_lang.conv_shards, "learn", spy)
    monkeypatch.setattr(byte_lang.conv_shards, "SHARD_BYTES", 5000)
    langs, net = byte_lang.fit(df, per_lang=20)
    assert sorted(map(int, learned)) == list(range(300)) and langs == ["aa", "bb"]
    assert all(r.lang_pred == ("aa" if r.doc_id % 2 else "bb") for r in byte_lang.predict(df, (langs, net)).collect())
    assert np.array_equal(net.emb, byte_lang.fit(df.repartition(5), per_lang=20)[1].emb)


def test_a_task_drops_another_operators_cache():
    from modenorm.llm import common

    def held():
        return common.worker_cache("one", 1, lambda: "new")

    for wrapped in (common.tidy(iter), common.tidy(iter, "two")):
        common.worker_cache("one", 1, lambda: "old")
        list(common.tidy(iter, "one")([]))
        assert held() == "old"
        list(wrapped([]))
        assert held() == "new"
        common.worker_cache("two", 1, lambda: None)
    common.worker_cache("one", 1, lambda: "old")
    common.tidy_group(lambda t: t)(None)
    assert held() == "new"


def test_arrow_batches_are_bounded_in_bytes(spark):
    from modenorm.llm import common

    df = spark.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x "), 100_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    found = [r.n for r in common.narrow(df, "doc_id", "text").mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 40 and max(found) * 200_000 <= common.BATCH_BYTES + 200_000


def test_the_first_texts_start_no_python_worker(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"telen mora {k}", "aa") for k in range(20)], "doc_id long, text string, lang string")
    marks = toxic_cnn.label_marks(spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, toxic int"), F.lit(True))
    made, make = [], type(spark).createDataFrame

    def seen(self, *args, **more):
        made.append(make(self, *args, **more))
        return made[-1]

    monkeypatch.setattr(type(spark), "createDataFrame", seen)
    rows, fitted = toxic_cnn.first_rows(docs, marks, 100)
    assert fitted and sorted(r[0] for r in rows) == sorted(f"telen mora {k}" for k in range(20))
    assert len(made) == 1 and "ExistingRDD" not in made[0]._jdf.queryExecution().executedPlan().toString()


def test_words_are_hashed_together_as_one_by_one(monkeypatch):
    rnd = random.Random(4)
    words = ["", ".", "«»", "x", "abcd.", "ABCDEF", "x" * 48, "x" * 49, "漢" * 16, "漢" * 17, "İ" * 6, "ΑΣ.", "'ΣΑ", "a\x00b", "😀é"]
    words += ["".join(rnd.choice("aZß.É#漢ΣİΑ'…😀x9-_\x00«") for _ in range(rnd.randint(0, 20))) for _ in range(3000)]
    words *= 3  # more than are hashed at once
    want, alone, one = [toxic_cnn.features(w) for w in words], [], toxic_cnn.features
    monkeypatch.setattr(toxic_cnn, "features", lambda w: alone.append(w) or one(w))
    assert toxic_cnn.hashes(words).tolist() == want
    assert toxic_cnn.hashes([]).shape == (0, 4)
    assert all(len(w.encode()) > 40 for w in alone) and len(alone) < len(words) / 50


def test_a_full_word_table_and_texts_of_all_sizes(monkeypatch):
    net = toxic_cnn.ConvText(toxic_cnn.BUCKETS, {"toxic": 2, "lang": 1}, 16, toxic_cnn.FILTERS, toxic_cnn.WIDTHS)
    words = [f"word{k}" for k in range(60)] + ["new"]
    model = toxic_cnn.ToxicModel(net, [], np.unique(toxic_cnn.hashes(words[:60])))
    texts = [" ".join(words[k % 7:k % 7 + n]) for k, n in enumerate([*range(0, 20), 0, 60, 1, 2, 0])] + ["..", "new", "other"]
    pooled, empty = toxic_cnn.WordTable(model).texts(texts)
    feats = model.buckets(toxic_cnn.hashes(words))
    item = {w: net.item_rows(feats[k:k + 1]).reshape(6, -1) for k, w in enumerate(words)}
    for text, got in zip(texts[:-3], pooled):
        own, want, first = text.split(), [], 0
        for w in net.widths:
            at = [sum(item[own[i + j]][first + j] for j in range(w)) for i in range(len(own) - w + 1)]
            want.append(np.max(at, axis=0) if at else np.full(toxic_cnn.FILTERS, -1))
            first += w
        assert np.allclose(got, np.concatenate(want), atol=1e-6)
    assert [k for k, e in enumerate(empty) if e] == [0, 20, 24, 25, 26, 27]
    monkeypatch.setattr(toxic_cnn, "WORD_ROWS", 20)
    table = toxic_cnn.WordTable(model)
    for k in range(0, len(texts), 3):
        some, none = table.texts(texts[k:k + 3])
        assert np.array_equal(some, pooled[k:k + 3]) and np.array_equal(none, empty[k:k + 3])
        assert table.rows.shape[1] <= 1 + max(20, 60)


def test_items_that_no_filter_picked_are_not_added(monkeypatch):
    """The gradient of the embeddings is the plain sum, from the picked items alone."""
    rng = np.random.default_rng(3)
    net = toxic_cnn.ConvText(50, {"toxic": 2}, 4, 2, (1, 2))
    feats = rng.integers(-1, 50, (400, 3))
    texts = [rng.integers(0, 400, n) for n in (150, 1, 90)]
    added, add = [], np.add

    class Add:
        def __getattr__(self, name):
            return getattr(add, name)

        def at(self, out, places, rows):
            added.append((out, rows.copy()))
            add.at(out, places, rows)

    monkeypatch.setattr(np, "add", Add())
    *_, rows, got = net._gradients(feats, texts, {"toxic": np.array([0, 1, 1])}, rng, 0.0)
    monkeypatch.undo()
    d_item, items = added[0][0], np.unique(np.concatenate(texts))
    want = np.zeros((50, 4))
    for i, d in zip(items, d_item):
        for f in feats[i][feats[i] >= 0]:
            want[f] += d
    assert rows.tolist() == np.unique(feats[items][feats[items] >= 0]).tolist()
    assert np.allclose(got, want[rows], atol=1e-6) and got.any()
    assert added[-1][1].any(axis=1).all()
