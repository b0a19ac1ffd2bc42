import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from modenorm.llm import queries
from tests.conftest import SF001
from tests.llm import brute


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage over a small corpus."""
    at = str(tmp_path_factory.mktemp("pipeline"))
    rnd = random.Random(1)
    words = {"aa": ["lorem", "ipsum", "dolor", "amet", "sit"], "bb": ["straße", "über", "grün", "wäre", "schön"]}
    passage = " ".join(f"shared{i}" for i in range(20))
    rows, labels = [], []
    for k in range(240):
        lang = "aa" if k % 2 else "bb"
        t = [rnd.choice(words[lang]) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(20, 60))]
        toxic = k % 6 == 0
        if toxic:
            t.insert(rnd.randrange(len(t)), "grobzel")
        if k % 10 == 3:
            t.insert(rnd.randrange(len(t)), passage)
        rows.append((k, " ".join(t), lang, "s", 0))
        if k % 7:
            labels.append((k, 1, int(toxic)))
    rows += [(300 + k, rows[5][1] + f" tail{k}", "aa", "s", 0) for k in range(6)]
    rows += [(400, None, None, None, None), (401, "12 34", "aa", "s", 5), (402, rows[7][1], None, "s", 0),
             (None, "lorem ipsum dolor " * 5, "aa", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{at}/{name}"
        stage(spark, docs, at).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, docs.collect(), after.collect()))
        docs = after
    return at, out


def test_documents_columns_stay(stages):
    for name, docs, _, after in stages[1][:-1]:
        assert docs.columns == corpus_pipeline.DOCUMENT and (not after or list(after[0].asDict()) == docs.columns), name


def test_toxic_documents_go(stages):
    name, _, before, after = stages[1][0]
    toxic = {r.doc_id for r in before if r.text and "grobzel" in r.text}
    kept = {r.doc_id for r in after}
    assert len(toxic & kept) <= 2 and len({r.doc_id for r in before} - toxic - kept) <= 2


def test_language_rejects_only_what_has_none(stages):
    name, _, before, after = stages[1][1]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {400, 401}
    assert all(r.lang for r in after)


def test_one_document_of_each_group_stays(stages):
    name, _, before, after = stages[1][2]
    groups = brute.jaccard_groups([(r.doc_id, r.text) for r in before if r.doc_id is not None])
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted({c for _, c in groups.values()})
    assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before)


def test_repeated_passages_go(stages):
    name, _, before, after = stages[1][3]
    assert len(before) == len(after)
    rest = {r.doc_id: r.text for r in after}
    removed = {i: n for i, _, n, _, _ in brute.repeats_removed([(r.doc_id, r.text) for r in before])}
    assert any(removed.values())
    for r in before:
        assert len(r.text.encode()) - removed[r.doc_id] - len(rest[r.doc_id].encode()) in range(0, 4)


def test_packing_holds_every_id(stages):
    name, _, before, after = stages[1][4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4") for r in before}
    assert sum(len(x) for x in ids.values()) == sum(r.length for r in after)
    for r in after:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32


def test_run_is_the_registered_query(spark):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert len({q.split("_")[0] for q in queries.QUERIES}) == 13
    assert corpus_pipeline.run(spark, SF001).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
