"""A pipeline over ``documents``: what is left of them, packed into training sequences.

``STAGES`` are (name, function) pairs; a function takes ``(spark, docs, sf_dir)``, works on every row of
``docs``, and returns the columns of ``documents`` (the last one: pieces of sequences).  ``run`` writes each
stage's rows to the shared checkpoint folder and reads them back as the next one's input, so a lost executor
costs one stage's tasks at most.

Null and empty texts: toxicity keeps them, language ID rejects them (no letter).  Repeated rows (equal id and
text) become one in the Jaccard stage.  Rows with a null id are never groups' members; they pass on.  An empty
table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modenorm.llm import byte_lang, curve_pack, jaccard_join, repeat_parse, toxic_cnn
from modenorm.llm.common import staged, table

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; it learns from the labels that are not held out."""
    model = toxic_cnn.fit(docs, table(spark, sf_dir, "labels"), ~toxic_cnn.held_out())
    scored = toxic_cnn.score(docs, model, keep=tuple(DOCUMENT[1:]))
    return scored.where(F.col("score") < toxic_cnn.CUT).select(DOCUMENT)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; a missing ``lang`` is filled with it."""
    found = byte_lang.predict(docs, byte_lang.fit(docs, ~byte_lang.held_out()), keep=tuple(DOCUMENT[1:]))
    return (found.where(F.col("lang_pred") != "und")
            .withColumn("lang", F.coalesce("lang", "lang_pred")).select(DOCUMENT))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    first = (jaccard_join.group(docs).where("doc_id = component_id").select("doc_id").distinct())
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.col("lang").asc_nulls_last(), "source", "n_chars")
    kept = (docs.join(first, "doc_id", "left_semi").withColumn("copy", F.row_number().over(same))
            .where("copy = 1").select(DOCUMENT))
    return kept.unionByName(docs.where("doc_id IS NULL").select(DOCUMENT))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has."""
    cut = repeat_parse.remove_repeats(docs, keep=("lang", "source"), result="text")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(DOCUMENT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1,024 ids."""
    return curve_pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("language ID", language_id), ("n-gram Jaccard join", ngram_jaccard),
          ("suffix-array dedup", suffix_dedup), ("packing", packing)]

#: SQL can't express the trained stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(DOCUMENT)
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
