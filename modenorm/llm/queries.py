"""The queries of this folder, as the driver calls them: ``fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers

from modenorm.llm import (block_ann, byte_lang, chunk_recipes, curve_pack, jaccard_join, piece_codec, quality_cascade,
                          repeat_parse, shard_hash, source_audit, token_store, toxic_cnn, turn_repair)
from modenorm.llm.common import table
from modenorm.session import scratch_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sentencepiece(spark, sf_dir):
    return piece_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_nearest(spark, sf_dir):
    return block_ann.search(table(spark, sf_dir, "embeddings"))


ORACLE["op2_nearest"] = block_ann.SEARCH_SQL


@query
def op3_language_id(spark, sf_dir):
    return byte_lang.identify(table(spark, sf_dir, "documents"))


@query
def op4_token_store(spark, sf_dir):
    return token_store.store_digests(table(spark, sf_dir, "documents"), scratch_path(spark, "token-store"),
                                     public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_sharding(spark, sf_dir):
    return shard_hash.assign(table(spark, sf_dir, "documents"))


ORACLE["op5_sharding"] = shard_hash.ASSIGN_SQL


@query
def op6_packing(spark, sf_dir):
    return curve_pack.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_toxicity(spark, sf_dir):
    return toxic_cnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.group(table(spark, sf_dir, "documents"))


@query
def op9_repeat_removal(spark, sf_dir):
    return repeat_parse.remove_repeats(table(spark, sf_dir, "documents"), result="kept_sha256")


@query
def op10_quality_rules(spark, sf_dir):
    return quality_cascade.judge(table(spark, sf_dir, "documents"))


ORACLE["op10_quality_rules"] = quality_cascade.JUDGE_SQL


@query
def op11_exact_dedup(spark, sf_dir):
    return chunk_recipes.dedupe(table(spark, sf_dir, "documents"))


ORACLE["op11_exact_dedup"] = chunk_recipes.DEDUPE_SQL


@query
def op12_source_audit(spark, sf_dir):
    return source_audit.audit(table(spark, sf_dir, "documents"))


ORACLE["op12_source_audit"] = source_audit.AUDIT_SQL


@query
def op13_turn_repair(spark, sf_dir):
    return turn_repair.repair(table(spark, sf_dir, "conversations"))


ORACLE["op13_turn_repair"] = turn_repair.REPAIR_SQL
