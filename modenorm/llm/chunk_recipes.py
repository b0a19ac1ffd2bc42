"""Exact deduplication by content-defined chunk recipes.

1. Every text is cut into chunks whose ends depend only on the text nearby: a chunk ends at the first sentence
   mark with a blank, or line break, after ``MIN_CHUNK`` characters, and after ``MAX_CHUNK`` at the latest.  The
   chunks of a text, put together, are the text.
2. Chunks are deduplicated on the map side and by one exchange, and their 64-bit hashes are verified as
   identifiers: a hash that two different chunks share identifies neither.  Long documents move as chunks, each
   distinct one at most once a map task.
3. A document's recipe is the ordered list of its chunks' identifiers, computed where the text is read.  Two texts
   are equal just when their recipes are (for a text with an unverified identifier: when recipe and text are).
   Recipes are grouped with map-side aggregation and joined back; texts don't move again.

Everything runs as DataFrame and SQL functions.

Defined results: null counts as the empty text, and all empty texts are equal.  Of equal texts the row with the
largest ``doc_id`` stays (null ids are smaller than all others); of repeated rows with that id exactly one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import staged

MIN_CHUNK = 64
MAX_CHUNK = 2048
HASH_BITS = 64

#: where a chunk may end: a line break, or a blank after a sentence mark
_END = r"(?:\n|[.!?][ \t])"


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    """Regular expression whose consecutive matches are a text's chunks; together they are the whole text."""
    return rf"(?s).{{{least},{most}}}?{_END}|.{{1,{most}}}"


def chunked(df: DataFrame, id_col: str, text_col: str, least: int, most: int) -> DataFrame:
    """``doc_id, text, chunks`` of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
            .withColumn("chunks", F.regexp_extract_all("text", F.lit(chunk_pattern(least, most)), F.lit(0))))


def _identifier(bits: int) -> str:
    return "xxhash64(c)" if bits >= 64 else f"shiftrightunsigned(xxhash64(c), {64 - bits})"


def unverified(chunks: DataFrame, bits: int = HASH_BITS) -> list[int]:
    """Hashes shared by different chunks: n * n / 2**65 of them are to be expected for n distinct chunks."""
    c = chunks.select(F.explode("chunks").alias("c"))
    shared = c.selectExpr(f"{_identifier(bits)} AS h", "c").groupBy("h").agg(F.count_distinct("c").alias("n"))
    return [r.h for r in shared.where("n > 1").select("h").collect()]


def recipes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CHUNK,
            most: int = MAX_CHUNK, bits: int = HASH_BITS) -> DataFrame:
    """``row, doc_id, text_sha256, recipe, whole`` of every row, written once; ``whole`` is the text of a row whose
    recipe holds an unverified identifier, else null."""
    docs = chunked(df, id_col, text_col, least, most)
    shared = unverified(docs, bits)
    made = docs.selectExpr("monotonically_increasing_id() AS row", "doc_id", "unhex(sha2(text, 256)) AS text_sha256",
                           f"transform(chunks, c -> {_identifier(bits)}) AS recipe", "text")
    doubt = F.arrays_overlap("recipe", F.array(*map(F.lit, shared))) if shared else F.lit(False)
    made = made.withColumn("whole", F.when(doubt, F.col("text"))).drop("text")
    return staged(df.sparkSession, made, "recipes")


def dedupe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CHUNK,
           most: int = MAX_CHUNK, bits: int = HASH_BITS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    made = recipes(df, id_col, text_col, least, most, bits)
    groups = made.groupBy("recipe", "whole").agg(
        F.count("*").alias("group_size"), F.max(F.struct(F.col("doc_id"), F.col("row"))).alias("last"))
    g = groups.select(F.col("recipe").alias("g_recipe"), F.col("whole").alias("g_whole"), "group_size", "last")
    same = (F.col("recipe") == F.col("g_recipe")) & F.col("whole").eqNullSafe(F.col("g_whole"))
    return made.join(g, same).selectExpr(
        "doc_id", "last.doc_id AS keep_id", "group_size", "row = last.row AS kept", "lower(hex(text_sha256)) AS text_sha256")


DEDUPE_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM t WINDOW same AS (PARTITION BY text)"""
