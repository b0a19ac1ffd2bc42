"""Token ids in Simple-8b words: a word-aligned file format with vectorised coding and decoding.

A 64-bit word holds a 4-bit selector and as many ids as its slot width allows
(``COUNTS`` and ``WIDTHS``).  Values of 60 bits or more are escapes: a word of
selector ``ESCAPE`` followed by the raw value.  Ids are coded in blocks of
``BLOCK`` values; every block starts a new word and the file keeps each block's
word offset, so blocks are coded and decoded side by side in numpy: coding
walks all blocks one word at a time together, decoding expands all words of
all blocks at once.

Files are Parquet rows ("segments") written by Spark, in ascending document
order: part, place in the part, ids before the segment in its part, document
ids, lengths, word offsets, words.  Spark's writer commits whole tasks, so a
lost executor leaves no half file, and any store Spark reaches will do.

Defined results: a null or empty text is one end id; documents with a null id
come first; repeated rows are all kept, equal ids in order of their text's hash;
very long texts make a segment of their own.  An empty table gives empty files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modenorm.llm.common import narrow, tidy
from modenorm.llm.word_ids import send_vocabulary, text_arrays, with_end, worker_ids
from modenorm.sources.io import sized_partitions

# Fixed values of the Simple-8b layout: ids in a word, by selector, and bits of each.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: an escape is the widest selector with all payload bits set, and the value in the next word
ESCAPE = np.uint64((15 << 60) | ((1 << 60) - 1))
BLOCK = 1024
SEGMENT_IDS = 1 << 18
_U = np.uint64


def bit_lengths(v: np.ndarray) -> np.ndarray:
    """Bits of each unsigned value; 61 for those that need an escape."""
    exact = np.where(v < _U(1 << 52), v, _U(0)).astype(np.float64)
    out = np.frexp(exact)[1].astype(np.uint8)
    big = np.flatnonzero(v >= _U(1 << 52))
    if len(big):
        high = np.frexp((v[big] >> _U(32)).astype(np.float64))[1] + 32
        out[big] = np.where(v[big] >= _U((1 << 60) - 1), 61, high)
    return out


def selectors(bits: np.ndarray) -> np.ndarray:
    """For each place the selector that takes the most values from there on; 16 for an escape.

    ``tops[n]`` is the largest of the next n bit lengths, the maximum of two shorter windows.
    """
    n = len(bits)
    tops = {1: np.append(bits, np.zeros(int(COUNTS.max()), np.uint8))}
    pick = np.where(tops[1][:n] > 60, 16, 15).astype(np.uint8)
    for s in range(14, -1, -1):
        c = int(COUNTS[s])
        half = max(k for k in tops if 2 * k >= c or k == max(tops))
        tops[c] = tops[half].copy()
        np.maximum(tops[half][:half - c], tops[half][c - half:], out=tops[c][:half - c])
        np.copyto(pick, np.uint8(s), where=tops[c][:n] <= np.uint8(WIDTHS[s]))
    return pick


def encode_blocks(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words of the values and the word offset of each block."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values = values.astype(np.uint64)
    starts = np.arange(0, n, block)
    ends = np.minimum(starts + block, n)
    pick = selectors(bit_lengths(values))
    step = np.append(COUNTS, 1)[pick]
    at, end, begins = starts, ends, np.zeros(n, bool)
    while len(at):  # all blocks, one word at a time
        begins[at] = True
        at = at + step[at]
        on = at < end
        if not on.all():
            at, end = at[on], end[on]
    at = np.flatnonzero(begins)
    owner = at // block
    sel = pick[at].astype(np.int64)
    escape = sel == 16
    sel[escape] = 15
    count = np.minimum(step[at], ends[owner] - at)
    width = WIDTHS[sel].astype(np.uint64)
    words = sel.astype(np.uint64) << _U(60)
    for j in range(int(count.max())):
        has = slice(None) if j == 0 else np.flatnonzero((count > j) & (width > 0))
        if j and not len(has):
            break
        words[has] |= values[at[has] + j] << (width[has] * _U(j))
    sizes = np.bincount(owner, minlength=len(starts))
    if escape.any():
        words[escape] = ESCAPE
        after = np.flatnonzero(escape)
        words = np.insert(words, after + 1, values[at[after]])
        sizes += np.bincount(owner[after], minlength=len(starts))
    return words, np.cumsum(sizes) - sizes


def decode_blocks(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values of words made by :func:`encode_blocks`."""
    if not n:
        return np.zeros(0, np.uint64)
    escape = words == ESCAPE
    raw = np.zeros(len(words), bool)
    if escape.any():  # a raw value may look like an escape: within a run every second word is one
        idx = np.flatnonzero(escape)
        first = np.append(True, np.diff(idx) != 1) | np.isin(idx, offsets)
        run = np.maximum.accumulate(np.where(first, np.arange(len(idx)), 0))
        idx = idx[(np.arange(len(idx)) - run) % 2 == 0]
        escape = np.zeros(len(words), bool)
        escape[idx] = True
        raw[idx + 1] = True
    pick = (words >> _U(60)).astype(np.int64)
    count, width = COUNTS[pick], WIDTHS[pick]
    count[escape], count[raw] = 0, 1
    total = np.cumsum(count)
    bounds = np.append(offsets, len(words))
    before = (total - count)[bounds[:-1]]
    size = np.minimum(block, n - np.arange(len(offsets)) * block)
    owner = np.repeat(np.arange(len(words)), count)
    slot = np.arange(len(owner)) - (total - count)[owner]
    of_block = np.repeat(np.arange(len(offsets)), np.append(before[1:], total[-1]) - before)
    keep = np.arange(len(owner)) - before[of_block] < size[of_block]  # the last word of a block may hold more slots
    owner, slot = owner[keep], slot[keep]
    w = width[owner].astype(np.uint64)
    out = (words[owner] >> (w * slot.astype(np.uint64))) & ((_U(1) << w) - _U(1))
    return np.where(raw[owner], words[owner], out)


SEGMENT = ("part int, seq int, start_in_part long, n_ids long, doc_ids array<long>, lengths array<int>, "
           "offsets array<int>, words binary")


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, end_id: int, lowered: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the files in ascending document order."""
    spark = df.sparkSession
    sent = send_vocabulary(spark, tokenizer_path)
    docs = narrow(df, id_col, text_col)
    # rows of one id spread over partitions, too: by text, equal ones by their place in the input
    order = ["doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("place")]
    ordered = (docs.select("text", *order).repartitionByRange(sized_partitions(docs), "doc_id", "text_hash", "place")
               .sortWithinPartitions("doc_id", "text_hash", "place").withColumn("part", F.spark_partition_id()))

    def run(batches):
        words = worker_ids(sent, lowered)
        seq, before = 0, 0
        for b in batches:
            for i, j, texts in text_arrays(b, 1):
                ids, at = with_end(*words.encode(texts), end_id)
                docs = b.column(0).slice(i, j - i)
                k = 0
                while k < j - i:  # whole documents up to about a segment's ids
                    stop = max(k + 1, int(np.searchsorted(at, at[k] + SEGMENT_IDS, "right")) - 1)
                    coded, offsets = encode_blocks(ids[at[k]:at[stop]])
                    n = int(at[stop] - at[k])
                    yield pa.RecordBatch.from_arrays(
                        [b.column(2).slice(0, 1), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                         pa.array([n], pa.int64()), pa.ListArray.from_arrays([0, stop - k], docs.slice(k, stop - k)),
                         pa.array([np.diff(at[k:stop + 1])], pa.list_(pa.int32())),
                         pa.array([offsets], pa.list_(pa.int32())), pa.array([coded.astype("<u8").tobytes()], pa.binary())],
                        names=["part", "seq", "start_in_part", "n_ids", "doc_ids", "lengths", "offsets", "words"])
                    seq, before, k = seq + 1, before + n, stop

    ordered.select("doc_id", "text", "part").mapInArrow(tidy(run, "word ids"), SEGMENT).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document: ids before it in the whole store, and its own as 32-bit integers."""
    files = spark.read.schema(SEGMENT).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each partition written
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                words = np.frombuffer(row["words"], "<u8")
                values = decode_blocks(words, np.array(row["offsets"], np.int64), row["n_ids"]).astype("<u4")
                sizes = np.array(row["lengths"], np.int64)
                ends = np.cumsum(sizes)
                at = row["base"] + row["start_in_part"] + ends - sizes
                raw, cut = values.tobytes(), (ends * 4).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(at, pa.int64()),
                     pa.array([raw[a:b_] for a, b_ in zip([0, *cut], cut)], pa.binary())],
                    names=["doc_id", "start", "ids"])

    return (files.join(F.broadcast(bases), "part").select("start_in_part", "base", "n_ids", "doc_ids", "lengths",
                                                          "offsets", "words")
            .mapInArrow(tidy(run), "doc_id long, start long, ids binary"))


def store_digests(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write all documents' ids to ``path`` and give what the files hold of each."""
    write_tokens(df, path, tokenizer_path, end_id)
    return read_tokens(df.sparkSession, path).select(
        "doc_id", "start", F.expr("CAST(octet_length(ids) DIV 4 AS LONG)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
