"""Packing along a space-filling curve.

A document's token ids are hashed into a ``BUCKETS``-dimensional vector of
square-root counts, normalised, and projected to three dimensions; the
position on a Hilbert curve through that cube is its key.  Documents are
range-partitioned and sorted by the key, and each partition packs its
documents in curve order into sequences of ``LENGTH`` ids, cutting wherever a
sequence is full.  What is left at the end of a partition is cut into
sequences whose lengths are powers of two, which need no padding.

The hash of the id follows the key in the sort, then the row's place, so copies
(equal keys) and repeated rows spread over partitions however many there are.
The number of partitions follows the measured bytes of the ids.

Defined results: a null or empty text is one end id.  Repeated rows are packed
each.  Very long texts run through as many sequences as they need.  An empty
table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import narrow, staged, text_slices, tidy
from modenorm.llm.word_ids import send_vocabulary, text_arrays, with_end, worker_ids
from modenorm.sources.io import sized_partitions

LENGTH = 1024
BUCKETS = 256
DIMS = 3
BITS = 16
SLICE_BYTES = 1 << 20


def projection() -> np.ndarray:
    """Fixed orthonormal directions."""
    return np.linalg.qr(np.random.default_rng(2024).normal(size=(BUCKETS, DIMS)))[0]


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of integer points (n, dims) with ``bits`` bits a coordinate."""
    x = points.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations, from the largest cells down
        low = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def document_keys(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Curve keys of documents; ``at`` has where each one's ids begin, and the end of the last."""
    n = len(at) - 1
    bucket = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)
    cell = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(at)) + bucket
    v = np.sqrt(np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS))
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    p = (v / np.where(norm > 0, norm, 1)) @ projection()
    return hilbert_keys(np.clip((p + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64))


class Packer:
    """Cuts a stream of documents into sequences; ``base`` numbers the sequences of this task."""

    def __init__(self, base: int, length: int):
        self.sequence, self.length, self.filled, self.open, self.out = base, length, 0, [], []

    def add(self, doc, ids: np.ndarray) -> None:
        at, n = 0, len(ids)
        while at < n:
            take = min(n - at, self.length - self.filled)
            self.open.append((doc, at, ids[at:at + take], n))
            self.filled += take
            at += take
            if self.filled == self.length:
                self.flush(self.open)
                self.open, self.filled = [], 0

    def flush(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), n, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def end(self) -> None:
        """The rest, as sequences whose lengths are powers of two, largest first."""
        rest, self.open = self.open, []
        while self.filled:
            room = 1 << (self.filled.bit_length() - 1)
            self.filled -= room
            own = []
            while room:
                doc, start, ids, n = rest.pop(0)
                own.append((doc, start, ids[:room], n))
                if len(ids) > room:
                    rest.insert(0, (doc, start + room, ids[room:], n))
                room -= min(room, len(ids))
            self.flush(own)

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                          names=[c.split()[0] for c in PIECE.split(", ")])


PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def keyed(df: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, ids, size`` of every document (ids as 16-bit integers where the vocabulary allows; their bytes)."""
    sent = send_vocabulary(df.sparkSession, tokenizer_path)

    def run(batches):
        words = worker_ids(sent, False)
        for b in batches:
            for i, j, texts in text_arrays(b, 1):
                ids, at = with_end(*words.encode(texts), end_id)
                short = not len(ids) or ids.max() < 1 << 16
                raw, size = ids.astype("<u2" if short else "<u4").tobytes(), 2 if short else 4
                cut = (at * size).tolist()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(document_keys(ids, at), pa.int64()),
                     pa.array([raw[p:q] if short else b"\xff" + raw[p:q] for p, q in zip(cut, cut[1:])], pa.binary()),
                     pa.array(np.diff(at) * size, pa.int64())],
                    names=["doc_id", "key", "ids", "size"])

    return narrow(df, id_col, text_col).mapInArrow(tidy(run, "word ids"), "doc_id long, key long, ids binary, size long")


def pack(df: DataFrame, tokenizer_path: str, end_id: int = 0, length: int = LENGTH, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of all documents: where each lies in its document and in its sequence."""
    spark = df.sparkSession
    docs = staged(spark, keyed(df, tokenizer_path, end_id, id_col, text_col), "curve-keys")
    order = ["key", F.xxhash64("doc_id"), "place"]
    placed = docs.withColumn("place", F.monotonically_increasing_id())
    ordered = (placed.repartitionByRange(sized_partitions(docs, held=F.col("size") + 24), *order)
               .sortWithinPartitions(*order).select("doc_id", "ids", F.spark_partition_id().alias("part")))

    def run(batches):
        packer = None
        for b in batches:
            if packer is None and b.num_rows:
                packer = Packer(b.column(2)[0].as_py() << 33, length)
            for i, j, ids in text_slices(b, 1, 4 * SLICE_BYTES):
                for doc, data in zip(b.column(0).slice(i, j - i).to_pylist(), ids):
                    wide = len(data) % 2
                    packer.add(doc, np.frombuffer(data, "<u4", offset=1) if wide
                               else np.frombuffer(data, "<u2").astype("<u4"))
                yield packer.batch()
        if packer is not None:
            packer.end()
            yield packer.batch()

    return ordered.mapInArrow(tidy(run), PIECE)
