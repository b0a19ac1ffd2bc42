"""One pass of a network's training over all rows of a table.

Rows are dealt to shards of about ``SHARD_BYTES`` by a hash.  Every shard goes on from the same network and its
optimiser's state, reads its rows in their order and gives back what its steps changed; the changes are averaged:
an embedding's row by the steps that it took part in, all else by the texts learned.  What reaches the driver is the
size of the network, whatever the number of rows; the result does not depend on the number of partitions or tasks.
"""

from __future__ import annotations

import copy
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import share, shared, text_batches, tidy, tidy_group
from modenorm.llm.conv_text import Trainer

SHARD_BYTES = 32 << 20
#: embeddings that are averaged together
BLOCK = 1024
#: feature hashes are kept as places in a bitmap
SLOTS = 1 << 24
_BITS = SLOTS // 8 // 32


def shard_number(sizes: DataFrame) -> int:
    """Shards for rows whose bytes are in the column ``size``."""
    return max(1, math.ceil((sizes.agg(F.sum("size")).first()[0] or 0) / SHARD_BYTES))


def learn(rows: DataFrame, shards: int, order: list, trainer: Trainer, lessons) -> np.ndarray:
    """Train the network of ``trainer`` on all ``rows``; the sorted slots of the feature hashes that the rows hold.

    ``lessons(batches)`` makes steps of a task's Arrow batches: ``shard, features, texts, labels, met`` with the
    feature hashes that it meets for the first time, or None.  A shard's rows (column ``shard``) come one after another, by ``order``.
    """
    spark = rows.sparkSession
    sent = share(spark, trainer)  # the size of the network
    text_batches(spark)

    def run(batches):
        base = shared(sent)
        at = own = None
        for shard, features, texts, labels, met in lessons(batches):
            if shard != at:
                if own is not None:
                    yield changes(at, base.net, own.net, took, learned, bits)
                at, own = shard, copy.deepcopy(base)
                own.rng = np.random.default_rng(shard)
                took, learned, bits = np.zeros(len(own.net.emb), np.float32), 0, np.zeros(SLOTS // 8, np.uint8)
            if met is not None:
                np.bitwise_or.at(bits, met >> 3, (1 << (met & 7)).astype(np.uint8))
            took[own.step(features, texts, labels)] += 1
            learned += len(texts)
        if own is not None:
            yield changes(at, base.net, own.net, took, learned, bits)

    found = (rows.repartitionById(shards, "shard").sortWithinPartitions("shard", *order)
             .mapInArrow(tidy(run), "part int, shard int, weight binary, change binary")
             .groupBy("part").applyInArrow(tidy_group(merged), "part int, change binary").collect())
    net, bits = trainer.net, np.zeros(SLOTS // 8, np.uint8)
    for r in found:
        if r.part >= 0:
            own = net.emb[r.part * BLOCK:(r.part + 1) * BLOCK]
            own += np.frombuffer(r.change, np.float32).reshape(own.shape)
        elif r.part == -1:
            change, k = np.frombuffer(r.change, np.float32), 0
            for x in net.dense():
                x += change[k:k + x.size].reshape(x.shape)
                k += x.size
        else:
            bits[(-2 - r.part) * _BITS:(-1 - r.part) * _BITS] = np.frombuffer(r.change, np.uint8)
    return np.flatnonzero(np.unpackbits(bits, bitorder="little"))


def changes(shard: int, base, net, took: np.ndarray, learned: int, bits: np.ndarray) -> pa.RecordBatch:
    """A shard's changes in parts: blocks of embeddings from 0 on, -1 for all dense arrays, the met slots below."""
    part, weight, change = [], [], []
    for k in range(0, len(took), BLOCK):
        if took[k:k + BLOCK].any():
            part.append(k // BLOCK)
            weight.append(took[k:k + BLOCK].tobytes())
            change.append((net.emb[k:k + BLOCK] - base.emb[k:k + BLOCK]).tobytes())
    part.append(-1)
    weight.append(np.float32([learned]).tobytes())
    change.append(np.concatenate([(x - y).ravel() for x, y in zip(net.dense(), base.dense())]).astype(np.float32).tobytes())
    for k in range(0, len(bits), _BITS):
        if bits[k:k + _BITS].any():
            part.append(-2 - k // _BITS)
            weight.append(b"")
            change.append(bits[k:k + _BITS].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([shard] * len(part), pa.int32()),
                                       pa.array(weight, pa.binary()), pa.array(change, pa.binary())],
                                      names=["part", "shard", "weight", "change"])


def merged(table: pa.Table) -> pa.Table:
    """The mean of all shards' changes of a part, or all their bits."""
    table = table.sort_by("shard")  # so that sums don't depend on the order of arrival
    part, total, weights = table["part"][0].as_py(), None, 0
    for w, c in zip(table["weight"], table["change"]):
        if part < -1:
            own = np.frombuffer(c.as_py(), np.uint8)
            total = own if total is None else total | own
        else:
            w = np.frombuffer(w.as_py(), np.float32).astype(float)
            own = np.frombuffer(c.as_py(), np.float32).reshape(len(w), -1) * w[:, None]
            total, weights = own if total is None else total + own, weights + w
    if part >= -1:
        total = (total / np.maximum(weights, 1)[:, None]).astype(np.float32)
    return pa.table({"part": pa.array([part], pa.int32()), "change": pa.array([total.tobytes()], pa.binary())})
