"""Language identification with a byte convolutional network.

The network (byte embeddings, filters of widths 2, 3 and 4, max pooling over
a window, softmax) starts in numpy on a bounded number of labelled whole
texts and, where there are more, learns from every labelled text in one pass of Spark's tasks (:mod:`conv_shards`).
It starts with ``PER_LANG`` documents a language by smallest hash, fewer where they
hold more than ``LANG_BYTES`` or, with many languages, their part of
``ALL_BYTES``; a language's shortest document is always among them.  A text to
learn from or to predict is cut into windows of ``WINDOW`` bytes (the last one padded), all windows of a slice run as one batch,
and a text's scores are its windows' probabilities, weighted by their bytes.

Filter responses come from tables: a byte's embedding times a filter slice is
one row, so the rows of byte pairs (65,536) give a response with one or two
look-ups a position.

Defined results: null text, empty text and text without a letter get ``und``
with score 0; so does every text when nothing can be learned (no labelled row).
Rows with null ``lang`` are predicted, not learned.  Ties go to the language
first in alphabet.  Repeated rows are predicted alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modenorm.llm import conv_shards
from modenorm.llm.common import carried, share, shared, staged, text_slices, tidy
from modenorm.llm.conv_text import ConvText

WINDOW = 256
PER_LANG = 400
LANG_BYTES, ALL_BYTES = 512 << 10, 32 << 20
WIDTHS = (2, 3, 4)
FILTERS = 8
EPOCHS = 4
SLICE_BYTES = 1 << 20
#: windows of a training step, and characters whose windows are mixed
BATCH, CHUNK_BYTES = 48, 1 << 18
_LETTER = regex.compile(r"\p{L}")


def training_rows(df: DataFrame, learnable, id_col: str, text_col: str, lang_col: str, per_lang: int) -> DataFrame:
    """At most ``per_lang`` rows a language, by smallest hash: ``lang`` and the whole text.

    Counts a language come first (no text is read), so only about twice the wanted rows pass the hash filter
    and are ranked, whatever the size of the table.  They are staged, so that Spark knows their size and
    broadcasts them only where they are small.
    """
    known = F.col(lang_col).isNotNull() & learnable
    counts = staged(df.sparkSession, df.where(known).groupBy(F.col(lang_col).alias("lang")).count(), "language-counts")
    room = min(LANG_BYTES, ALL_BYTES // max(1, counts.count()))
    key = (F.xxhash64(F.col(id_col).cast("string")) / F.lit(2.0 ** 64) + 0.5)
    rows = (df.where(known).select(F.col(lang_col).alias("lang"), F.col(id_col).cast("string").alias("id"),
                                   key.alias("u"), F.col(text_col).alias("text")).where(F.col("text").rlike(r"\p{L}"))
            .join(counts, "lang").where(F.expr(f"u < {2.0 * per_lang + 50} / count")))
    order = Window.partitionBy("lang").orderBy("u", "id", "text")
    size = F.octet_length("text").cast("long")
    return (rows.withColumn("rank", F.row_number().over(order))
            .withColumn("held", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("least", F.row_number().over(Window.partitionBy("lang").orderBy(size, "u", "id", "text")))
            .where((F.col("rank") <= per_lang) & (F.col("held") <= room) | (F.col("least") == 1))
            .orderBy("lang", "u", "id", "text").select("lang", "text"))


def windows_of(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, zeros after a text's last byte, and how many windows each has."""
    count = np.array([-(-len(d) // WINDOW) for d in data])
    flat = np.zeros(count.sum() * WINDOW, np.uint8)
    for d, s in zip(data, (np.cumsum(count) - count).tolist()):
        flat[s * WINDOW:s * WINDOW + len(d)] = np.frombuffer(d, np.uint8)
    return flat.reshape(-1, WINDOW), count


def fit(df: DataFrame, learnable=None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = PER_LANG) -> tuple[list[str], ConvText | None]:
    """Languages in alphabetic order and the trained network; ``learnable`` tells the rows it may learn from."""
    sample = training_rows(df, F.lit(True) if learnable is None else learnable, id_col, text_col, lang_col,
                           per_lang).collect()
    langs = sorted({r.lang for r in sample})
    if not langs:
        return [], None
    place = {lang: k for k, lang in enumerate(langs)}
    windows, count = windows_of([r.text.lower().encode() for r in sample])
    y = np.repeat([place[r.lang] for r in sample], count)
    net = ConvText(256, {"lang": len(langs)}, 8, FILTERS, WIDTHS)
    trainer = net.fit(np.arange(256)[:, None], list(windows), {"lang": y}, EPOCHS)
    every = (df.where(F.col(lang_col).isNotNull() & (F.lit(True) if learnable is None else learnable))
             .select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                     F.col(text_col).cast("string").alias("text"))
             .where(F.col("text").rlike(r"\p{L}")).withColumn("size", F.octet_length("text").cast("long")))
    total = every.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size")).first()
    if total.rows > len(sample):
        learn_all(every, max(1, -(-total["size"] // conv_shards.SHARD_BYTES)), trainer, place)
    return langs, net


def learn_all(rows: DataFrame, shards: int, trainer, place: dict[str, int]) -> None:
    """One pass over all texts; ``place``: languages' numbers."""
    key = F.xxhash64("id", "text")
    dealt = rows.select(F.pmod(key, F.lit(shards)).cast("int").alias("shard"), "text", "lang", "id", key.alias("key"))

    def lessons(batches):
        held, size, at = [], 0, None

        def steps():
            windows, count = windows_of([t.lower().encode() for t, _ in held])
            y = np.repeat([place[lang] for _, lang in held], count)
            order = np.random.default_rng(len(windows)).permutation(len(windows))
            for k in range(0, len(order), BATCH):
                own = order[k:k + BATCH]
                yield at, np.arange(256)[:, None], list(windows[own]), {"lang": y[own]}, None

        for b in batches:
            for i, j, texts in text_slices(b, 1, SLICE_BYTES):
                for shard, text, lang in zip(b.column(0).slice(i, j - i).to_pylist(), texts, b.column(2).slice(i, j - i).to_pylist()):
                    if held and (shard != at or size >= CHUNK_BYTES):
                        yield from steps()
                        held, size = [], 0
                    at = shard
                    held.append((text, lang))
                    size += len(text)
        if held:
            yield from steps()

    conv_shards.learn(dealt, shards, ["key", "id", "lang"], trainer, lessons)


class Scorer:
    """Response tables of byte pairs and single bytes for one network."""

    def __init__(self, net: ConvText):
        rows = net.item_rows(np.arange(256)[:, None]).reshape(256, -1, net.filters)
        one = {}
        k = 0
        for w in net.widths:
            for j in range(w):
                one[w, j] = rows[:, k]
                k += 1
        def pair(a, b):
            return np.ascontiguousarray((a[:, None] + b[None]).reshape(65536, -1))

        self.net = net
        self.plan = {w: ([(j, pair(one[w, j], one[w, j + 1])) for j in range(0, w - 1, 2)],
                         [(w - 1, np.ascontiguousarray(one[w, w - 1]))] if w % 2 else []) for w in net.widths}

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Class probabilities of each row of ``windows`` (n, WINDOW) uint8."""
        n, length = windows.shape
        pairs = windows[:, :-1].astype(np.uint16) << 8 | windows[:, 1:]
        pooled = []
        for w, (two, one) in self.plan.items():
            t = length - w + 1
            r = None
            for table, k, src in [(tab, j, pairs) for j, tab in two] + [(tab, j, windows) for j, tab in one]:
                got = np.take(table, src[:, k:k + t], axis=0)
                r = got if r is None else np.add(r, got, out=r)
            while r.shape[1] > 1:  # maximum by halves
                half = (r.shape[1] + 1) // 2
                r = np.maximum(r[:, :half], r[:, -half:])
            pooled.append(r[:, 0])
        return self.net.head("lang", np.concatenate(pooled, axis=1))

    def texts(self, texts: list[str]) -> np.ndarray:
        """Mean window probabilities of each text, weighted by bytes."""
        data = [t.lower().encode() for t in texts]
        windows, count = windows_of(data)
        starts = np.append(0, np.cumsum(count))
        weight = np.full(len(windows), float(WINDOW))
        weight[starts[1:] - 1] -= count * WINDOW - [len(d) for d in data]
        p = np.concatenate([self.probabilities(windows[i:i + 256]) for i in range(0, len(windows), 256)])
        total = np.add.reduceat(p * weight[:, None], starts[:-1])
        return total / np.add.reduceat(weight, starts[:-1])[:, None]


def predict(df: DataFrame, model: tuple[list[str], ConvText | None], id_col: str = "doc_id",
            text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row and the columns of ``keep``; the text is the only input."""
    langs, net = model
    sent = share(df.sparkSession, net)  # some thousand numbers, and 25 a language
    docs, names, kinds = carried(df, id_col, text_col, keep)

    def run(batches):
        own = shared(sent)
        scorer = None if own is None else Scorer(own)
        for b in batches:
            for i, j, texts in text_slices(b, 1, SLICE_BYTES):
                pred, score = ["und"] * (j - i), np.zeros(j - i)
                ok = [k for k in range(j - i) if scorer and texts[k] and _LETTER.search(texts[k])]
                if ok:
                    p = scorer.texts([texts[k] for k in ok])
                    for k, c, s in zip(ok, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                        pred[k], score[k] = langs[c], min(s, 1.0)
                rest = [b.column(2 + k).slice(i, j - i) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(pred, pa.string()), pa.array(score), *rest],
                    names=["doc_id", "lang_pred", "score", *names])

    found = docs.mapInArrow(tidy(run), "doc_id long, lang_pred string, score double" + kinds)
    return found.toDF("doc_id", "lang_pred", "score", *keep) if keep else found


def held_out(id_col: str = "doc_id", mod: int = 5, rest: int = 0):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == rest, F.lit(False))


def identify(df: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, predict all of them."""
    model = fit(df, ~held_out())
    return predict(df, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
