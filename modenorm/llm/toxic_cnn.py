"""Toxicity: a convolutional classifier over hashed word embeddings, with thresholds calibrated by language.

A word's embedding is the sum of hashed embeddings of the word and of its
first 4, 5 and 6 letters.  Filters of widths 1, 2 and 3, max pooling over the
whole text, then two softmax heads: toxic or not, and the language.  Training
starts in numpy on a bounded number of labelled documents (``PER_CLASS`` a class
by smallest hash, whole texts; fewer rows where those hold more than
``CLASS_BYTES``).  Where there are more, the network goes on over every labelled text in Spark's tasks
(:mod:`conv_shards`).  A quarter of all labelled texts is not learned and calibrates.  Where that quarter holds fewer
than ``MIN_HELD`` texts of either class, the network learns from all texts instead and is calibrated on ``FOLDS``
networks' scores of the texts that each has not seen.  The language head is only a target in training; when a text is
scored its language is read from the text.

Calibration: for each language the threshold on the raw probability lies in
the middle of the widest gap (in log odds) that gives the best F1, and the
score is shifted in log odds so that this threshold becomes 0.7.  Beyond the bounded number of documents, log odds
are counted in steps of 0.01.  Languages
with fewer than ``MIN_CALIBRATION`` texts of either class use the threshold of
all languages.

Defined results: null and empty texts, texts without words, and texts without a
word of which the learned texts held any feature get the score of an empty
text, which is never above 0.01; without labels of both classes every score is
0.  Repeated labels of a document count once (1 wins); labels that
are null are not learned.  Repeated rows are scored alike.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modenorm.llm import conv_shards
from modenorm.llm.common import carried, share, shared, text_slices, tidy, trim, worker_cache
from modenorm.llm.conv_text import STEP_ITEMS, ConvText, Trainer, bounded

BUCKETS = 1 << 16
PREFIXES = (4, 5, 6)
WIDTHS = (1, 2, 3)
FILTERS = 16
PER_CLASS = 2000
#: bytes of a class's training texts; a row that no longer fits is passed over
CLASS_BYTES = 12 << 20
EPOCHS = 8
#: texts of a training step, and steps that a small sample gets at least
BATCH, MIN_STEPS = 48, 120
#: a few words of each clean text are learned as a clean text of their own, so that short texts are not toxic for want of words
PART_WORDS = 8
MIN_CALIBRATION = 8
MIN_HELD, FOLDS = 50, 4
CUT = 0.7
WORD_ROWS = 120_000
SLICE_BYTES = 1 << 20
#: bytes of texts that are scored at once
SCORE_BYTES = 1 << 18
#: new words whose rows are made at once; texts of a task, and their characters, that are mixed when learned
ITEM_ROWS = 8192
CHUNK_TEXTS, CHUNK_SIZE = 480, 1 << 20
#: response of a place without a word; places of a text that are pooled together
VOID, BLOCK = -np.inf, 8
#: words of training texts that are pooled at once
POOL_WORDS = 100_000
_STRIP = ".,;:!?\"'()[]{}<>*#$%&|-_…«»“”‘’¡¿"


#: words of more bytes are hashed one by one
LONG_WORD = 48
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def _turns(length: int) -> np.ndarray:
    """What turns the state after a word's first bytes (by their number) into the hash of a prefix of ``length``.

    A CRC is linear: only the state that the bytes start from differs, and a state is carried on without them.
    """
    s, out = np.uint32(zlib.crc32(f"{length}:".encode())), []  # the two states' difference
    for _ in range(4 * length + 1):
        out.append(s ^ _ONES)
        s = _CRC[s & 255] ^ (s >> 8)
    return np.array(out, np.uint32)


_TURNS = [_turns(n) for n in PREFIXES]


def features(word: str) -> list[int]:
    """Hashes below ``conv_shards.SLOTS`` of a word and its prefixes, -1 where it has none."""
    w = word.strip(_STRIP).lower()
    if not w:
        return [-1] * (1 + len(PREFIXES))
    crc, slots = zlib.crc32, conv_shards.SLOTS
    return [crc(w.encode()) % slots] + [crc(f"{n}:{w[:n]}".encode()) % slots if len(w) >= n else -1 for n in PREFIXES]


def hashes(words) -> np.ndarray:
    """:func:`features` of every word (none holds a line end): a place of all words at a time, not a word."""
    words = list(words)
    parts = [_hashes(words[k:k + ITEM_ROWS]) for k in range(0, len(words), ITEM_ROWS)]
    return np.concatenate(parts) if parts else np.empty((0, 1 + len(PREFIXES)), np.int64)


def _hashes(words: list[str]) -> np.ndarray:
    text = np.frombuffer(("\n".join([w.strip(_STRIP) for w in words]).lower() + "\n").encode(), np.uint8)
    chars = np.flatnonzero((text & 0xC0) != 0x80)  # where characters begin
    ends = np.flatnonzero(text[chars] == 10)
    n = np.diff(ends, prepend=-1) - 1  # characters of a word
    begins = ends - n
    start = chars[begins]
    size = chars[ends] - start
    order = np.argsort(-size, kind="stable")  # so that the words that go on come first
    order = order[size[order] <= LONG_WORD]
    states = np.empty((LONG_WORD + 1, len(words)), np.uint32)
    states[0] = _ONES
    going = np.searchsorted(-size[order], -np.arange(LONG_WORD), side="left")  # words of more bytes than the place
    for k, m in enumerate(going[going > 0]):
        own = order[:m]
        s = states[k, own]
        states[k + 1, own] = _CRC[(s ^ text[start[own] + k]) & 255] ^ (s >> 8)
    out = np.full((len(words), 1 + len(PREFIXES)), -1, np.int64)
    has = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    out[has, 0] = (states[size[has], has] ^ _ONES) % conv_shards.SLOTS
    for j, (length, turn) in enumerate(zip(PREFIXES, _TURNS), 1):
        own = has[n[has] >= length]
        stop = chars[begins[own] + length] - start[own]
        out[own, j] = (states[stop, own] ^ turn[stop]) % conv_shards.SLOTS
    for k in np.flatnonzero(size > LONG_WORD):
        out[k] = features(words[k])
    return out


class ToxicModel:
    """``met``: the feature hashes of the learned texts' words, sorted; no other feature counts."""

    def __init__(self, net: ConvText, langs: list[str], met: np.ndarray):
        self.net, self.langs = net, langs
        bits = np.zeros(conv_shards.SLOTS, bool)
        bits[met] = True
        self.bits = np.packbits(bits, bitorder="little")
        self.shift = np.zeros(len(langs) + 1)

    @property
    def met(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.bits, bitorder="little"))

    def buckets(self, codes: np.ndarray) -> np.ndarray:
        """Embedding rows of feature hashes, -1 for features that the learned texts had not."""
        known = (codes >= 0) & (self.bits[codes >> 3] >> (codes & 7) & 1 > 0)
        return np.where(known, codes % BUCKETS, -1)

    def pooled(self, rows: np.ndarray, idx: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Max responses of texts given as places ``idx`` in item table ``rows``, whose place 0 is :data:`VOID`.

        A text takes whole blocks of places, filled up with void ones, so that the maximum goes over blocks at once and
        no filter reaches into the next text.
        """
        f, out, k = self.net.filters, [], 0
        room = -(-(sizes + max(self.net.widths) - 1) // BLOCK) * BLOCK
        starts = np.cumsum(room) - room
        at = np.zeros(room.sum(), idx.dtype)
        at[np.arange(len(idx)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)] = idx
        for w in self.net.widths:
            r = rows[k].take(at, axis=0)
            for j in range(1, w):
                r[:-j] += rows[k + j].take(at[j:], axis=0)
            best = np.maximum.reduceat(r.reshape(-1, BLOCK * f), starts // BLOCK).reshape(-1, BLOCK, f).max(axis=1)
            best[sizes < w] = -1
            out.append(best)
            k += w
        return np.concatenate(out, axis=1)

    def scores(self, pooled: np.ndarray, empty: np.ndarray) -> np.ndarray:
        logit, lang = self.raw(pooled)
        z = logit + self.shift[lang]
        score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return np.where(empty, np.minimum(score, 0.01), score)

    def raw(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = np.clip(self.net.head("toxic", pooled)[:, 1].astype(float), 1e-9, 1 - 1e-9)
        lang = self.net.head("lang", pooled).argmax(axis=1) if self.langs else np.zeros(len(p), int)
        return np.log(p / (1 - p)), lang


def places(first: int) -> dict[str, int]:
    """Places of words from ``first`` on; a word that is looked up for the first time gets the next."""
    return defaultdict(count(first).__next__)


def newest(index: dict[str, int], n: int) -> list[str]:
    """The ``n`` words that came last, in their order."""
    return list(islice(reversed(index), n))[::-1]


class WordTable:
    """Item rows of the words met so far; emptied when full."""

    def __init__(self, model: ToxicModel):
        self.model, self.n, self.rows, self.known = model, sum(model.net.widths), None, np.zeros(1, bool)
        self.clear()

    def clear(self) -> None:
        self.index = places(1)
        if self.rows is None or self.rows.shape[1] > 1 + WORD_ROWS:
            self.rows = np.full((self.n, 1, self.model.net.filters), VOID, np.float32)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [t.split() for t in texts]
        sizes = np.array([len(ws) for ws in words])

        def numbers():
            return np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), np.int64, sizes.sum())

        at = len(self.index)
        idx = numbers()
        if at and len(self.index) > WORD_ROWS:
            self.clear()
            at, idx = 0, numbers()
        need = newest(self.index, len(self.index) - at)
        if need:
            self.add(need, at + 1)
        empty = np.ones(len(sizes), bool)
        has = np.flatnonzero(sizes)
        if len(has):
            empty[has] = ~np.logical_or.reduceat(self.known[idx], (np.cumsum(sizes) - sizes)[has])
        return self.model.pooled(self.rows, idx, sizes), empty

    def add(self, words: list[str], at: int) -> None:
        """Item rows of new words, from place ``at`` on."""
        feats = self.model.buckets(hashes(words))
        if self.rows.shape[1] < at + len(words):
            rows = np.zeros((self.n, 1 + max(WORD_ROWS, at + len(words) - 1), self.model.net.filters), np.float32)
            rows[:, :at] = self.rows[:, :at]
            self.rows = rows
        self.known = np.append(self.known[:at], (feats >= 0).any(axis=1))
        for k in range(0, len(words), ITEM_ROWS):
            new = self.model.net.item_rows(feats[k:k + ITEM_ROWS])
            self.rows[:, at + k:at + k + len(new)] = new.reshape(len(new), self.n, -1).transpose(1, 0, 2)


def label_marks(labels: DataFrame, learnable) -> DataFrame:
    """``doc_id, toxic`` once a document: the labels that may be learned; ``fold`` parts them evenly."""
    return (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
            .where(learnable).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("fold", fold()))


def fold():
    return F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, learnable, per_class: int) -> list:
    """The bounded rows that training starts with: (text, toxic, lang), see :func:`first_rows`."""
    return [r[:3] for r in first_rows(docs, label_marks(labels, learnable), per_class)[0]]


def first_rows(docs: DataFrame, marks: DataFrame, per_class: int) -> tuple[list, bool]:
    """At most ``per_class`` labelled texts of either class, by smallest hash: (text, toxic, lang, fold); and whether all fitted.

    The ids come from the narrow label table (a count, a hash filter, a bounded top list); only these are
    joined with the texts, as a broadcast of at most ``2 * per_class`` ids; of an id's rows one is learned, so that no
    repeated id crowds out the others.  The texts' sizes come first, so that
    only whole texts of rows that fit in ``CLASS_BYTES`` reach the driver.
    """
    key = F.xxhash64("doc_id")
    picked = None
    for c in (0, 1):
        part = marks.where(F.col("toxic") == c).orderBy(key, "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
    text_key = F.xxhash64("text")
    rows = (texts.join(F.broadcast(picked), "doc_id")
            .select("doc_id", text_key.alias("text_key"), "toxic", "lang", "fold", F.octet_length("text").alias("size"))
            .withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy("text_key", "lang")))
            .where("nth = 1").orderBy(key, "doc_id").collect())
    held = [r for r in rows if r["size"]]
    rows = fitting(held)
    wanted = sorted({(r.doc_id, r.text_key) for r in rows})
    # as an Arrow table: a list of rows would start Python workers of its own kind beside the others
    wanted = docs.sparkSession.createDataFrame(
        pa.table([pa.array([w[k] for w in wanted], pa.int64()) for k in (0, 1)], ["doc_id", "wanted"]), "doc_id long, wanted long")
    found = (texts.join(F.broadcast(wanted), "doc_id").where(text_key == F.col("wanted"))
             .groupBy("doc_id", "wanted").agg(F.first("text").alias("text")).collect())
    whole = {(r.doc_id, r.wanted): r.text for r in found}
    return [(whole[r.doc_id, r.text_key], r.toxic, r.lang, r.fold) for r in rows], len(rows) == len(held)


def fitting(rows: list) -> list:
    """The rows whose texts fit together in ``CLASS_BYTES`` a class, in their order; the smallest where none does."""
    left, out = {}, []
    for r in rows:
        room = left.setdefault(r.toxic, CLASS_BYTES)
        if r["size"] <= room:
            left[r.toxic] = room - r["size"]
            out.append(r)
    for c in left.keys() - {r.toxic for r in out}:
        out.append(min((r for r in rows if r.toxic == c), key=lambda r: r["size"]))
    return out


def fit(docs: DataFrame, labels: DataFrame, learnable=None, per_class: int = PER_CLASS) -> ToxicModel | None:
    """Learn from all labelled documents; ``learnable``, an expression of ``doc_id``, tells which labels may be learned."""
    learnable = F.lit(True) if learnable is None else learnable
    marks = label_marks(labels, learnable)
    rows, fitted = first_rows(docs, marks, per_class)
    rows = [r for r in rows if r[0].split()]
    if len({r[1] for r in rows}) < 2:
        return None
    sizes = {(r.toxic, r.fold): r["count"] for r in marks.groupBy("toxic", "fold").count().collect()}
    if not fitted or any(sum(n for (c, _), n in sizes.items() if c == k) > per_class for k in (0, 1)):
        return fit_all(docs, marks, learnable, rows, sizes)
    langs = sorted({r[2] for r in rows if r[2] is not None})
    feats, met, texts, toxic, lang = encoded(rows, langs)
    del rows
    every = np.arange(len(texts))
    last = every % 4 == 3
    few = min(toxic[last].sum(), (1 - toxic[last]).sum()) < MIN_HELD

    def train(own) -> ToxicModel:
        return ToxicModel(started(feats, texts, toxic, lang, langs, own).net, langs, met)

    model = train(every if few else every[~last])
    logit, read = model.raw(pool(model, feats, texts))
    if few:
        for f in range(FOLDS):
            own = np.zeros(len(texts), bool)
            for c in (0, 1):  # every fold has its share of both classes
                own[np.flatnonzero(toxic == c)[f::FOLDS]] = True
            if len({*toxic[~own]}) == 2 and own.any():
                at = np.flatnonzero(own)
                other = train(every[~own])
                logit[at] = other.raw(pool(other, feats, [texts[i] for i in at]))[0]
    calibrate(model, logit, read, toxic, 1 - toxic, np.ones(len(toxic), bool) if few else last)
    trim()
    return model


def encoded(rows: list, langs: list[str]):
    """Word features, met feature hashes, texts as word numbers, classes and languages of ``rows``."""
    vocab: dict[str, int] = {}
    texts = [np.array([vocab.setdefault(w, len(vocab)) for w in r[0].split()], np.int32) for r in rows]
    toxic = np.array([r[1] for r in rows])
    lang = np.array([langs.index(r[2]) if r[2] is not None else -1 for r in rows])
    codes = hashes(vocab)
    return np.where(codes >= 0, codes % BUCKETS, -1).astype(np.int32), np.unique(codes[codes >= 0]), texts, toxic, lang


def part_of(text: np.ndarray, rng) -> np.ndarray:
    at = rng.integers(len(text))
    return text[at:at + rng.integers(1, PART_WORDS + 1)]


def started(feats, texts, toxic, lang, langs, own) -> Trainer:
    """A network trained on the texts numbered ``own``."""
    net = ConvText(BUCKETS, {"toxic": 2, "lang": max(1, len(langs))}, 16, FILTERS, WIDTHS)
    clean, rng = own[toxic[own] == 0], np.random.default_rng(5)
    parts = [part_of(texts[i], rng) for i in clean]
    return net.fit(feats, [texts[i] for i in own] + parts,
                   {"toxic": np.append(toxic[own], toxic[clean]), "lang": np.append(lang[own], lang[clean])},
                   max(EPOCHS, -(-MIN_STEPS * BATCH // len(own))), batch=BATCH, drop_first=0.5)


def fit_all(docs: DataFrame, marks: DataFrame, learnable, rows: list, sizes: dict) -> ToxicModel:
    """Train on every labelled text, calibrate on every one that was set aside; ``rows``: those to start with."""
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"))
             .where("doc_id IS NOT NULL").where(learnable).withColumn("fold", fold()))
    spoken = texts.where("lang IS NOT NULL").select("doc_id", "lang").join(marks, "doc_id", "left_semi")
    langs = sorted(r.lang for r in spoken.select("lang").distinct().collect())
    shards = conv_shards.shard_number(texts.select(F.octet_length("text").alias("size")))
    last = FOLDS - 1
    few = min(sizes.get((c, last), 0) for c in (0, 1)) < MIN_HELD

    def train(aside: int) -> ToxicModel:
        first = [r for r in rows if r[3] != aside]
        if len({r[1] for r in first}) < 2:
            first = rows
        feats, met, words, toxic, lang = encoded(first, langs)
        trainer = started(feats, words, toxic, lang, langs, np.arange(len(words)))
        del feats, words
        more = learn_all(texts.where(F.col("fold") != aside), marks.where(F.col("fold") != aside), shards, trainer, langs)
        trim()
        return ToxicModel(trainer.net, langs, np.union1d(met, more))

    model = train(-1 if few else last)
    if few:
        found = None
        for f in range(FOLDS):
            own = counted(texts.where(F.col("fold") == f), marks, train(f))
            found = own if found is None else found.unionByName(own)
    else:
        found = counted(texts.where(F.col("fold") == last), marks, model)
    bins = found.groupBy("z", "read").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).orderBy("z", "read").collect()
    z, read, pos, n = (np.array([r[k] for r in bins]) for k in range(4))
    if len(bins):
        calibrate(model, z, read, pos, n - pos, np.ones(len(bins), bool))
    return model


def learn_all(texts: DataFrame, marks: DataFrame, shards: int, trainer: Trainer, langs: list[str]) -> np.ndarray:
    """One pass over all labelled texts; the feature hashes that they hold.

    Labels and texts of a document meet in its shard: the label comes first, and one text after it is learned.
    """
    key, place = F.xxhash64("doc_id"), {lang: k for k, lang in enumerate(langs)}
    dealt = (texts.select("doc_id", "text", "lang", F.lit(None).cast("int").alias("toxic"))
             .unionByName(marks.select("doc_id", F.lit(None).cast("string").alias("text"),
                                       F.lit(None).cast("string").alias("lang"), "toxic"))
             .select(F.pmod(key, F.lit(shards)).cast("int").alias("shard"), "text", "doc_id", "lang", "toxic",
                     key.alias("key"), F.xxhash64("text").alias("text_key")))

    def lessons(batches):
        index, feats = places(0), np.zeros((0, 1 + len(PREFIXES)), np.int32)
        held, size, at, marked = [], 0, None, None

        def steps():
            nonlocal index, feats
            words = [t.split() for t, _, _ in held]
            if len(index) > WORD_ROWS:
                index, feats = places(0), feats[:0]
            own = [np.fromiter(map(index.__getitem__, ws), np.int32, len(ws)) for ws in words]
            need = newest(index, len(index) - len(feats))
            codes = hashes(need)
            feats = np.concatenate([feats, np.where(codes >= 0, codes % BUCKETS, -1).astype(np.int32)])
            toxic, lang = np.array([c for _, c, _ in held]), np.array([place.get(k, -1) for _, _, k in held])
            rng, clean = np.random.default_rng(len(need)), np.flatnonzero(toxic == 0)
            del words, need
            parts = [part_of(own[i], rng) for i in clean]
            own, toxic, lang = own + parts, np.append(toxic, toxic[clean]), np.append(lang, lang[clean])
            order = rng.permutation(len(own))
            met = codes[codes >= 0]
            for part in (p for k in range(0, len(order), BATCH) for p in bounded(order[k:k + BATCH], own, STEP_ITEMS)):
                yield at, feats, [own[i] for i in part], {"toxic": toxic[part], "lang": lang[part]}, met
                met = None

        for b in batches:
            for i, j, found in text_slices(b, 1, SLICE_BYTES):
                for shard, text, doc, lang, toxic in zip(b.column(0).slice(i, j - i).to_pylist(), found,
                                                         *[b.column(k).slice(i, j - i).to_pylist() for k in (2, 3, 4)]):
                    if toxic is not None:
                        marked = doc, toxic
                        continue
                    if marked is None or marked[0] != doc:
                        continue
                    c, marked = marked[1], None
                    if not text or not text.strip():
                        continue
                    if held and (shard != at or len(held) >= CHUNK_TEXTS or size >= CHUNK_SIZE):
                        yield from steps()
                        held, size = [], 0
                    if shard != at:
                        index, feats, at = places(0), feats[:0], shard
                    held.append((text, c, lang))
                    size += len(text)
        if held:
            yield from steps()

    order = ["key", "doc_id", F.col("toxic").asc_nulls_last(), "text_key", "lang"]
    return conv_shards.learn(dealt, shards, order, trainer, lessons)


def counted(texts: DataFrame, marks: DataFrame, model: ToxicModel) -> DataFrame:
    """``z, read, toxic`` of every labelled document: log odds in steps of 0.01 and the language read from its text."""
    found = responses(texts.withColumn("text_key", F.xxhash64("text")), model, "doc_id", "text", ("text_key", "lang"), True)
    one = found.groupBy("doc_id").agg(F.min(F.struct("text_key", "lang", "z", "read")).alias("own"))
    return (one.where("own.z IS NOT NULL").join(marks, "doc_id")
            .select((F.round(F.col("own.z") * 100) / 100).alias("z"), F.col("own.read").alias("read"), "toxic"))


def pool(model: ToxicModel, feats: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Max responses of texts given as items of ``feats``, a bounded number of words at a time."""
    out = []
    for own in bounded(range(len(texts)), texts, POOL_WORDS):
        items, idx = np.unique(np.concatenate([texts[i] for i in own]), return_inverse=True)
        table = model.net.item_rows(feats[items]).reshape(len(items), sum(WIDTHS), -1).transpose(1, 0, 2)
        table = np.concatenate([np.full_like(table, VOID, shape=(len(table), 1, table.shape[2])), table], axis=1)
        out.append(model.pooled(table, idx + 1, np.array([len(texts[i]) for i in own])))
    return np.concatenate(out)


def calibrate(model: ToxicModel, logit: np.ndarray, lang: np.ndarray, pos: np.ndarray, neg: np.ndarray, held: np.ndarray) -> None:
    """Shift the log odds of each language so that the threshold found on the rows ``held`` becomes ``CUT``.

    ``pos``, ``neg``: how many toxic and clean texts a row stands for.
    """
    def threshold(rows):
        order = np.argsort(logit[rows])
        z, p, n = logit[rows][order], pos[rows][order], neg[rows][order]
        tp, fp = p[::-1].cumsum()[::-1], n[::-1].cumsum()[::-1]
        f1 = 2 * tp / (tp + fp + p.sum())
        cut, below = z[1:], z[:-1]
        best = np.flatnonzero(f1[1:] >= f1[1:].max() - 1e-12)
        k = best[np.argmax((cut - below)[best])]
        return (cut[k] + below[k]) / 2

    def enough(rows):
        return min(pos[rows].sum(), neg[rows].sum()) >= MIN_CALIBRATION and len({*logit[rows]}) > 1

    goal = np.log(CUT / (1 - CUT))
    rows = held if enough(held) else np.ones(len(pos), bool)
    model.shift[:] = goal - (threshold(rows) if pos[rows].any() and neg[rows].any() and rows.sum() > 1 else 0.0)
    for k in range(len(model.langs)):
        own = held & (lang == k)
        if enough(own):
            model.shift[k] = goal - threshold(own)


def score(df: DataFrame, model: ToxicModel | None, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score`` of every row and the columns of ``keep``; the text is the only input."""
    return responses(df, model, id_col, text_col, keep, False)


def responses(df: DataFrame, model: ToxicModel | None, id_col: str, text_col: str, keep: tuple[str, ...], raw: bool) -> DataFrame:
    """Scores, or (``raw``) log odds ``z``, null without a word, and the number of the language ``read``."""
    sent = share(df.sparkSession, model)  # 4 MB of weights and 2 MB of met features
    token = uuid.uuid4().hex
    docs, names, kinds = carried(df, id_col, text_col, keep)
    made = ["z", "read"] if raw else ["score"]

    def run(batches):
        def table():
            own = shared(sent)
            return None if own is None else WordTable(own)

        words = worker_cache("toxic words", token, table)
        for b in batches:
            for i, j, texts in text_slices(b, 1, SCORE_BYTES):
                if words is None:
                    got = [pa.array(np.zeros(j - i))]
                elif raw:
                    z, read = words.model.raw(words.texts([t or "" for t in texts])[0])
                    got = [pa.array(z, mask=np.array([not (t and t.strip()) for t in texts])), pa.array(read, pa.int32())]
                else:
                    got = [pa.array(words.model.scores(*words.texts([t or "" for t in texts])))]
                rest = [b.column(2 + k).slice(i, j - i) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *got, *rest],
                                                 names=["doc_id", *made, *names])

    found = docs.mapInArrow(tidy(run, "toxic words"), "doc_id long, " + ("z double, read int" if raw else "score double") + kinds)
    return found.toDF("doc_id", *made, *keep) if keep else found


def held_out(id_col: str = "doc_id", mod: int = 3, rest: int = 1):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == rest, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels that are not held out, score every document."""
    model = fit(docs, labels, ~held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                     (F.col("score") >= CUT).cast("int").alias("predicted"))
