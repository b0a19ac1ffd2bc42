"""Removal of repeated passages by prefix-free parsing.

A byte is removed when a string of ``SPAN`` bytes that covers it also starts in
a document with a smaller id.

1. *Parse.*  The trigger of a ``SPAN``-byte window is the smallest rolling hash of
   its ``GRAM``-byte substrings, so equal windows have equal triggers.  A phrase is
   a run of windows with one trigger (``GRAM``..``SPAN`` windows overlap between
   neighbouring phrases by ``SPAN - 1`` bytes, so each window lies in exactly one
   phrase).
2. *Dictionary.*  Phrases meet by trigger: tasks send (trigger, phrase hash, document) in
   packed blocks, equal phrases of one slice only once.  A phrase also found in a
   smaller document is removed there and then; the first occurrence of a phrase is
   a dictionary entry.  An entry whose trigger belongs to no other phrase can't
   share a window with anything; only the others go on.
3. *Suffix arrays.*  Those entries meet again by trigger with their bytes.  Each
   bucket sorts the suffixes of its part of the dictionary (to depth ``SPAN``, by
   8-byte words, refining ties); neighbours equal to that depth are one window,
   and it is removed from every entry but those of its smallest document.
   Triggers with very many entries are cut into single windows, dealt by their
   bytes, equal ones of one slice only once: no bucket gathers a hot passage.
4. *Removal.*  A document's removed windows are those of its removed phrases and
   those found in step 3, by a mask over the replies; their bytes go.

The method's suffix array of the parse and the corpus order it gives are not built:
phrases are grouped by hash instead, which is all that the removal asks for.

Fingerprints: triggers have 32 bits and the partition, phrases 64 bits beside
the trigger (96 and the partition together); within one document phrases are
told apart by these 64 bits; windows in step 3 are compared as bytes and
reported by 64-bit hash within one document.

Defined results: null and empty texts have 0 bytes; texts shorter than ``SPAN``
lose nothing.  Rows with a null id lose nothing and take nothing.  Rows with
equal ids do not take from each other.  Very long texts are whole.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import U64, carried, mix64, staged, text_slices, tidy, tidy_group

SPAN = 50
GRAM = 24
#: windows a phrase has at most: those that can share one trigger
MOST = SPAN - GRAM + 1
#: a parse works on about this much text at once (its arrays then fit the processor's cache)
PARSE_BYTES = 1 << 16
#: text whose phrases are sent together
SLICE_BYTES = 4 << 20
#: phrases a partition of the dictionary exchange holds about
PARTITION_PHRASES = 1_000_000
#: a trigger with more entries than this is dealt by windows
HOT_ENTRIES = 512
_A, _C = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
_TABLE = np.random.default_rng(91).integers(1, 1 << 63, 256).astype(U64) * U64(2) + U64(1)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a string from the hashes of its two parts."""
    out = a ^ (a >> U64(29))
    out *= _A
    out += b
    return out


def rolling(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``GRAM``- and the ``SPAN``-byte string at every place (len >= SPAN)."""
    n = len(data)
    h1 = _TABLE[data]
    h2 = _pair(h1[:-1], h1[1:])
    h4 = _pair(h2[:-2], h2[2:])
    h8 = _pair(h4[:-4], h4[4:])
    h16 = _pair(h8[:-8], h8[8:])
    gram = mix64(_pair(h16[:n - 23], h8[16:16 + n - 23]))
    h32 = _pair(h16[:-16], h16[16:])
    h48 = _pair(h32[:n - 47], h16[32:32 + n - 47])
    return gram, mix64(_pair(h48[:n - 49], h2[48:48 + n - 49]))


class Parse:
    """Phrases of a slice of documents: ``first`` and ``last`` window, trigger, 64-bit code, document number."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        n = len(self.data)
        self.first = self.last = self.doc = np.zeros(0, np.int64)
        self.trigger = self.code = self.window = np.zeros(0, U64)
        long = np.flatnonzero(self.sizes >= SPAN)
        if not len(long):
            return
        gram, self.window = rolling(self.data)
        low = np.minimum(gram[:-1], gram[1:])
        for step in (2, 4, 8):
            low = np.minimum(low[:-step], low[step:])
        count = n - SPAN + 1
        low = np.minimum(low[:count], low[MOST - 16:MOST - 16 + count])
        edge = np.zeros(count + 1, np.int8)
        edge[self.starts[long]] = 1
        edge[(self.starts + self.sizes - SPAN + 1)[long]] -= 1
        valid = np.cumsum(edge[:count], dtype=np.int8) > 0
        change = np.flatnonzero((low[1:] != low[:-1]) | (valid[1:] != valid[:-1])) + 1
        first, end = np.append(0, change), np.append(change, count)
        inside = valid[first]
        first, end = first[inside], end[inside]
        pieces = -(-(end - first) // MOST)
        if pieces.max() > 1:  # one trigger again and again: periodic text
            k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, end = np.repeat(first, pieces) + k * MOST, np.repeat(end, pieces)
            end = np.minimum(first + MOST, end)
        self.first, self.last = first, end - 1
        self.trigger = mix64(low[first] ^ _C)
        span = self.window[first] * _A + self.window[self.last] + (self.last - first).astype(U64) * _C
        self.code = mix64(span)
        self.doc = long[np.searchsorted(self.starts[long], first, "right") - 1]

    def marked(self, phrases: np.ndarray) -> np.ndarray:
        """Window starts of the given phrases (a mask over phrases)."""
        size = (self.last - self.first + 1)[phrases]
        return np.repeat(self.first[phrases] - (np.cumsum(size) - size), size) + np.arange(size.sum())

    def among(self, codes: np.ndarray, doc: np.ndarray, wanted: list[np.ndarray]) -> np.ndarray:
        """Which of the documents' codes are among those wanted of the same document."""
        if not len(codes) or not any(len(w) for w in wanted):
            return np.zeros(len(codes), bool)
        shift = np.arange(len(wanted)).astype(U64) * _C
        own = np.concatenate([w + shift[k] for k, w in enumerate(wanted)])
        return np.isin(codes + doc.astype(U64) * _C, own)


def grouped(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """An order in which equal (major, minor) pairs are neighbours, by major."""
    order = np.argsort(major)
    by, within = major[order], minor[order]
    same = by[1:] == by[:-1]
    mixed = np.flatnonzero(same & (within[1:] != within[:-1]))
    if len(mixed):
        group = np.append(0, np.cumsum(~same))
        several = np.zeros(group[-1] + 1, bool)
        several[group[mixed]] = True
        at = np.flatnonzero(several[group])
        own = order[at]
        order[at] = own[np.lexsort((minor[own], major[own]))]
    return order


def heads(*keys: np.ndarray) -> np.ndarray:
    """Where a new group of equal keys begins, for keys of neighbours."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def smallest(doc: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each group's smallest document, for every member."""
    return np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.append(starts, len(doc)))) if len(doc) else doc


def block(flag: int, docs: np.ndarray, codes: np.ndarray, triggers: np.ndarray | None = None) -> bytes:
    """Codes with their documents, and the low 32 bits of their triggers; a document's id is held once."""
    own, index = np.unique(docs, return_inverse=True)
    return (np.array([flag, len(own), len(codes)], np.int64).tobytes() + own.astype(np.int64).tobytes()
            + codes.astype(U64).tobytes() + index.astype(np.int32 if len(own) > 65535 else np.uint16).tobytes()
            + (b"" if triggers is None else triggers.astype(np.uint32).tobytes()))


def unblock(data) -> tuple[np.ndarray, np.ndarray]:
    """A document id for each code, codes."""
    _, k, n = np.frombuffer(data, np.int64, 3).tolist()
    docs = np.frombuffer(data, np.int64, k, 24)
    index = np.frombuffer(data, np.int32 if k > 65535 else np.uint16, n, 24 + 8 * (k + n))
    return docs[index], np.frombuffer(data, U64, n, 24 + 8 * k)


def block_triggers(data) -> np.ndarray:
    """The low 32 bits of each code's trigger, for a block that holds them."""
    _, k, n = np.frombuffer(data, np.int64, 3).tolist()
    return np.frombuffer(data, np.uint32, n, 24 + 8 * k + (12 if k > 65535 else 10) * n)


def sub_slices(texts: list, limit: int):
    """Ranges of about ``limit`` bytes."""
    start, acc = 0, 0
    for i, t in enumerate(texts):
        if i > start and acc + len(t) > limit:
            yield start, i
            start, acc = i, 0
        acc += len(t)
    if start < len(texts):
        yield start, len(texts)


def record(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1] for r in rows], pa.binary())], names=["part", "block"])


def send_phrases(docs: DataFrame, bits: int) -> DataFrame:
    """``part, block``: first occurrences (flag 0) of a slice's phrases, and what is settled within it (flag 1)."""
    def run(batches):
        for b in batches:
            for i, j, texts in text_slices(b, 1, SLICE_BYTES):
                ids = b.column(0).slice(i, j - i).to_pylist()
                known = [(d, t.encode()) for d, t in zip(ids, texts) if d is not None and t]
                found = []
                for p, q in sub_slices([t for _, t in known], PARSE_BYTES):
                    parse = Parse([t for _, t in known[p:q]])
                    found.append((parse.trigger, parse.code, np.array([d for d, _ in known[p:q]], np.int64)[parse.doc]))
                if not any(len(f[0]) for f in found):
                    continue
                trigger, code, doc = (np.concatenate(x) for x in zip(*found))
                order = grouped(trigger, code)
                trigger, code, doc = trigger[order], code[order], doc[order]
                new = heads(trigger, code)
                low = smallest(doc, new)
                part = (trigger >> U64(64 - bits)).astype(np.int32)
                later = doc > low
                rows = [(int(part[later][0]), block(1, doc[later], code[later]))] if later.any() else []
                part, trigger, code, doc = part[new], trigger[new], code[new], low[new]
                cuts = heads(part)
                rows += [(int(part[p]), block(0, doc[p:q], code[p:q], trigger[p:q]))
                         for p, q in zip(cuts, np.append(cuts[1:], len(part)))]
                yield record(rows)

    return docs.mapInArrow(tidy(run), "part int, block binary")


def lists(docs: np.ndarray, codes: np.ndarray, kinds: np.ndarray) -> pa.Table:
    """A row for each document and kind with its codes."""
    order = np.lexsort((kinds, docs))
    docs, codes, kinds = docs[order], codes[order], kinds[order]
    at = heads(docs, kinds)
    offsets = pa.array(np.append(at, len(docs)).astype(np.int32))
    return pa.table({"doc_id": pa.array(docs[at]), "kind": pa.array(kinds[at].astype(np.int32)),
                     "codes": pa.ListArray.from_arrays(offsets, pa.array(codes.view(np.int64)))})


#: what a reply says of a phrase or window of a document
GONE_PHRASE, CHECK, CHECK_HOT, GONE_WINDOW = range(4)
REPLY = "doc_id long, kind int, codes array<long>"


def meet_phrases(table: pa.Table) -> pa.Table:
    """Dictionary of one partition: phrases to remove, and entries to compare by their bytes."""
    found, out = [], []
    for chunk in table.column("block").chunks:
        for x in chunk:
            raw = memoryview(x.as_buffer())
            doc, code = unblock(raw)
            if np.frombuffer(raw, np.int64, 1)[0]:
                out.append((doc, code, np.full(len(doc), GONE_PHRASE, np.int8)))
            else:
                found.append((doc, code, block_triggers(raw)))
    if found:
        doc, code, trigger = (np.concatenate(x) for x in zip(*found))
        del found
        order = grouped((trigger.astype(U64) << U64(32)) | (code >> U64(32)), code)
        doc, code, trigger = doc[order], code[order], trigger[order]
        new = heads(trigger, code)
        low = smallest(doc, new)
        later = doc > low
        out.append((doc[later], code[later], np.full(int(later.sum()), GONE_PHRASE, np.int8)))
        doc, code, trigger = low[new], code[new], trigger[new]
        starts = heads(trigger)
        size = np.diff(np.append(starts, len(code)))
        several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
        kind = np.repeat(np.where(several, np.where(size > HOT_ENTRIES, CHECK_HOT, CHECK), -1).astype(np.int8), size)
        ask = kind >= 0
        out.append((doc[ask], code[ask], kind[ask]))
    return lists(*(np.concatenate(x) for x in zip(*out)))


def gather(replies: DataFrame) -> DataFrame:
    """One row a document: an array of codes for each kind asked."""
    return replies.groupBy("doc_id").agg(*[
        F.expr(f"flatten(collect_list(codes) FILTER (WHERE kind = {k})) AS {name}")
        for k, name in ((GONE_PHRASE, "gone"), (CHECK, "check"), (CHECK_HOT, "hot"), (GONE_WINDOW, "windows"))])


def packed(docs: DataFrame, names: list[str], kinds: str) -> DataFrame:
    """Texts compressed, for the joins by document, with the carried columns."""
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for i, j, texts in text_slices(b, 1, SLICE_BYTES):
                z = pa.array([squeeze.compress((t or "").encode()) for t in texts], pa.binary())
                rest = [b.column(2 + k).slice(i, j - i) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), z, *rest], names=["doc_id", "text", *names])

    return docs.mapInArrow(tidy(run), "doc_id long, text binary" + kinds)


def longs(column, i: int) -> np.ndarray:
    """Values of row ``i`` of a list column (empty for null)."""
    x = column[i]
    return np.zeros(0, U64) if not x.is_valid else x.values.to_numpy(zero_copy_only=False).view(U64)


def send_entries(joined: DataFrame, buckets: int) -> DataFrame:
    """``part, block``: dictionary entries and hot windows with their bytes (flag 0), settled windows (flag 1)."""
    def bucket(key):
        return (key % U64(buckets)).astype(np.int64)

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for i, j, texts in text_slices(b, 1, SLICE_BYTES // 3):
                ids = b.column(0).slice(i, j - i).to_numpy()
                data = [unpack.decompress(t) for t in texts]
                entries, windows = [], []  # bucket, document, size, bytes; and key, document, bytes of windows
                for p, q in sub_slices(data, PARSE_BYTES):
                    parse = Parse(data[p:q])
                    own = ids[p:q]
                    hot, normal = (parse.among(parse.code, parse.doc, [longs(b.column(c), i + k) for k in range(p, q)])
                                   for c in (3, 2))
                    if hot.any():
                        at = parse.marked(hot)
                        doc = own[np.repeat(parse.doc[hot], (parse.last - parse.first + 1)[hot])]
                        windows.append((parse.window[at], doc, parse.data[at[:, None] + np.arange(SPAN)]))
                    if normal.any():
                        at, size = parse.first[normal], (parse.last - parse.first)[normal] + SPAN
                        where = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())
                        entries.append((bucket(mix64(parse.trigger[normal] ^ _A)), own[parse.doc[normal]], size,
                                        parse.data[where]))
                rows = []
                if windows:  # single windows, equal ones once
                    key, doc, strings = (np.concatenate(x) for x in zip(*windows))
                    order = np.argsort(key)
                    key, doc = key[order], doc[order]
                    new = heads(key)
                    low = smallest(doc, new)
                    later = doc > low
                    if later.any():
                        rows.append((int(bucket(key[:1])[0]), block(1, doc[later], key[later])))
                    entries.append((bucket(key[new]), low[new], np.full(len(new), SPAN), strings[order[new]].reshape(-1)))
                if entries:
                    part, doc, size, flat = (np.concatenate(x) for x in zip(*entries))
                    begin = np.cumsum(size) - size
                    order = np.argsort(part, kind="stable")
                    part, doc, size, begin = part[order], doc[order], size[order], begin[order]
                    cuts = heads(part)
                    for p, q in zip(cuts, np.append(cuts[1:], len(part))):
                        n = size[p:q]
                        where = np.repeat(begin[p:q] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                        rows.append((int(part[p]), np.array([0, q - p, 0], np.int64).tobytes()
                                     + doc[p:q].astype(np.int64).tobytes() + n.astype(np.uint8).tobytes()
                                     + flat[where].tobytes()))
                if rows:
                    yield record(rows)

    return joined.mapInArrow(tidy(run), "part int, block binary")


def suffix_groups(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the given starts to depth ``SPAN``, and which places equal their left neighbour so far.

    Sorted by 8-byte words; each further word refines the ties of those before.  ``data`` has 8 bytes beyond
    the last suffix.
    """
    words = np.lib.stride_tricks.sliding_window_view(data, 8)

    def word(at, k):  # the k-th 8 bytes as a number; the last one covers the remaining bytes
        return words[at + min(8 * k, SPAN - 8)].copy().view(">u8")[:, 0].astype(U64)

    key = word(starts, 0)
    order = np.argsort(key, kind="stable")
    tie = np.append(False, np.diff(key[order]) == 0)
    for k in range(1, -(-SPAN // 8)):
        member = tie | np.append(tie[1:], False)
        at = np.flatnonzero(member)
        if not len(at):
            break
        group = np.cumsum(~tie[at])
        key = word(starts[order[at]], k)
        inner = np.lexsort((key, group))
        order[at] = order[at][inner]
        key, group = key[inner], group[inner]
        tie[at] = np.append(False, (key[1:] == key[:-1]) & (group[1:] == group[:-1]))
    return order, tie


def meet_entries(table: pa.Table) -> pa.Table:
    """Windows of one bucket's dictionary entries that also lie in an entry of a smaller document."""
    docs, sizes, parts, out = [], [], [], []
    for chunk in table.column("block").chunks:
        for x in chunk:
            raw = memoryview(x.as_buffer())
            flag, k = np.frombuffer(raw, np.int64, 2).tolist()
            if flag:
                out.append(unblock(raw))
            else:
                docs.append(np.frombuffer(raw, np.int64, k, 24))
                sizes.append(np.frombuffer(raw, np.uint8, k, 24 + 8 * k))
                parts.append(np.frombuffer(raw, np.uint8, -1, 24 + 9 * k))
    if docs:
        doc, size = np.concatenate(docs), np.concatenate(sizes).astype(np.int64)
        data = np.concatenate([*parts, np.zeros(8, np.uint8)])
        del parts
        begin = np.cumsum(size) - size
        count = size - SPAN + 1
        starts = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        order, tie = suffix_groups(data, starts)
        owner = np.repeat(doc, count)[order]
        later = np.flatnonzero(owner > smallest(owner, np.flatnonzero(~tie)))
        for part in np.array_split(later, -(-len(later) // 20_000) or 1):
            if len(part):
                strings = data[starts[order[part]][:, None] + np.arange(SPAN)]
                out.append((owner[part], rolling(strings.reshape(-1))[1][::SPAN]))
    if not out:
        return lists(np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int8))
    doc, code = (np.concatenate(x) for x in zip(*out))
    return lists(doc, code, np.full(len(doc), GONE_WINDOW, np.int8))


def removed(parse: Parse, gone: list[np.ndarray], asked: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """Mask of the bytes to remove: removed phrases, and removed windows within the phrases asked for."""
    edge = np.zeros(len(parse.data) + 1, np.int32)
    phrase = parse.among(parse.code, parse.doc, gone)
    np.add.at(edge, parse.first[phrase], 1)
    np.add.at(edge, parse.last[phrase] + SPAN, -1)
    if any(len(w) for w in windows):
        open_ = parse.among(parse.code, parse.doc, asked)
        at = parse.marked(open_)
        doc = np.repeat(parse.doc[open_], (parse.last - parse.first + 1)[open_])
        at = at[parse.among(parse.window[at], doc, windows)]
        edge[at] += 1
        edge[at + SPAN] -= 1
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                   result: str = "kept") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans``, the result, and the columns of ``keep``.

    ``result``: ``kept``, the remaining bytes; ``kept_sha256``, their digest; or ``text``, the text they give,
    without the bytes of characters cut in two.
    """
    spark = df.sparkSession
    docs, names, kinds = carried(df, id_col, text_col, keep)
    narrow = docs.select("doc_id", "text")
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(24, max(6, math.ceil(math.log2(max(1, total / 14 / PARTITION_PHRASES)))))
    replies = staged(spark, gather(send_phrases(narrow, bits).groupBy("part").applyInArrow(tidy_group(meet_phrases), REPLY))
                     .drop("windows"), "repeat-phrases")
    asked = (packed(narrow, [], "").join(
        replies.where("size(check) + size(hot) > 0").select("doc_id", "check", "hot"), "doc_id")
        .select("doc_id", "text", "check", "hot"))
    found = gather(send_entries(asked, 1 << bits).groupBy("part").applyInArrow(tidy_group(meet_entries), REPLY))
    gone = (replies.select("doc_id", "gone", F.expr("concat(check, hot) AS asked"))
            .join(found.select("doc_id", "windows"), "doc_id", "left"))
    joined = (packed(docs, names, kinds).join(gone, "doc_id", "left")
              .select("doc_id", "text", "gone", "asked", "windows", *names))
    finish, kind = {"kept": (lambda x: x, "binary"), "kept_sha256": (lambda x: hashlib.sha256(x).hexdigest(), "string"),
                    "text": (lambda x: bytes(x).decode("utf-8", "ignore"), "string")}[result]
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", result]

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for i, j, texts in text_slices(b, 1, SLICE_BYTES // 4):
                data = [unpack.decompress(t) for t in texts]
                stats, kept = [(len(d), 0, 0) for d in data], list(data)
                for p, q in sub_slices(data, PARSE_BYTES):
                    told = [[longs(b.column(c), i + k) for k in range(p, q)] for c in (2, 3, 4)]
                    hit = [k for k in range(q - p) if len(told[0][k]) or len(told[2][k])]
                    if not hit:
                        continue
                    parse = Parse([data[p + k] for k in hit])
                    mask = removed(parse, *([t[k] for k in hit] for t in told))
                    for k, a, n in zip(hit, parse.starts.tolist(), parse.sizes.tolist()):
                        own = mask[a:a + n]
                        if own.any():
                            stats[p + k] = (n, int(own.sum()), int(own[0]) + int((own[1:] & ~own[:-1]).sum()))
                            kept[p + k] = parse.data[a:a + n][~own].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), *[pa.array([s[k] for s in stats], pa.int64()) for k in range(3)],
                     pa.array([finish(x) for x in kept], pa.binary() if kind == "binary" else pa.string()),
                     *[b.column(5 + k).slice(i, j - i) for k in range(len(names))]], names=[*columns, *names])

    done = joined.mapInArrow(tidy(run), f"doc_id long, n_bytes long, n_removed long, n_spans long, {result} {kind}" + kinds)
    return done.toDF(*columns, *keep) if keep else done
