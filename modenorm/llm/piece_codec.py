"""SentencePiece (BPE) encoding and decoding with vectorised merge rounds.

All distinct words of a batch are merged together.  Their characters form one
flat numpy array of symbols, cut into segments wherever no piece of the
vocabulary holds the two neighbouring characters (which covers spaces, line
breaks and characters outside the vocabulary).  One round finds the best pair
rank of every segment (``minimum.reduceat``), merges all its occurrences from
the left at once, and compacts the arrays; segments without a mergeable pair
leave the arrays, and the rounds end when none is left.

Merging all occurrences at once equals the library's one-at-a-time order
unless a merge creates a pair that ranks as high as the one being merged.
That is detected, and such a segment is merged one pair at a time instead.

Defined results: a null or empty text has begin and end id only and decodes to
the empty string; null ids in ``decode`` give null text.  Repeated rows give
repeated results; no row is dropped.  Very long texts are whole; a batch is
worked on in slices of bounded size.
"""

from __future__ import annotations

import codecs
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import narrow, text_slices, tidy, worker_cache

SPACE = "▁"
NONE = np.int64(1) << 40
#: symbols of characters outside the vocabulary are this plus the code point
RAW = 1 << 21
WORD_CACHE = 150_000
SLICE_BYTES = 1 << 20
ENCODE_WORDS = 8192
_RUN = re.compile(" *[^ ]+| +")


class PieceModel:
    """Tables of one sentencepiece BPE model, read through the library from the model's bytes."""

    def __init__(self, proto: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        symbol = {p: i for i, p in enumerate(pieces) if not special[i]}
        chars = sorted({c for p in symbol for c in p} - symbol.keys())
        symbol |= {c: RAW + ord(c) for c in chars}

        scores = sorted({sp.get_score(i) for i in symbol.values() if i < n}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        keys, ranks, made, bigrams = [], [], [], set()
        for p, i in symbol.items():
            bigrams.update(zip(p, p[1:]))
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a << 22 | b)
                    ranks.append(rank_of[sp.get_score(i)])
                    made.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.append(np.array(ranks, np.int64)[order], NONE)
        self.made = np.append(np.array(made, np.int64)[order], -1)
        self.bigrams = np.sort(np.array([ord(a) << 21 | ord(b) for a, b in bigrams], np.int64))
        self.pair = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        cps = np.array([ord(c) for c in symbol if len(c) == 1], np.int64)
        self.char_symbol = np.arange(0x110000, dtype=np.int64) + RAW
        self.char_symbol[cps] = [symbol[chr(c)] for c in cps]
        self.text_of = [b"" if sp.is_control(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i)
                        else " ⁇ ".encode() if sp.is_unknown(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.skip = {i for i in range(n) if sp.is_control(i)}

    # ------------------------------------------------------------ encoding
    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the tables; the last place means: no such merge."""
        key = left << 22 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, len(self.keys))

    def merge(self, cps: np.ndarray, word_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of the concatenated words and the character index where each begins."""
        sym = self.char_symbol[cps]
        out = np.full(len(sym), -1, np.int64)
        first = np.zeros(len(sym), bool)
        first[word_starts] = True
        if len(sym) > 1:
            near = cps[:-1] << 21 | cps[1:]
            at = np.minimum(np.searchsorted(self.bigrams, near), len(self.bigrams) - 1)
            first[1:] |= self.bigrams[at] != near
        pos = np.arange(len(sym))
        seg_from = np.flatnonzero(first)
        seg_to = np.append(seg_from[1:], len(sym))
        place = np.full(len(sym), len(self.keys))
        inner = np.flatnonzero(~first[1:])
        place[inner] = self.lookup(sym[inner], sym[inner + 1])
        odd: list[tuple[int, int]] = []
        while len(sym):
            starts = np.flatnonzero(first)
            rank = self.ranks[place]
            best = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(sym)))
            done = np.repeat(best == NONE, size)
            if done.any():  # finished segments leave
                out[pos[done]] = sym[done]
                keep = ~done
                sym, pos, first, place, rank = sym[keep], pos[keep], first[keep], place[keep], rank[keep]
                size, best = size[best != NONE], best[best != NONE]
                if not len(sym):
                    break
            seg = np.repeat(np.arange(len(size)), size)
            hit = np.flatnonzero(rank == best[seg])
            # of overlapping hits (i, i+1, ...) every second one, from the left
            new_run = np.append(True, (np.diff(hit) != 1) | (seg[hit[1:]] != seg[hit[:-1]]))
            run_from = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run_from) % 2 == 0]
            sym[hit] = self.made[place[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep) - 1
            at, hit_seg = moved[hit], seg[hit]
            last = np.append(first[1:], True)
            last[hit] |= last[hit + 1]
            sym, pos, first, place, last = sym[keep], pos[keep], first[keep], place[keep], last[keep]
            worse = np.zeros(len(best), bool)
            several = np.bincount(hit_seg, minlength=len(best)) > 1
            for at_, ok in ((at, ~last[at]), (at - 1, ~first[at])):
                a, s = at_[ok], hit_seg[ok]
                place[a] = self.lookup(sym[a], sym[a + 1])
                worse[s[self.ranks[place[a]] <= best[s]]] = True
            place[last] = len(self.keys)
            redo = worse & several
            if redo.any():
                seg = np.cumsum(first) - 1
                gone = redo[seg]
                k = np.searchsorted(seg_from, pos[gone & first])
                odd += zip(seg_from[k].tolist(), seg_to[k].tolist())
                keep = ~gone
                sym, pos, first, place = sym[keep], pos[keep], first[keep], place[keep]
        for a, b in odd:
            self._one_by_one(cps[a:b], out[a:b])
        at = np.flatnonzero(out >= 0)
        return out[at], at

    def _one_by_one(self, cps: np.ndarray, out: np.ndarray) -> None:
        """Best pair first, ties from the left, one merge at a time."""
        sym = self.char_symbol[cps].tolist()
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list = []

        def offer(i):
            if i >= 0 and after[i] < n and (found := self.pair.get(sym[i] << 22 | sym[after[i]])):
                heapq.heappush(heap, (found[0], i, sym[i], sym[after[i]], found[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = made, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        out[:] = sym

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (a leading space is added to each) as little-endian 32-bit integers."""
        flat = (" " + "\0 ".join(words)).replace(" ", SPACE)
        lens = np.array([len(w) + 1 for w in words])
        starts = np.append(0, np.cumsum(lens + 1)[:-1])
        cps = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        keep = np.ones(len(cps), bool)
        keep[starts[1:] - 1] = False  # the separators
        cps, starts = cps[keep], np.append(0, np.cumsum(lens)[:-1])
        sym, at = self.merge(cps, starts)
        cp = np.maximum(sym - RAW, 0)
        count = np.where(sym < RAW, 1, 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF))
        ends = np.cumsum(count)
        ids = np.repeat(sym, count)
        raw = np.flatnonzero(ids >= RAW)
        if len(raw):
            owner = np.repeat(np.arange(len(sym)), count)[raw]
            k = raw - (ends - count)[owner]  # which byte of the character
            c, m = cp[owner], count[owner]
            lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])[m]
            byte = np.where(k == 0, lead | (c >> 6 * (m - 1)), 0x80 | ((c >> 6 * np.maximum(m - 1 - k, 0)) & 0x3F))
            ids[raw] = self.byte_ids[byte]
        data = ids.astype("<u4").tobytes()
        cut = np.append(0, ends)[np.append(np.searchsorted(at, starts), len(at))] * 4
        cut = cut.tolist()
        return [data[a:b] for a, b in zip(cut, cut[1:])]

    def split(self, text: str) -> list[str]:
        """Words without their first space; a run of spaces stays with the word after it."""
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in _RUN.findall(" " + text)]
        return text.split(" ")

    def encode_texts(self, texts: list[str | None], cache: dict) -> list[bytes]:
        """Ids with begin and end id; ``cache`` keeps words between calls.

        A word moves from ``fresh`` to ``hot`` when it is met in a second call, so that the many words met
        once don't push out the others; either part is emptied when full.
        """
        hot, fresh = cache.setdefault("hot", {}), cache.setdefault("fresh", {})
        words = [self.split(t) if t else [] for t in texts]
        rest = {w for ws in words for w in ws} - hot.keys()
        if len(hot) > WORD_CACHE:
            hot.clear()
            rest = {w for ws in words for w in ws}
        again = rest & fresh.keys()
        for w in again:
            hot[w] = fresh.pop(w)
        need = sorted(rest - again, key=len)  # neighbours finish in the same rounds
        for k in range(0, len(need), ENCODE_WORDS):
            part = need[k:k + ENCODE_WORDS]
            hot.update(zip(part, self.encode_words(part)))
        begin, end = np.array([self.bos], "<u4").tobytes(), np.array([self.eos], "<u4").tobytes()
        get = hot.__getitem__
        out = [begin + b"".join(map(get, ws)) + end for ws in words]
        if len(fresh) > WORD_CACHE:
            fresh.clear()
        for w in need:
            fresh[w] = hot.pop(w)
        return out

    # ------------------------------------------------------------ decoding
    def decode_ids(self, ids: np.ndarray) -> str:
        """Text of the ids: the prefix space goes, each invalid byte becomes U+FFFD."""
        table, skip, ids = self.text_of, self.skip, ids.tolist()
        inner = [k for k, i in enumerate(ids) if i in skip]  # a control id ends a character of several byte ids
        parts = [b"".join(map(table.__getitem__, ids[a + 1:b])) for a, b in zip([-1, *inner], [*inner, len(ids)])]
        lead = next((i for i in ids if i not in skip), self.unk)
        text = "".join(x.decode("utf-8", "each-byte") for x in parts)
        return text[1:] if text[:1] == " " and lead != self.unk else text


def _each_byte(e):
    return "�" * (e.end - e.start), e.end


def _model(proto) -> tuple[PieceModel, dict]:
    codecs.register_error("each-byte", _each_byte)
    return worker_cache("pieces", hash(proto.value), lambda: (PieceModel(proto.value), {}))


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """One row per input row: ``doc_id`` and ``ids`` (little-endian 32-bit integers with begin and end id).

    ``decoded`` adds ``text``, the ids decoded again, in the same pass.
    """
    proto = df.sparkSession.sparkContext.broadcast(read_model(model_path))  # the vocabulary: half a MB

    def run(batches):
        model, cache = _model(proto)
        for b in batches:
            for i, j, texts in text_slices(b, 1, SLICE_BYTES):
                ids = model.encode_texts(texts, cache)
                out = [b.column(0).slice(i, j - i), pa.array(ids, pa.binary())]
                if decoded:
                    out.append(pa.array([model.decode_ids(np.frombuffer(x, "<u4")) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "text"][:len(out)])

    return narrow(df, id_col, text_col).mapInArrow(tidy(run, "pieces"), "doc_id long, ids binary" + ", text string" * decoded)


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id``, ``ids`` and the decoded ``text`` of rows with ids as :func:`encode` gives them."""
    proto = df.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches):
        model, _ = _model(proto)
        for b in batches:
            for i, j, ids in text_slices(b, 1, 4 * SLICE_BYTES):
                text = [None if x is None else model.decode_ids(np.frombuffer(x, "<u4")) for x in ids]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                                                  pa.array(text, pa.string())], names=["doc_id", "ids", "text"])

    return (df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
            .mapInArrow(tidy(run, "pieces"), "doc_id long, ids binary, text string"))


def digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Round trip of every text: id count and digests of ids and of the decoded text."""
    back = encode(df, model_path, id_col, text_col, decoded=True)
    return back.select("doc_id", F.expr("CAST(octet_length(ids) DIV 4 AS LONG)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
