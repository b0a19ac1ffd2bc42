"""Ids of whole texts by the tokenizers library, with the ids of words kept between texts.

A text is cut at single spaces and line breaks, where neither vocabulary's
pattern lets a merge cross.  Arrow cuts the texts of a slice and numbers their
distinct words; a word met in an earlier slice is a look-up, all others go to
the library in batches; the texts' ids are then gathered from the words' ids
in numpy.  Words of Latin letters and marks, which need no normalising, go to
the library's model as their two pre-tokens, the others through its whole
pipeline.  Texts in which white space stands at the edge of a word (runs of
spaces, a tab before a space) go to the library whole, unless the vocabulary
drops white space anyway.  So do texts that hold the string of an added token,
in any case of letters: the library looks for these before all else.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from modenorm.llm.common import worker_cache

#: words kept after a second slice met them, and words met once
WORD_CACHE = 450_000
#: words to one call of the library
TOGETHER = 4096
#: text cut and gathered at once
SLICE_BYTES = 12 << 20
#: Latin letters, and marks after them, which always make a token run of their own (an apostrophe may not)
_PLAIN = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PLAIN_LOWER = re.compile(r"()([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_UNMET = object()


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class WordIds:
    """``encode(texts)`` gives the ids of all texts and where each text's begin.

    ``lowered``: the vocabulary lowers case and drops white space.
    """

    def __init__(self, tokenizer_json: bytes, lowered: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer_json)
        self.added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.lowered = lowered
        self.letters = byte_letters()
        self.marks: dict[str, bytes] = {"": b""}
        self.hot: dict[str, bytes | None] = {}
        self.fresh: dict[str, bytes | None] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), TOGETHER):
            found = self.tokenizer.encode_batch_fast(texts[i:i + TOGETHER], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in found]
        return out

    def _token(self, text: str) -> bytes:
        """Ids of one pre-token."""
        if not text.isascii():
            text = "".join(map(self.letters.__getitem__, text.encode()))
        elif text[:1] == " ":  # the other characters of plain words stand for themselves
            text = self.letters[32] + text[1:]
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def _learn(self, words: list[str]) -> list[bytes | None]:
        """Ids of the words that no slice has met; None for a word with white space at its edge."""
        match = (_PLAIN_LOWER if self.lowered else _PLAIN).fullmatch
        space = "" if self.lowered else " "
        token, marks, out, whole = self._token, self.marks, [], []
        feed = b"" if self.lowered else self.library(["\n"])[0]
        stems: dict[str, bytes] = {}
        for w in words:
            found = match(w)
            if not found:
                core = w[1:] if w[:1] == "\n" else w
                if self.lowered or core and not core[0].isspace() and not core[-1].isspace():
                    whole.append(len(out))
                out.append(None)  # white space beside white space: the text goes whole
                continue
            lead, stem, mark = found.groups()
            stem = stem if lead else space + stem
            ids = stems.get(stem)
            if ids is None:
                ids = stems[stem] = token(stem)
            if mark not in marks:
                marks[mark] = token(mark) if len(mark) < 64 else self.library([mark])[0]
            out.append((feed + ids if lead else ids) + marks[mark])
        if len(marks) > WORD_CACHE:
            self.marks = {"": b""}
        odd = [words[i] for i in whole]
        for i, ids in zip(whole, self.library([w if w[:1] == "\n" else space + w for w in odd])):
            out[i] = ids
        return out

    def _known(self, words: list[str]) -> list[bytes | None]:
        hot, fresh = self.hot, self.fresh
        if len(hot) > WORD_CACHE:
            hot.clear()
        out = list(map(hot.get, words, repeat(_UNMET)))
        at, new = [], []
        for i, k in enumerate(out):
            if k is _UNMET:
                w = words[i]
                k = fresh.pop(w, _UNMET)
                if k is _UNMET:
                    at.append(i)
                    new.append(w)
                else:
                    hot[w] = out[i] = k
        learned = self._learn(new)
        if len(fresh) > WORD_CACHE:
            fresh.clear()
        fresh.update(zip(new, learned))
        for i, k in zip(at, learned):
            out[i] = k
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the places where texts begin (and the last one ends)."""
        texts = pc.fill_null(texts, "")
        special: dict[int, bytes] = {}
        for token in self.added:
            rows = np.flatnonzero(pc.match_substring(texts, token, ignore_case=True).to_numpy(zero_copy_only=False))
            special |= dict.fromkeys(rows.tolist(), b"")
        if special:
            special = dict(zip(special, self.library([texts[i].as_py() for i in special])))
            held = np.zeros(len(texts), bool)
            held[list(special)] = True
            texts = pc.if_else(pa.array(held), "", texts)
        if self.lowered:
            flat = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        else:  # a word after a line break, or the first of a text, begins with the break
            flat = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        cut = pc.split_pattern(flat, " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        bounds = bounds - bounds[0]
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # a sixth of to_pylist's time
        known = self._known(words)
        filled = known if None not in known else [k or b"" for k in known]
        ids = np.frombuffer(b"".join(filled), "<u4")
        size = np.fromiter(map(len, filled), np.int32, len(filled)) // 4
        start = (np.cumsum(size) - size).astype(np.int32)  # a slice has less than 2 GB
        begin, count = start[index], size[index]
        whole = {i: np.frombuffer(g, "<u4") for i, g in special.items()}
        if not self.lowered:
            heads = bounds[:-1]  # the first word of each text has a break before it that the text has not
            begin[heads] += count[heads] > 0
            count[heads] -= count[heads] > 0
            bad = np.array([k is None for k in known], bool)[index]
            if bad.any():
                owner = np.unique(np.searchsorted(bounds, np.flatnonzero(bad), "right") - 1)
                got = self.library([texts[int(i)].as_py() for i in owner])
                whole = {int(i): np.frombuffer(g, "<u4") for i, g in zip(owner, got)} | whole
                for i in owner:
                    count[bounds[i]:bounds[i + 1]] = 0
        ends = np.cumsum(count, dtype=np.int32)
        out = ids[np.repeat(begin - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        at = np.append(0, ends)[bounds].astype(np.int64)
        if whole:
            parts = [whole.get(i, out[a:b]) for i, (a, b) in enumerate(zip(at.tolist(), at[1:].tolist()))]
            at = np.append(0, np.cumsum([len(p) for p in parts]))
            out = np.concatenate(parts)
        return out, at


def text_arrays(batch, column: int, limit: int = SLICE_BYTES):
    """``(start, stop, texts)``: consecutive rows of about ``limit`` bytes of text, as Arrow arrays."""
    col = batch.column(column)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield start, stop, col.slice(start, stop - start)
        start = stop


def with_end(ids: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text."""
    return np.insert(ids, at[1:], end_id), at + np.arange(len(at))


def worker_ids(sent, lowered: bool) -> WordIds:
    """The worker's :class:`WordIds` for a broadcast vocabulary."""
    return worker_cache("word ids", (hash(sent.value), lowered), lambda: WordIds(sent.value, lowered))


def send_vocabulary(spark, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # one or two MB
