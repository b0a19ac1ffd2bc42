"""Plain versions of the operators for small fixtures."""

import collections
import hashlib
import re
import zlib


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < 5 else [tuple(words[i:i + 5]) for i in range(len(words) - 4)])


def jaccard_groups(rows):
    """{doc_id: (set size, smallest linked id)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * 100 >= 80 * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= 80 * (len(x) + len(y) - common):
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeats_removed(rows, span=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the rest) of (doc_id, text) rows."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in rows:
        for k in range(len(t) - span + 1):
            s = t[k:k + span]
            if i is not None and first.get(s, i) >= i:
                first[s] = i
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - span + 1):
            if i is not None and first[t[k:k + span]] < i:
                gone[k:k + span] = b"\1" * span
        rest = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    ws = r"[^\x20\x09-\x0D]"
    words = re.findall(ws + "+", text)
    lines = [x for x in text.split("\n") if re.search(ws, x)]
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = collections.Counter(wins)
    covered = {k for i, w in enumerate(wins) if seen[w] > 1 for k in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


def held_out(doc_id, mod, rest):
    return zlib.crc32(str(doc_id).encode()) % mod == rest
