"""A small convolutional text network in numpy: embeddings, several filter widths, max pooling, softmax heads.

A text is a sequence of items (bytes, words); an item is the sum of the
embeddings of its features.  Training starts on bounded rows in the driver and
goes on over all rows in Spark's tasks (:mod:`conv_shards`); scoring uses per-item tables (embedding times filter slice), so a filter
response is a sum of table rows.
"""

from __future__ import annotations

import numpy as np


#: items that a training step has at most, unless one text has more
STEP_ITEMS = 100_000


def bounded(order, texts: list[np.ndarray], limit: int):
    """Consecutive parts of ``order`` whose texts hold at most ``limit`` items (a longer one alone)."""
    part, acc = [], 0
    for i in order:
        if part and acc + len(texts[i]) > limit:
            yield part
            part, acc = [], 0
        part.append(i)
        acc += len(texts[i])
    if part:
        yield part


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


class ConvText:
    def __init__(self, n_features: int, heads: dict[str, int], dim: int, filters: int, widths: tuple[int, ...],
                 seed: int = 7):
        rng = np.random.default_rng(seed)
        self.widths, self.filters = widths, filters
        self.emb = rng.normal(0, 0.1, (n_features, dim)).astype(np.float32)
        self.w = {w: rng.normal(0, 1 / np.sqrt(w * dim), (w, dim, filters)).astype(np.float32) for w in widths}
        self.b = np.zeros(filters * len(widths), np.float32)
        self.heads = {k: [rng.normal(0, 0.1, (filters * len(widths), c)).astype(np.float32), np.zeros(c, np.float32)]
                      for k, c in heads.items()}

    # ------------------------------------------------------------ training
    def dense(self) -> list[np.ndarray]:
        """Every array but the embeddings."""
        return [self.b, *self.w.values(), *(x for h in self.heads.values() for x in h)]

    def fit(self, features: np.ndarray, texts: list[np.ndarray], labels: dict[str, np.ndarray], epochs: int,
            batch: int = 48, rate: float = 0.01, drop_first: float = 0.0, seed: int = 11) -> Trainer:
        """``features``: (items, k) feature ids, -1 for none.  ``texts``: item ids.  ``labels``: class or -1 by head."""
        trainer = Trainer(self, rate, drop_first, seed)
        for _ in range(epochs):
            order = trainer.rng.permutation(len(texts))
            for part in (p for at in range(0, len(order), batch)
                         for p in bounded(order[at:at + batch], texts, STEP_ITEMS)):
                trainer.step(features, [texts[i] for i in part], {k: y[part] for k, y in labels.items()})
        return trainer

    def _gradients(self, features, texts, labels, rng, drop_first):
        sizes = np.array([len(t) for t in texts])
        items, inv = np.unique(np.concatenate(texts), return_inverse=True)
        feats = features[items].copy()
        if drop_first and feats.shape[1] > 1:  # so that the other features learn as well
            feats[(rng.random(len(feats)) < drop_first) & (feats[:, 1] >= 0), 0] = -1
        e = (self.emb[feats] * (feats >= 0)[:, :, None]).sum(axis=1)
        x = e[inv]
        ends = np.cumsum(sizes)
        pooled, picks = [], []
        for w in self.widths:
            conv = self._respond(x, w)
            best = np.zeros((len(texts), self.filters), np.float32) - 1
            pick = np.zeros((len(texts), self.filters), np.int64)
            for d, (end, n) in enumerate(zip(ends, sizes)):
                if n >= w:
                    own = conv[end - n:end - w + 1]
                    k = own.argmax(axis=0)
                    best[d], pick[d] = own[k, np.arange(self.filters)], k + end - n
            pooled.append(best)
            picks.append(pick)
        h = np.maximum(np.concatenate(pooled, axis=1) + self.b, 0)
        dh = np.zeros_like(h)
        head_grads = []
        for k, (a, c) in self.heads.items():
            known = labels[k] >= 0
            p = softmax(h @ a + c)
            p[np.arange(len(p)), np.maximum(labels[k], 0)] -= 1
            p *= known[:, None] / max(1, known.sum())
            head_grads += [h.T @ p, p.sum(axis=0)]
            dh += p @ a.T
        dh *= h > 0
        d_item = np.zeros_like(e)
        grads = [dh.sum(axis=0)]
        for k, w in enumerate(self.widths):
            g = dh[:, k * self.filters:(k + 1) * self.filters] * (sizes >= w)[:, None]
            at = np.minimum(picks[k][:, :, None] + np.arange(w), len(x) - 1)
            grads.append(np.einsum("df,dfwe->wef", g, x[at]).astype(np.float32))
            np.add.at(d_item, inv[at].reshape(-1),
                      (g[:, :, None, None] * self.w[w].transpose(2, 0, 1)).reshape(-1, e.shape[1]))
        used = feats >= 0
        rows, inv_rows = np.unique(feats[used], return_inverse=True)
        d_rows = np.zeros((len(rows), e.shape[1]), np.float32)
        place = np.full(feats.shape, -1, inv_rows.dtype)
        place[used] = inv_rows
        picked = np.flatnonzero(d_item.any(axis=1))  # the others, most items, change no sum
        place = place[picked]
        np.add.at(d_rows, place[place >= 0], np.repeat(d_item[picked], (place >= 0).sum(axis=1), axis=0))
        return grads + head_grads, rows, d_rows

    def _respond(self, x: np.ndarray, w: int) -> np.ndarray:
        """Responses of one width at every start; the last w - 1 starts are not meant."""
        out = x @ self.w[w][0]
        for j in range(1, w):
            out[:-j] += x[j:] @ self.w[w][j]
        return out

    # ------------------------------------------------------------ scoring
    def item_rows(self, feats: np.ndarray) -> np.ndarray:
        """Table rows of items, all widths and filter slices side by side: (items, sum(widths) * filters)."""
        e = (self.emb[feats] * (feats >= 0)[:, :, None]).sum(axis=1, dtype=float)  # so that no batch changes a row
        return np.concatenate([(e @ self.w[w][j]).astype(np.float32) for w in self.widths for j in range(w)], axis=1)

    def head(self, name: str, pooled: np.ndarray) -> np.ndarray:
        a, c = self.heads[name]
        return softmax(np.maximum(pooled + self.b, 0).astype(float) @ a + c)


class Trainer:
    """Steps of Adam for the dense arrays and of Adagrad for the embeddings; a pickled trainer goes on where it was."""

    def __init__(self, net: ConvText, rate: float = 0.01, drop_first: float = 0.0, seed: int = 11):
        self.net, self.rate, self.drop_first, self.rng = net, rate, drop_first, np.random.default_rng(seed)
        self.m, self.v, self.steps = [np.zeros_like(x) for x in net.dense()], [np.zeros_like(x) for x in net.dense()], 0
        self.seen = np.full(len(net.emb), 1e-6, np.float32)

    def step(self, features, texts: list[np.ndarray], labels: dict[str, np.ndarray]) -> np.ndarray:
        """Learn from some texts; the rows of the embeddings that took part."""
        net, rate = self.net, self.rate
        grads, rows, d_rows = net._gradients(features, texts, labels, self.rng, self.drop_first)
        self.steps += 1
        for x, g, a, c in zip(net.dense(), grads, self.m, self.v):
            a += 0.1 * (g - a)
            c += 0.01 * (g * g - c)
            x -= rate * (a / (1 - 0.9 ** self.steps)) / (np.sqrt(c / (1 - 0.99 ** self.steps)) + 1e-7)
        self.seen[rows] += (d_rows * d_rows).mean(axis=1)
        net.emb[rows] -= 3 * rate * d_rows / np.sqrt(self.seen[rows])[:, None]
        return rows
