"""Independent dense numpy implementation of the variational DP mixture (test oracle only).

Written from the published update equations, vectorised over modes, with its
own special functions, so it shares no code with the library.
"""

import math

import numpy as np


def _digamma(x):
    x = np.asarray(x, dtype="float64").copy()
    out = np.zeros_like(x)
    for _ in range(12):
        small = x < 12
        out[small] -= 1.0 / x[small]
        x[small] += 1.0
    inv = 1.0 / x
    inv2 = inv * inv
    out += np.log(x) - 0.5 * inv - inv2 * (1 / 12 - inv2 * (1 / 120 - inv2 * (1 / 252 - inv2 * (1 / 240 - inv2 / 132))))
    return out


def _lgamma(x):
    return np.array([math.lgamma(v) for v in np.atleast_1d(x)])


def fit(x, resp0, gamma=0.001, max_iter=200, tol=1e-3, reg=1e-6):
    """x: (n,), resp0: (n, K) initial hard responsibilities. Returns dict of parameters and history."""
    x = np.asarray(x, dtype="float64")
    n, K = resp0.shape
    m0 = x.mean()
    c0 = x.var(ddof=1)

    def mstep(r):
        nk = r.sum(0) + 10 * np.finfo(float).eps
        xk = (r * x[:, None]).sum(0) / nk
        sk = (r * (x[:, None] - xk) ** 2).sum(0) / nk + reg
        a = 1 + nk
        b = gamma + np.concatenate([np.cumsum(nk[::-1])[-2::-1], [0.0]])
        beta = 1 + nk
        m = (m0 + nk * xk) / beta
        nu = 1 + nk
        var = (c0 + nk * sk + nk / beta * (xk - m0) ** 2) / nu
        return dict(a=a, b=b, beta=beta, m=m, nu=nu, var=var)

    def logprob(p):
        ds = _digamma(p["a"] + p["b"])
        lw = _digamma(p["a"]) - ds + np.concatenate([[0.0], np.cumsum(_digamma(p["b"]) - ds)[:-1]])
        sd = np.sqrt(p["var"])
        z = (x[:, None] - p["m"]) / sd
        lg = -0.5 * (math.log(2 * math.pi) + z * z) - np.log(sd) - 0.5 * np.log(p["nu"])
        return lg + 0.5 * (math.log(2) + _digamma(0.5 * p["nu"]) - 1 / p["beta"]) + lw

    def bound(p, r, lr):
        det = -0.5 * np.log(p["var"]) - 0.5 * np.log(p["nu"])
        lwish = -(p["nu"] * det + p["nu"] * 0.5 * math.log(2) + _lgamma(0.5 * p["nu"]))
        lnorm = -np.sum(_lgamma(p["a"]) + _lgamma(p["b"]) - _lgamma(p["a"] + p["b"]))
        return -np.sum(r * lr) - lwish.sum() - lnorm - 0.5 * np.sum(np.log(p["beta"]))

    p = mstep(resp0)
    lb, hist = -np.inf, []
    for it in range(1, max_iter + 1):
        w = logprob(p)
        mx = w.max(1, keepdims=True)
        lse = mx + np.log(np.exp(w - mx).sum(1, keepdims=True))
        lr = w - lse
        r = np.exp(lr)
        p = mstep(r)
        prev, lb = lb, bound(p, r, lr)
        hist.append(lb)
        if abs(lb - prev) < tol:
            break
    p["history"] = hist
    p["sd"] = np.sqrt(p["var"])
    return p
