"""Keyed random numbers.

``randn(seed)`` depends on partitioning, so a re-run on a different cluster
layout (or after an executor loss) could draw different numbers.  These
draws are a pure function of (row key, seed): deterministic under retries,
identical in any engine that has md5.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyed_uniform(key: str | Column, seed: int) -> Column:
    """Uniform on (0, 1): first 8 hex digits of md5(key || '|' || seed)."""
    h = F.md5(F.concat(_col(key).cast("string"), F.lit(f"|{int(seed)}")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(TWO_32)


def keyed_normal(key: str | Column, seed: int, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Normal draw by Box-Muller on two keyed uniforms (seeds s and s+1)."""
    u1 = keyed_uniform(key, seed)
    u2 = keyed_uniform(key, seed + 1)
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    if mean == 0.0 and sd == 1.0:
        return z
    return F.lit(float(mean)) + F.lit(float(sd)) * z


def keyed_uniform_sql(key_sql: str, seed: int) -> str:
    """DuckDB twin of :func:`keyed_uniform`."""
    return (f"(((('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{int(seed)}'), 1, 8))::BIGINT)"
            f" + 0.5::DOUBLE) / 4294967296::DOUBLE)")


def keyed_normal_sql(key_sql: str, seed: int, mean: float = 0.0, sd: float = 1.0) -> str:
    u1 = keyed_uniform_sql(key_sql, seed)
    u2 = keyed_uniform_sql(key_sql, seed + 1)
    z = f"(sqrt(-2.0::DOUBLE * ln({u1})) * cos({2.0 * math.pi!r}::DOUBLE * {u2}))"
    if mean == 0.0 and sd == 1.0:
        return z
    return f"({float(mean)!r}::DOUBLE + {float(sd)!r}::DOUBLE * {z})"


def _pair_from_digest(h: Column) -> list[Column]:
    u1 = (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(TWO_32)
    u2 = (F.conv(F.substring(h, 9, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(TWO_32)
    r = F.sqrt(F.lit(-2.0) * F.log(u1))
    return [r * F.cos(F.lit(2.0 * math.pi) * u2), r * F.sin(F.lit(2.0 * math.pi) * u2)]


def pair_digest(key: str | Column, seed: int, j: int) -> Column:
    return F.md5(F.concat(_col(key).cast("string"), F.lit(f"|{int(seed) + j}")))


def normals_from_digest(h: Column) -> list[Column]:
    return _pair_from_digest(h)


def keyed_normal_pair_sql(key_sql: str, seed: int, j: int) -> tuple[str, str]:
    """DuckDB twin of pair ``j`` of the keyed normals."""
    h = f"md5(CAST({key_sql} AS VARCHAR) || '|{int(seed) + j}')"
    u1 = f"(((('0x' || substr({h}, 1, 8))::BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)"
    u2 = f"(((('0x' || substr({h}, 9, 8))::BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)"
    r = f"sqrt(-2.0::DOUBLE * ln({u1}))"
    return (f"({r} * cos({2.0 * math.pi!r}::DOUBLE * {u2}))", f"({r} * sin({2.0 * math.pi!r}::DOUBLE * {u2}))")


def hash64_normal_pair(key: str | Column, seed: int, j: int) -> list[Column]:
    """Two N(0,1) draws from Spark's ``xxhash64(key, seed+j)``: arithmetic only, no strings.

    Equally a pure function of (key, seed); faster than md5, but Spark-specific
    (no twin in other engines).
    """
    h = F.xxhash64(_col(key), F.lit(int(seed) + j))
    hi = F.shiftrightunsigned(h, 32)
    lo = h.bitwiseAND(F.lit(0xFFFFFFFF))
    u1 = (hi.cast("double") + F.lit(0.5)) / F.lit(TWO_32)
    u2 = (lo.cast("double") + F.lit(0.5)) / F.lit(TWO_32)
    r = F.sqrt(F.lit(-2.0) * F.log(u1))
    return [r * F.cos(F.lit(2.0 * math.pi) * u2), r * F.sin(F.lit(2.0 * math.pi) * u2)]


def hash64_uniform(key: str | Column, seed: int) -> Column:
    """Uniform on (0, 1) from the top 53 bits of Spark's ``xxhash64(key, seed)``.

    A pure function of (key, seed) like :func:`keyed_uniform`, several times
    cheaper (no string work), but Spark-specific.
    """
    h = F.xxhash64(_col(key), F.lit(int(seed)))
    return (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 53))


def uniform(key: str | Column, seed: int, rng: str = "md5") -> Column:
    """Keyed uniform by method: ``md5`` (portable, has a SQL twin) or ``hash64`` (fast)."""
    if rng == "md5":
        return keyed_uniform(key, seed)
    if rng == "hash64":
        return hash64_uniform(key, seed)
    raise ValueError(f"unknown rng {rng!r}")
