"""Mixture model table.

A fitted model is K rows per (column, part): ``mean``, ``sd``, ``offset``
(the constant of the mode's log score), ``weight``, ``kept`` and ``rank``.
It is tiny by construction (K <= a few dozen), so it is held on the driver
as a :class:`Mixture` and enters query plans as literals.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MODEL_SCHEMA = T.StructType([
    T.StructField("col", T.StringType(), False),
    T.StructField("part", T.StringType(), False),
    T.StructField("mode", T.IntegerType(), False),
    T.StructField("mean", T.DoubleType(), False),
    T.StructField("sd", T.DoubleType(), False),
    T.StructField("offset", T.DoubleType(), False),
    T.StructField("weight", T.DoubleType(), False),
    T.StructField("kept", T.BooleanType(), False),
    T.StructField("rank", T.IntegerType(), True),
])

LAYOUT_SCHEMA = T.StructType([
    T.StructField("col", T.StringType(), False),
    T.StructField("block", T.IntegerType(), False),
    T.StructField("start", T.IntegerType(), False),
    T.StructField("width", T.IntegerType(), False),
    T.StructField("activation", T.StringType(), False),
])

# Fixed value: modes with weight at or below this are dropped by the encoder.
DEFAULT_EPS = 0.005


@dataclass(frozen=True)
class Mixture:
    """A fitted 1-D mixture: per mode mean, sd, score offset and weight."""

    col: str
    means: tuple[float, ...]
    sds: tuple[float, ...]
    offsets: tuple[float, ...]
    weights: tuple[float, ...]
    kept: tuple[bool, ...] | None = None
    ranks: tuple[int | None, ...] | None = None
    part: str = "main"
    info: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        k = len(self.means)
        if k == 0:
            raise ValueError("model has no modes: fit it first")
        for name in ("sds", "offsets", "weights"):
            if len(getattr(self, name)) != k:
                raise ValueError(f"model field {name} has the wrong length")
        if any(not (s > 0) for s in self.sds):
            raise ValueError("model sds must be positive")

    @property
    def k(self) -> int:
        return len(self.means)

    def kept_modes(self) -> list[int]:
        kept = self.kept if self.kept is not None else tuple(True for _ in range(self.k))
        return [i for i, flag in enumerate(kept) if flag]

    def with_kept(self, kept: Sequence[bool]) -> "Mixture":
        return replace(self, kept=tuple(bool(b) for b in kept))

    @staticmethod
    def from_weights(col: str, means: Sequence[float], sds: Sequence[float], weights: Sequence[float],
                     offsets: Sequence[float] | None = None, **kw) -> "Mixture":
        """Plain Gaussian mixture: offset_k = ln(weight_k) - ln(sd_k) unless given."""
        if offsets is None:
            offsets = [math.log(w) - math.log(s) if w > 0 else -math.inf for w, s in zip(weights, sds)]
        return Mixture(col=col, means=tuple(map(float, means)), sds=tuple(map(float, sds)),
                       offsets=tuple(map(float, offsets)), weights=tuple(map(float, weights)), **kw)

    def rows(self) -> list[tuple]:
        kept = self.kept if self.kept is not None else (True,) * self.k
        ranks = self.ranks if self.ranks is not None else (None,) * self.k
        return [(self.col, self.part, i, self.means[i], self.sds[i], self.offsets[i], self.weights[i],
                 bool(kept[i]), ranks[i]) for i in range(self.k)]


def model_frame(spark: SparkSession, models: Iterable[Mixture]) -> DataFrame:
    """The model table as a (tiny) DataFrame."""
    rows = [r for m in models for r in m.rows()]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def save_model(spark: SparkSession, models: Iterable[Mixture], path: str, mode: str = "overwrite") -> None:
    """Persist the model table as Parquet (one small file)."""
    model_frame(spark, models).coalesce(1).write.mode(mode).parquet(path)


def load_model(spark: SparkSession, path: str) -> dict[tuple[str, str], Mixture]:
    """Read a model table back; K rows per (col, part), bounded."""
    rows = spark.read.parquet(path).orderBy("col", "part", "mode").collect()
    if not rows:
        raise ValueError(f"model table at {path!r} is empty: fit first")
    by: dict[tuple[str, str], list] = {}
    for r in rows:
        by.setdefault((r["col"], r["part"]), []).append(r)
    out = {}
    for (c, p), rs in by.items():
        out[(c, p)] = Mixture(col=c, part=p, means=tuple(r["mean"] for r in rs), sds=tuple(r["sd"] for r in rs),
                              offsets=tuple(r["offset"] for r in rs), weights=tuple(r["weight"] for r in rs),
                              kept=tuple(r["kept"] for r in rs), ranks=tuple(r["rank"] for r in rs))
    return out


def significant_modes(model: Mixture, counts: dict[int, int], eps: float = DEFAULT_EPS) -> Mixture:
    """Keep a mode iff its weight exceeds ``eps`` and some row's hard mode is it."""
    kept = [model.weights[i] > eps and counts.get(i, 0) > 0 for i in range(model.k)]
    return model.with_kept(kept)

