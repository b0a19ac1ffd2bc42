"""Pluggable transformer.

Anything with ``transform(values: np.ndarray) -> (normalized, modes)`` runs
over Arrow batches with ``mapInPandas``; the output schema is declared up
front (no trial call).  Null and NaN rows get null results, as in the
column path (E6).  Native column code should use ``DataFrame.transform``
with the expression builders instead -- this is the slow path for numpy code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from modenorm.operators.score import CLIP, SCALE_SDS


def apply_transformer(df: DataFrame, transformer, col: str, value_out: str | None = None,
                      mode_out: str = "Mode_Assignment") -> DataFrame:
    value_out = value_out or f"{col}_Transformed"
    fields = [f for f in df.schema.fields if f.name not in (value_out, mode_out)]
    schema = T.StructType(fields + [T.StructField(value_out, T.DoubleType(), True),
                                    T.StructField(mode_out, T.IntegerType(), True)])

    def run(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            x = pdf[col].to_numpy(dtype="float64")
            bad = np.isnan(x)
            vals, modes = transformer.transform(np.where(bad, 0.0, x))
            pdf = pdf.copy()
            pdf[value_out] = pd.Series(np.asarray(vals, dtype="float64"), index=pdf.index).astype("Float64").mask(bad)
            pdf[mode_out] = pd.Series(np.asarray(modes).astype("int32"), index=pdf.index).astype("Int32").mask(bad)
            yield pdf

    return df.mapInPandas(run, schema)


class NumpyModeScaler:
    """A numpy transformer over a fitted :class:`~modenorm.operators.model.Mixture` (for U1)."""

    def __init__(self, model):
        import numpy as np

        self.means = np.asarray(model.means, dtype="float64")
        self.sds = np.asarray(model.sds, dtype="float64")
        self.offsets = np.asarray(model.offsets, dtype="float64")

    def transform(self, x):
        import numpy as np

        z = (x[:, None] - self.means) / self.sds
        scores = self.offsets - 0.5 * (z * z)
        modes = scores.argmax(axis=1)
        norm = (x - self.means[modes]) / (SCALE_SDS * self.sds[modes])
        return np.clip(norm, -CLIP, CLIP), modes
