"""Round-trip evaluation (F7) and the lossless option (F8).

``roundtrip_report`` encodes and decodes in one projection (both are column
expressions over the same row, so no join back to the input is needed) and
aggregates per (column, mode): rows, clipped rows, max and mean absolute
error.  With ``lossless=True`` the raw value of every clipped row travels in
``<col>_overflow`` and the error is zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.operators.decode import decode, slot_mode
from modenorm.operators.encode import Encoder, encode


def roundtrip(df: DataFrame, encoder: Encoder, key: str, lossless: bool = False) -> DataFrame:
    """Per row: key, original, restored, mode and clipped flag of every numeric column."""
    numeric = [c for c in encoder.columns if c.kind != "categorical"]
    keep = [c.name for c in encoder.columns]
    enc = encode(df, encoder, key, keep=keep, keep_overflow=True)
    # Clipped flag from the overflow column; drop it again for the lossy variant.
    flags = {f"__{c.name}_clipped": F.col(f"`{c.name}_overflow`").isNotNull() for c in numeric}
    enc = enc.withColumns(flags)
    modes = {f"__{c.name}_mode": slot_mode(F.col(f"`{c.name}_slot`"), c) for c in numeric}
    enc = enc.withColumns(modes)
    if not lossless:
        enc = enc.drop(*[f"{c.name}_overflow" for c in numeric])
    extra = list(flags) + list(modes) + keep
    return decode(enc, encoder, key, keep=extra, suffix="_restored")


def roundtrip_report(df: DataFrame, encoder: Encoder, key: str, lossless: bool = False) -> DataFrame:
    """(col, mode, rows, clipped, max_abs_err, mean_abs_err); modal slots report mode -1.

    Tasks add up rows, clipped rows, errors and the largest error of every column and mode in one pass; one
    aggregate adds the tasks.
    """
    numeric = [c for c in encoder.columns if c.kind != "categorical"]
    schema = "col string, mode int, rows bigint, clipped bigint, max_abs_err double, mean_abs_err double"
    if not numeric:
        return df.sparkSession.createDataFrame([], schema)
    rt = roundtrip(df, encoder, key, lossless)
    names, widths = [c.name for c in numeric], [2 + (c.model.k if c.model is not None else 0) for c in numeric]
    nan = F.lit(float("nan"))
    cols = []
    for i, c in enumerate(numeric):
        x = F.coalesce(F.col(f"`{c.name}`").cast("double"), nan)
        cols += [x.alias(f"x{i}"), F.coalesce(F.abs(F.col(f"`{c.name}_restored`") - x), nan).alias(f"e{i}"),
                 (F.coalesce(F.col(f"__{c.name}_mode"), F.lit(-1)) + 1).alias(f"m{i}"),
                 F.col(f"__{c.name}_clipped").cast("int").alias(f"c{i}")]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        sums = [np.zeros((3, w)) for w in widths]
        most = [np.full(w, -1.0) for w in widths]
        for b in batches:
            for i, w in enumerate(widths):
                x, e, m, clipped = (b.column(4 * i + j).to_numpy(zero_copy_only=False) for j in range(4))
                ok = ~np.isnan(x)
                e, m, clipped = e[ok], m[ok], clipped[ok]
                for j, v in enumerate((np.ones(len(m)), clipped, np.nan_to_num(e))):
                    sums[i][j] += np.bincount(m, weights=v, minlength=w)
                np.maximum.at(most[i], m, np.nan_to_num(e, nan=-1.0))
        for i, w in enumerate(widths):
            own = np.flatnonzero(sums[i][0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), i, np.int32)), pa.array((own - 1).astype(np.int32)),
                 pa.array(sums[i][0][own].astype(np.int64)), pa.array(sums[i][1][own].astype(np.int64)), pa.array(sums[i][2][own]),
                 pa.array(most[i][own])], names=["t", "mode", "rows", "clipped", "err", "most"])

    added = (rt.select(*cols).mapInArrow(run, "t int, mode int, rows long, clipped long, err double, most double")
             .groupBy("t", "mode").agg(F.sum("rows").alias("rows"), F.sum("clipped").alias("clipped"), F.sum("err").alias("err"),
                                       F.max("most").alias("most")))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("t") + 1)
    return added.select(name.alias("col"), "mode", "rows", "clipped", F.when(F.col("most") >= 0, F.col("most")).alias("max_abs_err"),
                        F.when(F.col("most") >= 0, F.col("err") / F.col("rows")).alias("mean_abs_err"))
