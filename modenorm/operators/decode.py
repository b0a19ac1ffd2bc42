"""Decoding (F1-F5): the inverse of :func:`modenorm.operators.encode.encode`.

``restored = clip(value, -1, 1) * 4 * sd[mode] + mean[mode]`` where the mode
comes from the slot through the frozen frequency order; modal slots give
their modal value back; categorical slots join back to their category.
An ``<col>_overflow`` column (lossless encoding) wins over the formula.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modenorm.operators.encode import ColumnCode, Encoder, layout
from modenorm.operators.score import SCALE_SDS, clip, lookup


def slot_to_pre(slot: Column, code: ColumnCode) -> Column:
    """undo the frequency order (slot -> pre-rank slot)."""
    return lookup(slot, list(code.order))


def slot_mode(slot: Column, code: ColumnCode) -> Column:
    """Mixture mode behind a slot (null for modal slots): one lookup table slot -> mode."""
    n_modal = len(code.modal)
    kept = code.kept
    modes = [kept[p - n_modal] if p >= n_modal else None for p in code.order]
    return lookup(slot, modes).cast("int") if modes else F.lit(None).cast("int")


def decode_numeric(value: Column, slot: Column, code: ColumnCode, overflow: Column | None = None) -> Column:
    """F1 (continuous) and F2 (mixed): slot-indexed literal tables, no nested CASE."""
    model = code.model
    n_modal = len(code.modal)
    kept = code.kept
    # Per slot: mean, 4*sd (null for modal slots) and modal value (null for mode slots).
    means, sd4s, modal_vals = [], [], []
    for p in code.order:
        if p < n_modal:
            means.append(None)
            sd4s.append(None)
            modal_vals.append(float(code.modal[p]))
        else:
            k = kept[p - n_modal]   # only reached when the model keeps modes
            means.append(float(model.means[k]))
            sd4s.append(float(SCALE_SDS * model.sds[k]))
            modal_vals.append(None)
    if not means:
        return F.lit(None).cast("double")
    mean = _dlookup(slot, means)
    sd4 = _dlookup(slot, sd4s)
    restored = clip(value, -1.0, 1.0) * sd4 + mean
    if n_modal:
        restored = F.coalesce(_dlookup(slot, modal_vals), restored)
    if overflow is not None:
        restored = F.coalesce(overflow, restored)
    return restored


def _dlookup(idx: Column, values: list) -> Column:
    vals = [None if v is None else float(v) for v in values]
    return lookup(idx, vals).cast("double")


def decode(enc: DataFrame, encoder: Encoder, key: str, keep: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """decode a compact (or dense, see :func:`from_dense`) encoded table.

    Output: ``key``, ``keep`` columns and one column per encoded column
    (named ``<col><suffix>``).
    """
    if "encoded" in enc.columns and not any(f"{c.name}_slot" in enc.columns for c in encoder.columns):
        enc = from_dense(enc, encoder, key, keep)
    cur = enc
    outs = [F.col(f"`{key}`")] + [F.col(f"`{k}`") for k in keep if k != key]
    for c in encoder.columns:
        slot = F.col(f"`{c.name}_slot`")
        if c.kind == "categorical":
            cats = c.categories.select(F.col("category").alias(f"__{c.name}_cat"), F.col("slot").alias(f"__{c.name}_s"))
            right = F.broadcast(cats) if c.broadcast_categories() else cats
            cur = cur.join(right, slot == F.col(f"__{c.name}_s"), "left")
            outs.append(F.col(f"__{c.name}_cat").alias(f"{c.name}{suffix}"))   # F3
            continue
        ovf = F.col(f"`{c.name}_overflow`") if f"{c.name}_overflow" in enc.columns else None
        outs.append(decode_numeric(F.col(f"`{c.name}_value`"), slot, c, ovf).alias(f"{c.name}{suffix}"))
    return cur.select(*outs)


def from_dense(enc: DataFrame, encoder: Encoder, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """Dense ``encoded`` array -> compact columns; a block's argmax gives the slot (first on ties)."""
    cols = [F.col(f"`{key}`")] + [F.col(f"`{k}`") for k in keep if k != key]
    arr = F.col("encoded")
    for name, block, start, width, _act in layout(encoder):
        code = encoder.column(name)
        if code.kind != "categorical" and block == 0:
            cols.append(F.element_at(arr, start + 1).alias(f"{name}_value"))
            continue
        if width == 0:
            cols.append(F.lit(None).cast("int").alias(f"{name}_slot"))
            continue
        blk = F.slice(arr, start + 1, width)
        mx = F.array_max(blk)
        slot = F.when(mx > F.lit(0.0), (F.array_position(blk, mx) - 1).cast("int"))
        cols.append(slot.alias(f"{name}_slot"))
    return enc.select(*cols)
