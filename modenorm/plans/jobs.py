"""End-to-end jobs (H1-H4), each a short composition of the operators.

H1  normalize_job:   sample -> fit -> score every row -> Parquet (+ model table)
H2  encoder_job:     fit encoder -> encode -> decode -> round-trip report
H3  profile_job:     one-pass profile of a dataset
H4  per_file_job:    fit on the head of the first file, score with one output folder per input file
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modenorm.operators.encode import ColumnSpec, Encoder, encode, fit_encoder
from modenorm.operators.evaluate import roundtrip_report
from modenorm.operators.fit import DEFAULT_MAX_ITER, fit_modes
from modenorm.operators.model import Mixture, save_model
from modenorm.operators.profile import profile
from modenorm.operators.sampling import DEFAULT_SAMPLE_ROWS, head_n, sample_n
from modenorm.operators.score import score
from modenorm.sources.io import first_files, read_table, source_name, write_per_source, write_source_files, write_table


def fit_on_sample(df: DataFrame, col: str, key: str | None = None, sample_rows: int = DEFAULT_SAMPLE_ROWS,
                  seed: int = 42, k: int = 10, max_iter: int = DEFAULT_MAX_ITER, rng: str = "hash64",
                  **kw) -> Mixture:
    """Fit on an exact seeded sample (only the key and the column are read)."""
    keyed = df.select(key, col) if key is not None else df.select(col, "_metadata")
    sample = sample_n(keyed, sample_rows, seed, key=key, rng=rng)
    return fit_modes(sample.select(col), col, k=k, max_iter=max_iter, **kw)


def normalize_job(spark: SparkSession, src: str | Sequence[str], dst: str, col: str = "Amount",
                  key: str | None = None, sample_rows: int = DEFAULT_SAMPLE_ROWS, seed: int = 42,
                  fit_files: int | None = None, model_path: str | None = None, keep_overflow: bool = False,
                  **fit_kw) -> Mixture:
    """H1: the reference's flagship, distributed end to end."""
    df = read_table(spark, src)
    fit_src = first_files(spark, df, fit_files) if fit_files else df
    model = fit_on_sample(fit_src, col, key=key, sample_rows=sample_rows, seed=seed, **fit_kw)
    write_table(score(df, col, model, keep_overflow=keep_overflow), dst)
    if model_path:
        save_model(spark, [model], model_path)
    return model


def flagship_frame(spark: SparkSession, sf_dir: str, table: str = "events", col: str = "value",
                   key: str = "event_id", max_iter: int = DEFAULT_MAX_ITER) -> DataFrame:
    """H1 without the sink: the scored table as a lazy DataFrame."""
    df = read_table(spark, f"{sf_dir.rstrip('/')}/{table}.parquet")
    model = fit_on_sample(df, col, key=key, max_iter=max_iter)
    return score(df, col, model)


def encoder_job(df: DataFrame, specs: Sequence[ColumnSpec], key: str, sample_rows: int | None = None,
                lossless: bool = False, **kw) -> tuple[Encoder, DataFrame, DataFrame]:
    """H2: fit -> encode -> report; returns (encoder, encoded table, round-trip report)."""
    enc = fit_encoder(df, specs, key=key, sample_rows=sample_rows, **kw)
    encoded = encode(df, enc, key, keep_overflow=lossless)
    return enc, encoded, roundtrip_report(df, enc, key, lossless=lossless)


def profile_job(spark: SparkSession, src: str | Sequence[str], exact: bool = False) -> DataFrame:
    """H3."""
    return profile(read_table(spark, src), exact=exact)


def per_file_job(spark: SparkSession, src: str | Sequence[str], dst: str, col: str = "Amount", head_rows: int = 100_000,
                 model_path: str | None = None, folders: bool = False, **fit_kw) -> Mixture:
    """H4: fit on the first ``head_rows`` rows of the first file; one output file ``transformed_<file>`` per input file
    (``folders``: a folder of several files instead, for input files that one task should not write)."""
    df = read_table(spark, src)
    first = first_files(spark, df, 1)
    head = first.where(F.col("_metadata.row_index") < F.lit(head_rows)).select(col)
    model = fit_modes(head, col, **fit_kw)
    (write_per_source if folders else write_source_files)(score(df, col, model), dst)
    if model_path:
        save_model(spark, [model], model_path)
    return model


def per_file_frame(spark: SparkSession, src: str, col: str, head_rows: int = 100_000, **fit_kw) -> DataFrame:
    """H4 without the sink: scored rows tagged with their output file name."""
    df = read_table(spark, src)
    head = head_n(first_files(spark, df, 1).select(col, "_metadata"), head_rows).select(col)
    model = fit_modes(head, col, **fit_kw)
    return score(df, col, model).withColumn("source_file", F.concat(F.lit("transformed_"), source_name(df)))
