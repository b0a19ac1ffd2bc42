"""Command line: the reference's scripts as Spark jobs.

  python -m modenorm normalize SRC DST --col Amount [--key id] [--model-path P] [--lossless]
  python -m modenorm scaleup SRC DST --target 1000000000 [--chunk 10000000] [--format csv|parquet]
  python -m modenorm per-file SRC DST --col Amount [--head-rows 100000] [--model-path P]
  python -m modenorm profile SRC [--exact]
  python -m modenorm stream SRC DST --model-path P --col Amount [--checkpoint C]
  python -m modenorm encode SRC DST --key id --continuous a,b --mixed c:0|-9999999 --categorical d [--lossless]

``--partition-mb N`` before the command sizes input partitions (and exchanges, through AQE) to N MB.

The session comes from ``spark-submit`` / the environment (``MODENORM_MASTER``
for a local run); checkpoints go to the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="modenorm")
    p.add_argument("--partition-mb", type=float, default=None, help="size of input partitions; default: the session's")
    sub = p.add_subparsers(dest="cmd", required=True)

    n = sub.add_parser("normalize", help="sample -> fit -> score every row -> Parquet")
    n.add_argument("src")
    n.add_argument("dst")
    n.add_argument("--col", default="Amount")
    n.add_argument("--key", default=None)
    n.add_argument("--sample-rows", type=int, default=10_000)
    n.add_argument("--max-iter", type=int, default=200)
    n.add_argument("--fit-files", type=int, default=None)
    n.add_argument("--model-path", default=None)
    n.add_argument("--lossless", action="store_true")

    s = sub.add_parser("scaleup", help="replicate + keyed noise to an exact row count, one folder per chunk")
    s.add_argument("src")
    s.add_argument("dst")
    s.add_argument("--target", type=int, required=True)
    s.add_argument("--chunk", type=int, default=10_000_000)
    s.add_argument("--sd", type=float, default=0.01)
    s.add_argument("--seed", type=int, default=42)
    s.add_argument("--format", choices=["csv", "parquet"], default="csv")
    s.add_argument("--noise", choices=["hash64", "keyed", "fast"], default="hash64")

    s.add_argument("--files", action="store_true", help="one file chunk_<i>.parquet per chunk instead of a folder")

    f = sub.add_parser("per-file", help="fit on the head of the first file, write transformed_<file> for each input file")
    f.add_argument("src")
    f.add_argument("dst")
    f.add_argument("--col", default="Amount")
    f.add_argument("--head-rows", type=int, default=100_000)
    f.add_argument("--max-iter", type=int, default=200)
    f.add_argument("--model-path", default=None)
    f.add_argument("--folders", action="store_true", help="a folder source_file=transformed_<file> instead of a file")

    r = sub.add_parser("profile", help="rows, size, missing values, describe statistics")
    r.add_argument("src")
    r.add_argument("--exact", action="store_true")

    t = sub.add_parser("stream", help="score new files incrementally with a saved model")
    t.add_argument("src")
    t.add_argument("dst")
    t.add_argument("--model-path", required=True)
    t.add_argument("--col", default="Amount")
    t.add_argument("--checkpoint", default=None)

    e = sub.add_parser("encode", help="fit the reversible encoder, write the encoding and the round-trip report")
    e.add_argument("src")
    e.add_argument("dst")
    e.add_argument("--key", required=True)
    e.add_argument("--continuous", default="")
    e.add_argument("--mixed", action="append", default=[], help="name:v1|v2 (modal values)")
    e.add_argument("--categorical", default="")
    e.add_argument("--sample-rows", type=int, default=None, help="fit on a sample; default: all rows")
    e.add_argument("--lossless", action="store_true")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    if spark is None:
        from modenorm.session import get_spark

        spark = get_spark()
    if args.partition_mb:
        from modenorm.sources.io import set_partition_bytes

        set_partition_bytes(spark, int(args.partition_mb * 1024 * 1024))
    if args.cmd == "normalize":
        from modenorm.plans.jobs import normalize_job

        model = normalize_job(spark, args.src, args.dst, col=args.col, key=args.key, sample_rows=args.sample_rows,
                              fit_files=args.fit_files, model_path=args.model_path, keep_overflow=args.lossless,
                              max_iter=args.max_iter)
        print(f"fitted {model.k} modes in {model.info.get('n_iter')} iterations; scored rows written to {args.dst}")
    elif args.cmd == "scaleup":
        from modenorm.operators.scaleup import scale_up

        scale_up(spark, args.src, args.dst, args.target, chunk=args.chunk, sd=args.sd, seed=args.seed,
                 fmt=args.format, noise=args.noise, files=args.files)
        print(f"{args.target} rows written to {args.dst}")
    elif args.cmd == "per-file":
        from modenorm.plans.jobs import per_file_job

        per_file_job(spark, args.src, args.dst, col=args.col, head_rows=args.head_rows, max_iter=args.max_iter,
                     model_path=args.model_path, folders=args.folders)
        print(f"transformed files written to {args.dst}")
    elif args.cmd == "profile":
        from modenorm.plans.jobs import profile_job

        for row in profile_job(spark, args.src, exact=args.exact).collect():
            print(f"{row['section']:9s} {row['column'] or '-':24s} {row['metric']:8s} {row['value']}")
    elif args.cmd == "stream":
        from modenorm.operators.model import load_model
        from modenorm.streaming.stream import score_stream

        model = load_model(spark, args.model_path)[(args.col, "main")]
        score_stream(spark, args.src, args.dst, model, args.col, checkpoint=args.checkpoint)
        print(f"new files of {args.src} scored into {args.dst}")
    elif args.cmd == "encode":
        from modenorm.operators.encode import ColumnSpec, save_encoder
        from modenorm.plans.jobs import encoder_job
        from modenorm.sources.io import read_table, write_table

        specs = [ColumnSpec(c) for c in args.continuous.split(",") if c]
        for m in args.mixed:
            name, _, vals = m.partition(":")
            specs.append(ColumnSpec(name, "mixed", tuple(float(v) for v in vals.split("|") if v)))
        specs += [ColumnSpec(c, "categorical") for c in args.categorical.split(",") if c]
        df = read_table(spark, args.src)
        enc, encoded, report = encoder_job(df, specs, key=args.key, sample_rows=args.sample_rows,
                                           lossless=args.lossless)
        base = args.dst.rstrip("/")
        write_table(encoded, f"{base}/encoded")
        save_encoder(spark, enc, f"{base}/encoder")
        for row in report.orderBy("col", "mode").collect():
            print(row.asDict())
    return 0


if __name__ == "__main__":
    sys.exit(main())
