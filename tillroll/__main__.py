"""Command line: run the whole analysis on a CSV export, or query its saved results.

    python -m tillroll run CSV_FOLDER RESULT_FOLDER [--warehouse FOLDER] [--trials N] [--max-trees N]
    python -m tillroll sql RESULT_FOLDER "SELECT ..." [--csv OUT_FOLDER]
    python -m tillroll sql RESULT_FOLDER --preset campaign_roi
"""

from __future__ import annotations

import argparse

from .ml.clv import ClvParams
from .params import Params
from .plans.job import run_analysis
from .plans.presets import PRESETS, export_csv, query
from .plans.views import VIEWS
from .session import build_session, size_shuffles
from .sources.csv_files import read_csv_tables
from .sources.store import RESULT_TABLES, Store, publish

DATABASE = "tillroll"


def run(args: argparse.Namespace) -> None:
    spark = build_session()
    size_shuffles(spark, args.source, args.cores, args.input_bytes)
    store = Store(spark, DATABASE, args.warehouse or f"{args.results.rstrip('/')}/_tables")
    store.load_raw(read_csv_tables(spark, args.source), buckets=args.buckets)
    settings = ClvParams(trials=args.trials, max_trees=args.max_trees)
    run_analysis(spark, store.raw(), Params(), store, settings)
    target = args.results.rstrip("/")
    saved = publish(
        store,
        lambda frame, name: frame.write.mode("overwrite").parquet(f"{target}/{name}"),
        extra=VIEWS,
    )
    print("\n".join(saved))


def sql(args: argparse.Namespace) -> None:
    spark = build_session()
    folder = args.results.rstrip("/")
    for table in {*RESULT_TABLES, *VIEWS}:
        spark.read.parquet(f"{folder}/{table}").createOrReplaceTempView(table)
    result = PRESETS[args.preset](spark) if args.preset else query(spark, args.text)
    if args.csv:
        export_csv(result, args.csv)
    else:
        result.show(50, truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillroll", description=__doc__)
    commands = parser.add_subparsers(required=True)
    job = commands.add_parser("run")
    job.add_argument("source")
    job.add_argument("results")
    job.add_argument("--trials", type=int, default=50)
    job.add_argument("--max-trees", type=int, default=1000)
    job.add_argument("--buckets", type=int, default=0)
    job.add_argument("--input-bytes", type=int, default=0, help="measured when not given")
    job.add_argument("--cores", type=int, default=0, help="the cluster's when not given")
    job.add_argument("--warehouse", help="folder of the tables; RESULT_FOLDER/_tables when not given")
    job.set_defaults(call=run)
    ask = commands.add_parser("sql")
    ask.add_argument("results")
    ask.add_argument("text", nargs="?", default="SELECT * FROM rfm_segments LIMIT 10")
    ask.add_argument("--preset", choices=list(PRESETS))
    ask.add_argument("--csv")
    ask.set_defaults(call=sql)
    args = parser.parse_args(argv)
    args.call(args)


if __name__ == "__main__":
    main()
