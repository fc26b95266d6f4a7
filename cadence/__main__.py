"""Command line for schedulers: ``spark-submit -m cadence <command> ...``
(or ``python -m cadence``).

  run-batch  --raw PATH --warehouse PATH --batch-id ID [--format csv|parquet]
             [--multiline] [--csv-one-line] [--as-of TS] [--latest-cap N] [--keep-rejects]
             [--database NAME]                 (names for other sessions in the catalog)
             [--plays-once]                    (a play that several batches bring counts once)
  compact    --warehouse PATH [--vacuum-keep K]
  stream     --landing PATH --warehouse PATH --checkpoint PATH [--max-files N]
             [--processing-time '5 minutes']   (default: process what is there, then stop)
             [--plays-once] [--fail-on-reject] (default: bad records are stored as rejects)
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cadence")
    sub = ap.add_subparsers(dest="cmd", required=True)
    rb = sub.add_parser("run-batch")
    rb.add_argument("--raw", required=True)
    rb.add_argument("--warehouse", required=True)
    rb.add_argument("--batch-id", required=True)
    rb.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    rb.add_argument("--multiline", action="store_true")
    rb.add_argument("--csv-one-line", action="store_true",
                    help="texts hold no line ends: read large CSV files in several tasks")
    rb.add_argument("--as-of")
    rb.add_argument("--latest-cap", type=int)
    rb.add_argument("--keep-rejects", action="store_true",
                    help="write plays without a natural key to rejects/ instead of failing")
    rb.add_argument("--database", help="publish the tables' names in this database of the catalog")
    rb.add_argument("--plays-once", action="store_true",
                    help="leave out plays that another batch has brought")
    cp = sub.add_parser("compact")
    cp.add_argument("--warehouse", required=True)
    cp.add_argument("--vacuum-keep", type=int,
                    help="afterwards delete what only commits before the newest K name")
    st = sub.add_parser("stream")
    st.add_argument("--landing", required=True)
    st.add_argument("--warehouse", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--max-files", type=int)
    st.add_argument("--multiline", action="store_true")
    st.add_argument("--processing-time")
    st.add_argument("--fail-on-reject", action="store_true")
    st.add_argument("--plays-once", action="store_true")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from cadence.session import apply_cluster_conf, ensure_conf
    spark = apply_cluster_conf(ensure_conf(
        SparkSession.builder.appName(f"cadence-{args.cmd}").getOrCreate()))

    from cadence.sources.warehouse import Warehouse
    if args.cmd == "run-batch":
        from cadence.plans.batch_job import run_batch_job
        res = run_batch_job(spark, args.raw, args.warehouse, args.batch_id, fmt=args.format,
                            multiline=args.multiline, as_of=args.as_of,
                            latest_cap=args.latest_cap, fail_on_reject=not args.keep_rejects,
                            csv_multiline=not args.csv_one_line, identity=args.plays_once,
                            database=args.database)
        res.checks.show(truncate=False)
    elif args.cmd == "compact":
        from cadence.operators.star import compact, vacuum
        from cadence.plans.models import register_all
        wh = Warehouse(spark, args.warehouse)
        print(f"version {compact(wh)}")
        if args.vacuum_keep:
            print(f"vacuum removed {len(vacuum(wh, keep_versions=args.vacuum_keep))} folders")
        # Views of this session would go on reading what the old version named.
        register_all(wh)
    else:
        from cadence.streaming.incremental import run_incremental, start_incremental
        wh = Warehouse(spark, args.warehouse)
        if args.processing_time:
            wh.create_tables()
            start_incremental(spark, args.landing, wh, args.checkpoint, available_now=False,
                              processing_time=args.processing_time,
                              max_files_per_trigger=args.max_files,
                              multiline=args.multiline,
                              fail_on_reject=args.fail_on_reject,
                              identity=args.plays_once).awaitTermination()
        else:
            run_incremental(spark, args.landing, wh, args.checkpoint,
                            max_files_per_trigger=args.max_files, multiline=args.multiline,
                            fail_on_reject=args.fail_on_reject, identity=args.plays_once)
    return 0


if __name__ == "__main__":
    sys.exit(main())
