"""Command line: run the pipeline and reports over a data directory.

    python -m ledgerline list
    python -m ledgerline show top_city_per_hour --data /root/testdata/sf0.01
    python -m ledgerline run --data /root/testdata/sf0.1 --out /shared/reports [name ...]

``run`` builds the stored layers once, then writes every named report (all
when none is given) as parquet under ``--out/<name>``.  On a cluster, submit
it with spark-submit; the session's ``spark.checkpoint.dir`` names the
shared folder for the stored layers.
"""

from __future__ import annotations

import argparse
import os
import sys
import time


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerline")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    show = sub.add_parser("show")
    show.add_argument("name")
    show.add_argument("--data", required=True)
    show.add_argument("--rows", type=int, default=20)
    run = sub.add_parser("run")
    run.add_argument("names", nargs="*")
    run.add_argument("--data", required=True)
    run.add_argument("--out", required=True)
    args = parser.parse_args(argv)

    from ledgerline.plans.registry import REGISTRY
    if args.cmd == "list":
        print("\n".join(sorted(REGISTRY)))
        return 0

    from pyspark.sql import SparkSession

    from ledgerline.plans.warehouse import INPUTS, Warehouse
    from ledgerline.session import apply_scale_conf, checkpoint_root, get_spark, release_scratch
    from ledgerline.sources.tables import Tables
    active = SparkSession.getActiveSession()
    spark = active or get_spark()
    checkpoint_root(spark)
    if args.cmd == "show":
        REGISTRY[args.name](spark, args.data).show(args.rows, truncate=False)
        return 0

    # Partition sizes for this input, before any plan is made.
    state = Tables(spark, args.data).state(INPUTS)
    apply_scale_conf(spark, input_bytes=state[1] or 0, total_cores=spark.sparkContext.defaultParallelism)
    Warehouse.of(spark, args.data).build()
    for name in args.names or sorted(REGISTRY):
        t = time.perf_counter()
        REGISTRY[name](spark, args.data).write.mode("overwrite").parquet(os.path.join(args.out, name))
        print(f"{name}\t{time.perf_counter() - t:.2f}s", file=sys.stderr)
    if not active:  # a session of our own: the reports are written, nothing reads the layers any more
        release_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
