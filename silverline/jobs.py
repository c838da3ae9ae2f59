"""Job entry points for ``spark-submit``.

    spark-submit silverline/jobs.py refresh --bronze s3a://lake/bronze \\
        --silver s3a://lake/silver --batch-id 1733212800
    spark-submit silverline/jobs.py stream --bronze s3a://lake/bronze \\
        --silver s3a://lake/silver --models encounters,observations --every "1 minute"

``refresh`` is one scheduled run (incremental silver, full rebuild of the
charts); ``stream`` keeps resource models fresh with micro-batches and, after
each, makes such a run for the other tables (``--no-charts``: without).  The
cluster's ``spark.checkpoint.dir`` must name a shared folder; stream
checkpoints go below the silver root.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from silverline.plans.incremental import refresh_all  # noqa: E402
from silverline.plans.silver import RESOURCE_MODELS  # noqa: E402
from silverline.session import configure  # noqa: E402
from silverline.sources.bronze import Bronze  # noqa: E402
from silverline.streaming.ingest import ingest_models  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="silverline")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("refresh", help="one scheduled refresh of every model")
    r.add_argument("--bronze", required=True, help="bronze root folder or catalog database")
    r.add_argument("--silver", required=True, help="silver root folder")
    r.add_argument("--batch-id", type=int, default=None, help="defaults to the epoch second")
    r.add_argument("--full-refresh", action="store_true")
    r.add_argument("--propagate-deletes", action="store_true")
    r.add_argument("--compact-after", type=int, default=8)
    r.add_argument("--keep-winners", action="store_true",
                   help="keep FINAL of metadata and links, fed by new files (bronze must be a folder)")
    s = sub.add_parser("stream", help="micro-batch ingest of resource models")
    s.add_argument("--bronze", required=True, help="bronze root folder (file stream source)")
    s.add_argument("--silver", required=True)
    s.add_argument("--models", default=",".join(RESOURCE_MODELS),
                   help="comma-separated resource models kept fresh by one stream")
    s.add_argument("--every", default="1 minute", help="processing-time trigger")
    s.add_argument("--once", action="store_true", help="drain what is there, then stop")
    s.add_argument("--no-charts", action="store_true", help="resource models only, no compaction")
    s.add_argument("--compact-after", type=int, default=8)
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"silverline-{args.command}").getOrCreate())
    bronze = Bronze.read(spark, args.bronze)
    if args.command == "refresh":
        timings: dict[str, float] = {}
        paths = refresh_all(spark, bronze, args.silver.rstrip("/"),
                            args.batch_id if args.batch_id is not None else int(time.time()),
                            full_refresh=args.full_refresh,
                            propagate_deletes=args.propagate_deletes,
                            compact_after=args.compact_after, timings=timings,
                            bronze_root=args.bronze.rstrip("/") if args.keep_winners else None)
        print(json.dumps({"tables": paths, "seconds": timings}))
    else:
        root = args.silver.rstrip("/")
        models = [m.strip() for m in args.models.split(",") if m.strip()]
        query = ingest_models(spark, args.bronze.rstrip("/"), bronze,
                              {m: f"{root}/{m}" for m in models},
                              f"{root}/_checkpoints/stream-{'-'.join(models)}",
                              trigger=None if args.once else {"processingTime": args.every},
                              after_batch=None if args.no_charts else lambda: refresh_all(
                                  spark, Bronze.read(spark, args.bronze), root, 1,
                                  compact_after=args.compact_after))
        query.awaitTermination()


if __name__ == "__main__":
    main()
