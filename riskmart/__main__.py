"""Run the daily steps with ``python -m riskmart``, or on a cluster, the package zipped, with

    spark-submit --packages <kafka connector> --py-files riskmart.zip riskmart/__main__.py \\
        daily --kafka broker:9092 --root hdfs:///lake/risk
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from riskmart.operators.cleaning import DEFAULT_HORIZON, Horizon
from riskmart.plans import daily
from riskmart.session import build_session
from riskmart.sinks.serving import ParquetTarget, VersionedTarget
from riskmart.sources.messages import FileLog, KafkaLog
from riskmart.streaming.ingest import ingest_all

STEPS = {
    "ingest": lambda spark, c: ingest_all(spark, c.log, c.specs().values(), c.layer("raw")),
    "stage": daily.load_staging,
    "clean": daily.load_clean,
    "mart": daily.load_mart,
    "register": lambda spark, c: daily.register_layers(spark, c, c.catalog or ""),
    "publish": daily.publish_mart,
    "daily": daily.run_daily,
}


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="riskmart")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True, help="folder of the layers")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", help="bootstrap servers")
    source.add_argument("--files", help="root folder of a file log")
    parser.add_argument("--prefix", default="raw_", help="topic prefix")
    parser.add_argument("--min-partitions", type=int, help="read tasks of a topic at least, which splits a hot topic partition")
    parser.add_argument("--catalog", help="name prefix under which the layers are registered, with statistics")
    parser.add_argument("--serving", help="folder of the published mart, default <root>/serving")
    parser.add_argument("--versions", action="store_true", help="publish to versions, so that readers never miss the mart")
    parser.add_argument("--incremental", action="store_true", help="take in new raw files and rewrite changed months only")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="default today")
    parser.add_argument("--from", dest="start", type=dt.date.fromisoformat, default=DEFAULT_HORIZON.start)
    parser.add_argument("--until", dest="end", type=dt.date.fromisoformat, default=DEFAULT_HORIZON.end)
    parser.add_argument("--on-bad", choices=("error", "null"), default="error")
    parser.add_argument("--null-policy", choices=("zero", "fail", "keep"), default="zero")
    parser.add_argument("--publish-mode", choices=("overwrite", "append"), default="overwrite")
    parser.add_argument("--wide-ids", action="store_true")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    target = VersionedTarget if args.versions else ParquetTarget
    config = daily.DailyConfig(
        log=KafkaLog(args.kafka, args.prefix, min_partitions=args.min_partitions) if args.kafka else FileLog(args.files),
        root=args.root,
        target=target(args.serving or f"{args.root}/serving"),
        as_of=args.as_of,
        horizon=Horizon(args.start, args.end),
        wide_ids=args.wide_ids,
        on_bad=args.on_bad,
        null_policy=args.null_policy,
        publish_mode=args.publish_mode,
        catalog=args.catalog,
        incremental=args.incremental,
    )
    print(STEPS[args.step](spark or build_session(), config))


if __name__ == "__main__":
    main()
