"""The monitor as a job: ``python -m tallywatch --data-dir /shared/monitor --bootstrap kafka:9092``, or with spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tallywatch.schema import MonitorConfig
from tallywatch.session import pin_session
from tallywatch.sources.messages import read_line_stream
from tallywatch.streaming.monitor import kafka_messages, start_monitor


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    default = MonitorConfig(data_dir="")
    parser = argparse.ArgumentParser(prog="tallywatch", description="Stream of transactions to ledger, metrics and recent transactions.")
    parser.add_argument("--data-dir", required=True, help="folder of all tables, shared by driver and executors")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--bootstrap", default=default.bootstrap, help="Kafka servers")
    source.add_argument("--lines", help="read files of JSON lines in this folder instead of Kafka")
    parser.add_argument("--topic", default=default.topic)
    parser.add_argument("--starting-offsets", default=default.starting_offsets, help="earliest, latest, or a JSON text of offsets; only for the first start")
    parser.add_argument("--trigger", default=default.trigger, help="time between batches")
    parser.add_argument("--max-per-trigger", type=int, help="most messages of a batch, or files with --lines")
    parser.add_argument("--max-bytes-per-trigger", help="with --lines: most bytes of a batch, such as 64m")
    parser.add_argument("--allow-data-loss", action="store_true", help="go on when messages or files that were not read yet are gone")
    parser.add_argument("--recompute", action="store_true", help="metrics from the whole ledger in each batch, without state")
    parser.add_argument("--dedup", action="store_true", help="drop transactions that were delivered before")
    parser.add_argument("--available-now", action="store_true", help="handle what is there, and end")
    return parser.parse_args(argv)


def config_of(args: argparse.Namespace) -> MonitorConfig:
    return MonitorConfig(
        data_dir=args.data_dir.rstrip("/"), bootstrap=args.bootstrap, topic=args.topic, starting_offsets=args.starting_offsets, trigger=args.trigger,
        max_per_trigger=args.max_per_trigger, fail_on_data_loss=not args.allow_data_loss, incremental=not args.recompute, dedup=args.dedup,
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = pin_session(SparkSession.builder.appName("tallywatch").getOrCreate())
    config = config_of(args)
    if args.lines:
        messages = read_line_stream(spark, args.lines, config.max_per_trigger, args.max_bytes_per_trigger, config.fail_on_data_loss)
    else:
        messages = kafka_messages(spark, config)
    start_monitor(spark, messages, config, available_now=args.available_now).awaitTermination()


if __name__ == "__main__":
    main()
