"""Command line: ``stream``, ``tap``, ``batch``, ``promote`` (clean zone to the star), ``curate`` (stored reports), and single steps:
``load``, ``fill``, ``clean``, ``unlock``."""

from __future__ import annotations

import argparse
from datetime import datetime

from .operators.dims import DIMENSIONS
from .operators.facts import FACTS
from .plans.batch import load_star, refresh_marts, run_batch
from .plans.warehouse import PROMOTED, Warehouse
from .schemas import MART_TABLES, TABLES
from .session import build_session
from .sources.streams import RecordFiles, TopicSource, tap_stream
from .streaming.job import TRIGGER, run_streaming
from .streaming.lake import Lake


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tripflow")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str) -> argparse.ArgumentParser:
        return commands.add_parser(name, help=text)

    stream = add("stream", "route a topic to the lake zones")
    tap = add("tap", "print new records of a topic")
    for command in (stream, tap):
        command.add_argument("--servers", default=TopicSource.servers)
        command.add_argument("--topic", default=TopicSource.topic)
    stream.add_argument("--group", default=TopicSource.group_id)
    stream.add_argument("--records", help="folder of record files to read instead of a topic")
    stream.add_argument("--lake", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--trigger", default=TRIGGER)
    stream.add_argument("--drain", action="store_true", help="process what is available and stop")
    stream.add_argument("--max-records-per-batch", type=int)
    stream.add_argument("--min-partitions", type=int)
    stream.add_argument("--show-samples", type=int, default=0)

    batch = add("batch", "load the newest delivery of a folder, or one .jsonl file or folder")
    batch.add_argument("--source", required=True)
    batch.add_argument("--raw", help="folder that receives the files as they are")
    promote = add("promote", "load clean-zone events into the star")
    promote.add_argument("--lake", required=True)
    promote.add_argument("--date", help="one ingestion date, whole; without it all batches that were not promoted before")
    curate = add("curate", "add new loads to the stored reports")
    load = add("load", "load one dimension or fact from staging")
    fill = add("fill", "fill missing keys of one fact")
    clean = add("clean", "remove folders of replaced table contents")
    clean.add_argument("--older-than-hours", type=float, default=24.0)
    unlock = add("unlock", "remove the lock that a dead writer left")
    load.add_argument("--table", required=True, choices=[*DIMENSIONS, *FACTS])
    fill.add_argument("--table", required=True, choices=[*FACTS])
    unlock.add_argument("--table", required=True, choices=[*TABLES, *MART_TABLES, PROMOTED])
    for command in (batch, promote, load):
        command.add_argument("--since", type=datetime.fromisoformat, help="read what was staged at or after this time")
    for command in (batch, promote, curate, load, fill, clean, unlock):
        command.add_argument("--warehouse", required=True, help="folder of the tables")
        command.add_argument("--database", default="warehouse")
        command.add_argument("--buckets", type=int)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"tripflow {args.command}", persistent_catalog=args.command not in ("stream", "tap"))
    if args.command == "stream":
        source = RecordFiles(args.records) if args.records else TopicSource(
            args.servers, args.topic, args.group,
            max_records_per_batch=args.max_records_per_batch, min_partitions=args.min_partitions,
        )
        trigger = None if args.drain else args.trigger
        run_streaming(
            spark, source, Lake(args.lake), args.checkpoint, trigger=trigger, show_samples=args.show_samples
        )
        return
    if args.command == "tap":
        source = TopicSource(
            args.servers, args.topic, group_id=None, starting_offsets="latest", fail_on_data_loss=True
        )
        tap_stream(spark, source).awaitTermination()
        return
    warehouse = Warehouse(spark, args.database, args.warehouse, args.buckets).create()
    if args.command == "batch":
        print(run_batch(spark, warehouse, args.source, args.raw, args.since))
    elif args.command == "promote":
        lake = Lake(args.lake)
        if args.date:
            clean = lake.read_clean(spark)
            counts = warehouse.stage_from_clean(clean.filter(clean.ingestion_date == args.date))
        else:
            counts = warehouse.promote(lake)
        print(counts | load_star(warehouse, args.since))
    elif args.command == "curate":
        print(refresh_marts(warehouse))
    elif args.command == "load":
        load = warehouse.load_dimension if args.table in DIMENSIONS else warehouse.load_fact
        print({args.table: load(args.table, since=args.since)})
    elif args.command == "fill":
        warehouse.fill_fact_keys(args.table)
    elif args.command == "clean":
        print({"removed": warehouse.clean(args.older_than_hours)})
    else:
        warehouse.unlock(args.table)


if __name__ == "__main__":
    main()
