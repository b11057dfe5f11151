"""Command line of the jobs, for ``spark-submit`` or ``python -m feedworks``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from feedworks.plans import jobs
from feedworks.sinks import index_options
from feedworks.streaming import files_sink, index_sink, table_sink, upsert_sink


def _sink(args):
    if args.json:
        return files_sink(args.json, pack_every=args.pack_every)
    if args.table:
        return table_sink(args.table, pack_every=args.pack_every)
    if args.upsert:
        keyless = files_sink(f"{_quarantine(args)}_keyless")
        return upsert_sink(args.upsert, args.key, args.order_by, keyless=keyless)
    return index_sink(index_options(args.index, args.index_nodes, args.key))


def _quarantine(args) -> str:
    return args.quarantine or f"{args.checkpoint.rstrip('/')}_quarantine"


def _bounds(**options) -> dict[str, str]:
    """Options of a source that bound a batch, those that are set."""
    return {name: value for name, value in options.items() if value is not None}


def _add_sinks(command) -> None:
    target = command.add_mutually_exclusive_group(required=True)
    target.add_argument("--json", metavar="FOLDER")
    target.add_argument("--table")
    target.add_argument("--upsert", metavar="TABLE")
    target.add_argument("--index", metavar="RESOURCE")
    command.add_argument("--index-nodes", default="localhost:9200")
    command.add_argument("--key", default="event_id")
    command.add_argument("--order-by", nargs="*", default=[])
    command.add_argument("--pack-every", type=int, metavar="BATCHES", help="bring small files of earlier batches together")
    command.add_argument("--checkpoint", required=True)
    command.add_argument("--quarantine", metavar="FOLDER", help="broken records; beside the checkpoint by default")
    command.add_argument("--once", action="store_true", help="work off what is there and end")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="feedworks")
    commands = top.add_subparsers(dest="job", required=True)

    def job(name, *arguments):
        command = commands.add_parser(name)
        for argument in arguments:
            command.add_argument(argument)
        return command

    archive = job("xml-to-json", "source", "archive", "output")
    csv = job("xml-to-csv", "source", "output")
    table = job("xml-to-table", "source")
    table.add_argument("--table", default="ng_events")
    table.add_argument("--flat", action="store_true")
    for command in (csv, table):
        command.add_argument("--quarantine", help="broken records; beside the output by default")
    for command in (archive, csv, table):
        command.add_argument("--large-documents", action="store_true",
                             help="documents that are too large to be one record")
    csv = job("csv-to-upsert", "source", "table")
    csv.add_argument("--key", default="event_id")
    csv.add_argument("--order-by", nargs="*", default=[])
    csv.add_argument("--quarantine", metavar="TABLE", help="rows without a key; named after the table by default")
    index = job("csv-to-index", "source", "resource")
    index.add_argument("--index-nodes", default="localhost:9200")
    index.add_argument("--key")
    job("catalogue-to-csv", "source", "output")

    jdbc = job("jdbc-to-parquet", "url", "table", "output")
    jdbc.add_argument("--driver")
    jdbc.add_argument("--user")
    jdbc.add_argument("--password-variable", default="JDBC_PASSWORD",
                      help="environment variable that holds the password")
    jdbc.add_argument("--partition-column")
    jdbc.add_argument("--lower")
    jdbc.add_argument("--upper")
    jdbc.add_argument("--num-partitions", type=int)

    xml = job("xml-stream", "source")
    xml.add_argument("--doc-id", action=argparse.BooleanOptionalAction,
                     help="hashed id of the event; by default with --json")
    xml.add_argument("--max-files", help="most files of a batch")
    xml.add_argument("--max-bytes", help="most bytes of a batch")
    _add_sinks(xml)
    kafka = job("kafka-stream", "servers", "topic")
    kafka.add_argument("--starting", default="latest")
    kafka.add_argument("--group")
    kafka.add_argument("--max-offsets", help="most messages of a batch")
    _add_sinks(kafka)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"feedworks-{args.job}").getOrCreate()
    if args.job == "xml-to-json":
        jobs.xml_to_json(spark, args.source, args.archive, args.output, args.large_documents)
    elif args.job == "xml-to-csv":
        jobs.xml_to_csv(spark, args.source, args.output, args.large_documents, args.quarantine)
    elif args.job == "xml-to-table":
        jobs.xml_to_table(spark, args.source, args.table, not args.flat, args.large_documents, args.quarantine)
    elif args.job == "csv-to-upsert":
        jobs.csv_to_upsert(spark, args.source, args.table, args.key, args.order_by, args.quarantine)
    elif args.job == "csv-to-index":
        options = index_options(args.resource, args.index_nodes, args.key, upsert=args.key is not None)
        jobs.csv_to_index(spark, args.source, options)
    elif args.job == "catalogue-to-csv":
        jobs.catalogue_to_csv(spark, args.source, args.output)
    elif args.job == "jdbc-to-parquet":
        jobs.jdbc_to_parquet(
            spark, args.url, args.table, args.output, driver=args.driver, user=args.user,
            password=os.environ.get(args.password_variable), partition_column=args.partition_column,
            lower=args.lower, upper=args.upper, num_partitions=args.num_partitions)
    elif args.job == "xml-stream":
        doc_id = args.doc_id if args.doc_id is not None else args.json is not None
        bounds = _bounds(maxFilesPerTrigger=args.max_files, maxBytesPerTrigger=args.max_bytes)
        jobs.xml_stream_to(spark, args.source, _sink(args), args.checkpoint, doc_id,
                           None if args.once else "30 seconds", _quarantine(args), **bounds).awaitTermination()
    else:
        jobs.kafka_to(spark, args.servers, args.topic, _sink(args), args.checkpoint,
                      None if args.once else "30 seconds", _quarantine(args),
                      starting=args.starting, group=args.group,
                      **_bounds(max_offsets=args.max_offsets)).awaitTermination()


if __name__ == "__main__":
    main()
