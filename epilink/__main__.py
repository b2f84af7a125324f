"""Command line: ``python -m epilink <command> --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from . import vocabulary
from .operators.metrics import metrics_row, observe_ingestion
from .plans import ingest, jobs
from .session import get_session
from .sinks import append_metrics, publish, read_dictionary, update_dictionary, write_json_map
from .sources import is_batch_table, read_json_map, read_table
from .sources.payloads import has_reading
from .streaming import default_sources, run_all, topic_location


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="epilink")
    commands = parser.add_subparsers(dest="command", required=True)

    c = commands.add_parser("harmonize", help="run the five streams")
    c.add_argument("--base", required=True)
    c.add_argument("--checkpoints", required=True)
    c.add_argument("--servers", default=vocabulary.BOOTSTRAP_SERVERS)
    c.add_argument("--interval", default=vocabulary.TRIGGER_INTERVAL)
    c.add_argument("--available-now", action="store_true")
    c.add_argument("--folder", help="read topics as text files below this folder instead of a broker")
    c.add_argument("--console", action="store_true", help="also print every batch of the keyed sources")
    c.add_argument("--sink", choices=("batches", "files"), default="batches", help="tables with a log of batches, or Spark's file sink")
    c.add_argument("--restarts", type=int, default=0, help="how often a source that fails is started again from its checkpoint")
    c.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="option of the topic reader, such as maxOffsetsPerTrigger=100000")

    c = commands.add_parser("publish", help="complete raw rows of a Parquet table and send them to their topic")
    c.add_argument("kind", choices=sorted(vocabulary.TOPICS))
    c.add_argument("--input", required=True)
    c.add_argument("--servers", default=vocabulary.BOOTSTRAP_SERVERS)
    c.add_argument("--metrics-log", required=True)
    c.add_argument("--folder", help="write topics as text files below this folder instead of a broker")
    c.add_argument("--aliases", help="Parquet table alias, canonical, province, rank instead of the built-in places")
    c.add_argument("--gazetteer", help="JSON object of name|country to lat and lon, or a stored gazetteer, instead of the built-in one")
    c.add_argument("--fallback", help="Parquet table name, lat, lon instead of the built-in points")

    c = commands.add_parser("link", help="link cases with weather and alerts")
    c.add_argument("--base", required=True)
    c.add_argument("--out")
    c.add_argument("--weeks", nargs=2, metavar=("FIRST", "LAST"), help="only these weeks, such as 2026-W01 2026-W26; others are not read")

    c = commands.add_parser("graph", help="merge the tables into the stored knowledge graph and export it")
    c.add_argument("--base", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--namespace", default=vocabulary.NAMESPACE)

    c = commands.add_parser("policies", help="policy and status from a graph")
    c.add_argument("--graph", required=True)
    c.add_argument("--namespace", default=vocabulary.NAMESPACE)

    for name in ("property-graph", "edges"):
        c = commands.add_parser(name, help=f"{name} tables from a graph")
        c.add_argument("--graph", required=True)
        c.add_argument("--out", required=True)

    c = commands.add_parser("dictionary", help="add the entries of a JSON object of name|country to a stored gazetteer")
    c.add_argument("--store", required=True, help="folder of the stored gazetteer, as publish takes it")
    c.add_argument("--add", required=True, help="JSON object of name|country to lat and lon")
    c.add_argument("--export", help="also write the whole gazetteer as one JSON object")

    c = commands.add_parser("summaries", help="cases, temperature and alerts per place")
    c.add_argument("--base", required=True)
    c.add_argument("--out")

    c = commands.add_parser("metrics", help="ingestion runs per source")
    c.add_argument("--log", required=True)
    return parser


def _print_all(table) -> None:
    """Every row, tab-separated under the names; the driver holds one partition at a time."""
    print(*table.columns, sep="\t")
    for row in table.toLocalIterator():
        print(*row, sep="\t")


def _gazetteer(spark, path):
    """A stored gazetteer, or one in a JSON file."""
    return read_dictionary(spark, path) if is_batch_table(spark, path) else read_json_map(spark, path)


def _dictionaries(spark, args) -> dict:
    """Place dictionaries that were given, by the names ``plans.ingest`` takes them under."""
    readers = {"aliases": read_table, "gazetteer": _gazetteer, "fallback": read_table}
    return {name: read(spark, getattr(args, name)) for name, read in readers.items() if getattr(args, name)}


def _records(kind: str, raw, dictionaries: dict):
    """Messages of raw rows; news rows are the items of the feeds already."""
    if kind == "news":
        return raw
    if kind == "policy":
        return ingest.policy_records(raw)
    return getattr(ingest, {"alerts": "alert_records"}.get(kind, f"{kind}_records"))(raw, **dictionaries)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = get_session()
    if args.command == "harmonize":
        sources = default_sources(args.base, args.checkpoints, folder=args.folder, servers=args.servers, tee=args.console, sink=args.sink, options=dict(o.split("=", 1) for o in args.option))
        run_all(spark, sources, available_now=args.available_now, interval=args.interval, restarts=args.restarts)
    elif args.command == "publish":
        raw = spark.read.parquet(args.input)
        if args.kind == "news":
            raw = ingest.news_records(raw, "value")
        valid = has_reading("value") if args.kind == "weather" else F.lit(True)
        counted, observed = observe_ingestion(raw, args.kind, valid)
        topic, form = topic_location(args.kind, args.folder)
        publish(_records(args.kind, counted.where(valid), _dictionaries(spark, args)), topic, args.servers, format=form)
        counts = observed.get
        row = metrics_row(
            spark, vocabulary.METRIC_TAGS[args.kind], counts["records_attempted"], counts["records_succeeded"]
        )
        append_metrics(row, args.metrics_log)
    elif args.command == "link":
        path = jobs.link_job(spark, args.base, args.out, weeks=args.weeks and tuple(args.weeks))
        print(path or "nothing to link: cases and weather are both needed")
    elif args.command == "graph":
        print(jobs.graph_job(spark, args.base, args.out, args.namespace), "triples")
    elif args.command == "policies":
        _print_all(jobs.policy_job(spark, args.graph, args.namespace))
    elif args.command == "property-graph":
        print(*jobs.property_graph_job(spark, args.graph, args.out))
    elif args.command == "edges":
        print(jobs.edge_job(spark, args.graph, args.out))
    elif args.command == "dictionary":
        print(update_dictionary(read_json_map(spark, args.add), args.store).rows, "entries")
        if args.export:
            write_json_map(read_dictionary(spark, args.store), args.export)
    elif args.command == "summaries":
        for name, table in jobs.summary_job(spark, args.base, args.out).items():
            print(name)
            _print_all(table)
    elif args.command == "metrics":
        _print_all(jobs.metrics_job(spark, args.log))


if __name__ == "__main__":
    main()
