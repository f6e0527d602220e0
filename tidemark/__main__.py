"""Command line: create the tables, load a window.  Any scheduler can run it
(the usual one: ``load`` once a day, without a date)."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from tidemark.plans.courses import COURSES
from tidemark.plans.pipeline import run
from tidemark.plans.warehouse import Warehouse
from tidemark.session import build_session
from tidemark.sources import JdbcSource, ParquetSource, Slices, Source
from tidemark.sources.sample import create_source


def source_of(spark: SparkSession, args: argparse.Namespace) -> Source:
    """The source that the arguments name."""
    if args.source:
        return ParquetSource(spark, args.source, COURSES.sources)
    properties = dict(text.split("=", 1) for text in args.jdbc_property)
    slices = {}
    for text in args.jdbc_slices:
        table, column, lower, upper, count = text.split(":")
        slices[table] = Slices(column, lower, upper, int(count))
    return JdbcSource(
        spark, args.jdbc_url, COURSES.sources, properties, slices, frozenset(args.jdbc_view)
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    sample = commands.add_parser("sample", help="(re)create the sample source tables")
    sample.add_argument("--source", required=True)
    sample.add_argument("--as-of", help="instant the sample stands at (default: now)")

    create = commands.add_parser("create", help="(re)create the warehouse tables, empty")
    create.add_argument("--warehouse", required=True)

    load = commands.add_parser("load", help="load the days [date, as-of)")
    where = load.add_mutually_exclusive_group(required=True)
    where.add_argument("--source", help="folder of parquet tables")
    where.add_argument("--jdbc-url", help="database with the tables, instead of a folder")
    load.add_argument(
        "--jdbc-property",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="for the connection: driver, user, password, ...; may be repeated",
    )
    load.add_argument(
        "--jdbc-slices",
        action="append",
        default=[],
        metavar="TABLE:COLUMN:LOW:HIGH:COUNT",
        help="read a large table in parallel; without it, by one task",
    )
    load.add_argument(
        "--jdbc-view", action="append", default=[], help="a view the database joins itself"
    )
    load.add_argument("--warehouse", required=True)
    load.add_argument("--date", help="first day to load (default: the day before as-of)")
    load.add_argument("--as-of", help="day after the last to load (default: today)")

    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    spark = build_session("tidemark")
    if args.command == "sample":
        create_source(spark, args.source, args.as_of)
    elif args.command == "create":
        Warehouse.create(spark, args.warehouse, COURSES)
    else:
        source = source_of(spark, args)
        result = run(
            COURSES, source, Warehouse(spark, args.warehouse, COURSES), args.date, args.as_of
        )
        print(", ".join(f"{name}: {rows}" for name, rows in result.affected.items()))


if __name__ == "__main__":
    main()
