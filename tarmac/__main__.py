"""Run one report from files to text lines::

    spark-submit run_report.py departure-delay --year 2004 \\
        --flights hdfs:///data/flights.csv --aircrafts hdfs:///data/aircrafts.csv \\
        --airlines hdfs:///data/airlines.csv --output hdfs:///results/delay
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.texts import CESSNA_LABEL
from tarmac.model import AIRCRAFTS, AIRLINES, FLIGHTS, Relation
from tarmac.operators.filters import CESSNA, UNITED_STATES
from tarmac.plans import departure_delay, popular_types, top_models
from tarmac.sinks import write_flights_by_year, write_tuple_text
from tarmac.sources import read_parquet, read_relation

# The columns each report wants of a CSV file; a line is long enough if it reaches them.
TAIL = ["tail_number"]
CARRIER_AND_TAIL = ["carrier_code", "tail_number"]


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tarmac", description="On-time-performance reports")
    reports = parser.add_subparsers(dest="report", required=True)

    def command(name: str, help: str, *inputs: str) -> argparse.ArgumentParser:
        sub = reports.add_parser(name, help=help)
        for relation in inputs:
            sub.add_argument(f"--{relation}", required=True, help="path of the files")
        sub.add_argument("--parquet", nargs="+", choices=inputs, default=[], help="inputs that are parquet, not CSV")
        sub.add_argument("--quoted", action="store_true", help="CSV fields may be quoted")
        sub.add_argument("--no-header", action="store_true", help="CSV files have no header line")
        sub.add_argument("--several-files", action="store_true", help="write as many files as there are tasks")
        sub.add_argument("--limit", type=int, help="broadcast dimensions up to so many bytes; 0 adds up flights before joining")
        sub.add_argument("--output", required=True)
        return sub

    models = command("top-models", "models of a manufacturer with the most flights", "flights", "aircrafts")
    models.add_argument("--manufacturer", default=CESSNA)
    models.add_argument("--label", default=CESSNA_LABEL)
    models.add_argument("--n", type=int, default=3)

    delay = command("departure-delay", "delays per airline in a year", "flights", "aircrafts", "airlines")
    delay.add_argument("--year", required=True)
    delay.add_argument("--country", default=UNITED_STATES)
    delay.add_argument("--known-aircraft", choices=["inner", "left_semi"], default="inner")
    delay.add_argument("--minutes", choices=["of_hour", "total"], default="of_hour")

    types = command("popular-types", "aircraft types each airline uses most", "flights", "aircrafts", "airlines")
    types.add_argument("--country", help="airlines of this country; all if not given")
    types.add_argument("--n", type=int, default=5)
    types.add_argument("--measure", choices=["flights", "distinct_tails"], default="flights")

    ingest = command("ingest-flights", "write flights as parquet in one folder per year", "flights")
    ingest.add_argument("--replace", choices=["table", "years"], default="table", help="what the flights replace")
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    args = _arguments(argv)

    def read(relation: Relation, columns: list[str] | None = None) -> DataFrame:
        path = getattr(args, relation.name)
        if relation.name in args.parquet:
            return read_parquet(spark, path, relation, columns)
        return read_relation(spark, path, relation, columns, args.quoted, not args.no_header)

    if args.report == "ingest-flights":
        write_flights_by_year(read(FLIGHTS), args.output, args.replace)
        return
    if args.report == "top-models":
        result = top_models(read(FLIGHTS, TAIL), read(AIRCRAFTS), args.manufacturer, args.label, args.n, args.limit)
    elif args.report == "departure-delay":
        result = departure_delay(
            read(FLIGHTS), read(AIRCRAFTS, TAIL), read(AIRLINES), args.year, args.country, args.minutes,
            args.known_aircraft, args.limit,
        )
    else:
        result = popular_types(
            read(FLIGHTS, CARRIER_AND_TAIL), read(AIRCRAFTS), read(AIRLINES), args.country, args.n, args.measure, args.limit
        )
    order = [F.desc("flights"), F.asc("model")] if args.report == "top-models" else ["airline"]
    write_tuple_text(result, args.output, not args.several_files, order)


if __name__ == "__main__":
    session = SparkSession.builder.appName("tarmac").getOrCreate()
    try:
        run(session)
    finally:
        session.stop()
