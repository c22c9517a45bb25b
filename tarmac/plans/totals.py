"""Delay totals that are kept, and grow by the flights of each delivery.

A stored state holds, per year, carrier and tail number, what the delay report adds up: counts, sums, least and largest
delays, by both ways to count minutes, and cancelled flights. States merge by adding them up, so new flights are
read once, when they come, and a report reads states only. Aircrafts and airlines are joined when the report is made, so they may change
meanwhile.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import delay_minutes, seconds_of_day
from tarmac.operators.filters import UNITED_STATES, YEAR_LENGTH, by_country
from tarmac.operators.rollups import Dimension, Measure, rollup
from tarmac.plans.reports import with_average
from tarmac.sinks import replaced
from tarmac.sources.scratch import file_system

KEYS = ["flight_year", "carrier_code", "tail_number"]
MODES = ("of_hour", "total")
SUMS = [f"{mode}_{name}" for mode in MODES for name in ("flights", "sum")] + ["cancelled_flights"]
MINS = [f"{mode}_min" for mode in MODES]
MAXS = [f"{mode}_max" for mode in MODES]


def _combined(states: DataFrame) -> DataFrame:
    totals = [F.sum(c).alias(c) for c in SUMS] + [F.min(c).alias(c) for c in MINS] + [F.max(c).alias(c) for c in MAXS]
    return states.groupBy(*KEYS).agg(*totals)


def delay_states(flights: DataFrame) -> DataFrame:
    """The states of flights. Flights that are neither late nor cancelled, and such of no year, leave none."""
    scheduled, actual = F.col("scheduled_departure"), F.col("actual_departure")
    columns = {"flight_year": F.substring("flight_date", 1, YEAR_LENGTH)}
    for mode in MODES:
        delay = delay_minutes(scheduled, actual, mode)
        columns |= {f"{mode}_flights": F.when(delay.isNotNull(), 1).cast("bigint"), f"{mode}_sum": delay}
        columns |= {f"{mode}_min": delay, f"{mode}_max": delay}
    unreadable = seconds_of_day(scheduled).isNull() | seconds_of_day(actual).isNull()
    columns["cancelled_flights"] = F.when(unreadable, 1).cast("bigint")
    states = _combined(flights.where(F.length("flight_date") >= YEAR_LENGTH).select("carrier_code", "tail_number", *[c.alias(n) for n, c in columns.items()]))
    return states.where(F.coalesce("of_hour_flights", "total_flights", "cancelled_flights").isNotNull())


def add_flights(flights: DataFrame, path: str, delivery: str) -> None:
    """Add the states of a delivery of flights. A delivery that is added again replaces itself."""
    states = delay_states(flights)
    replaced(flights.sparkSession, f"{path}/delivery={delivery}", lambda folder: states.write.partitionBy("flight_year").parquet(folder))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """All states, of a key one for each delivery."""
    kinds = ", ".join(f"{c} bigint" for c in [*SUMS, *MINS, *MAXS])
    return spark.read.schema(f"carrier_code string, tail_number string, {kinds}, delivery string, flight_year string").parquet(path)


def merge_deliveries(spark: SparkSession, path: str) -> None:
    """Put the states of all deliveries together, so that a key has one again. They are one delivery from then on."""
    states = _combined(read_states(spark, path))
    merged = f"merged-{uuid.uuid4().hex}"
    replaced(spark, path, lambda folder: states.write.partitionBy("flight_year").parquet(f"{folder}/delivery={merged}"))


def deliveries(spark: SparkSession, path: str) -> list[str]:
    """Names of the deliveries that are stored."""
    files, where = file_system(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(n.removeprefix("delivery=") for n in names if n.startswith("delivery="))


def departure_delay_of_states(
    states: DataFrame,
    aircrafts: DataFrame,
    airlines: DataFrame,
    year: str,
    country: str = UNITED_STATES,
    minutes: str = "of_hour",
    known_aircraft: str = "inner",
    limit: int | None = None,
) -> DataFrame:
    """The report of :func:`tarmac.plans.reports.departure_delay`, from states, with ``cancelled_flights``.

    Airlines whose flights were cancelled but never late are not listed, as in that report.
    """
    if minutes not in MODES:
        raise ValueError(f"minutes must be 'of_hour' or 'total', not {minutes!r}")

    def derive(rows: DataFrame) -> DataFrame:
        factor = {c: F.col(c) * F.col("weight") for c in (f"{minutes}_flights", f"{minutes}_sum", "cancelled_flights")}
        return rows.withColumns(factor)

    sums = (f"{minutes}_flights", f"{minutes}_sum", "cancelled_flights")
    measure = Measure(derive, sums, (f"{minutes}_min",), (f"{minutes}_max",))
    facts = states.where(F.col("flight_year") == year).select("carrier_code", "tail_number", *sums, *measure.mins, *measure.maxs)
    carriers = by_country(airlines, country).select("carrier_code", F.col("name").alias("airline"))
    tails = aircrafts.select("tail_number")
    if known_aircraft == "left_semi":
        tails = tails.distinct()
    elif known_aircraft != "inner":
        raise ValueError(f"known_aircraft must be 'inner' or 'left_semi', not {known_aircraft!r}")
    totals = rollup(facts, [Dimension(carriers, "carrier_code"), Dimension(tails, "tail_number")], ["airline"], measure, limit)
    named = totals.withColumnsRenamed(
        {sums[0]: "delayed_flights", sums[1]: "total_delay", f"{minutes}_min": "min_delay", f"{minutes}_max": "max_delay"}
    )
    columns = ["airline", "delayed_flights", "avg_delay", "min_delay", "max_delay"]
    return with_average(named).select(*columns, F.coalesce("cancelled_flights", F.lit(0)).alias("cancelled_flights")).orderBy("airline")
