"""The three reports. They only put operators together; nothing here runs by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import aircraft_type, model_label
from tarmac.functions.texts import CESSNA_LABEL
from tarmac.operators import ranking
from tarmac.operators.filters import CESSNA, UNITED_STATES, by_country, by_manufacturer, by_year
from tarmac.operators.rollups import (
    Dimension,
    delay_statistics,
    distinct_count_in_parts,
    flight_count,
    rollup,
    rollup_in_parts,
)


def flights_per_model(
    flights: DataFrame,
    aircrafts: DataFrame,
    manufacturer: str = CESSNA,
    label: str = CESSNA_LABEL,
    limit: int | None = None,
) -> DataFrame:
    """Number of flights per model label of one manufacturer: ``model, flights``.

    Labels are made once per aircraft, before the join, not once per flight.
    """
    fleet = by_manufacturer(aircrafts, manufacturer)
    models = fleet.select("tail_number", model_label(F.col("model"), label).alias("model"))
    return rollup(flights.select("tail_number"), [Dimension(models, "tail_number")], ["model"], flight_count(), limit)


def top_models(
    flights: DataFrame,
    aircrafts: DataFrame,
    manufacturer: str = CESSNA,
    label: str = CESSNA_LABEL,
    n: int = 3,
    limit: int | None = None,
) -> DataFrame:
    """The ``n`` models of one manufacturer with the most flights: ``model, flights``."""
    counts = flights_per_model(flights, aircrafts, manufacturer, label, limit)
    return ranking.top_n(counts, "flights", ["model"], n)


def delay_totals(
    flights: DataFrame, airlines: DataFrame, minutes: str = "of_hour", limit: int | None = None
) -> DataFrame:
    """Delays of all flights per airline: ``airline, delayed_flights, total_delay, avg_delay, min_delay, max_delay``.

    Columns that are not asked for are not added up.
    """
    facts = flights.select("carrier_code", "scheduled_departure", "actual_departure")
    carriers = airlines.select("carrier_code", F.col("name").alias("airline"))
    totals = rollup(facts, [Dimension(carriers, "carrier_code")], ["airline"], delay_statistics(minutes), limit)
    return with_average(totals)


def with_average(totals: DataFrame) -> DataFrame:
    """Airlines with a delay, and the ``avg_delay`` in whole minutes."""
    return totals.where(F.col("delayed_flights") > 0).withColumn("avg_delay", average_delay())


def average_delay() -> Column:
    return F.call_function("div", F.col("total_delay"), F.col("delayed_flights"))


def departure_delay(
    flights: DataFrame,
    aircrafts: DataFrame,
    airlines: DataFrame,
    year: str,
    country: str = UNITED_STATES,
    minutes: str = "of_hour",
    known_aircraft: str = "inner",
    limit: int | None = None,
    cancelled: bool = False,
) -> DataFrame:
    """Delays of one year per airline of one country, by airline name:
    ``airline, delayed_flights, avg_delay, min_delay, max_delay``.

    ``cancelled`` adds ``cancelled_flights``, the flights of which a time cannot be read, counted in the same pass
    over the flights; airlines with such flights and no delay are listed then, without delays.

    Carriers of the same name share a row; airlines without a delay have none. The average
    is cut to whole minutes. Only flights of listed aircraft count, once per listing, or
    once only with ``known_aircraft="left_semi"``.
    """
    facts = by_year(flights, year).select("carrier_code", "tail_number", "scheduled_departure", "actual_departure")
    carriers = by_country(airlines, country).select("carrier_code", F.col("name").alias("airline"))
    tails = aircrafts.select("tail_number")
    if known_aircraft == "left_semi":
        tails = tails.distinct()
    elif known_aircraft != "inner":
        raise ValueError(f"known_aircraft must be 'inner' or 'left_semi', not {known_aircraft!r}")
    dimensions = [Dimension(carriers, "carrier_code"), Dimension(tails, "tail_number")]
    totals = rollup(facts, dimensions, ["airline"], delay_statistics(minutes, cancelled), limit)
    columns = ["airline", "delayed_flights", "avg_delay", "min_delay", "max_delay"]
    if cancelled:
        number = F.coalesce("cancelled_flights", F.lit(0)).alias("cancelled_flights")
        listed = totals.where("delayed_flights > 0 or cancelled_flights > 0").withColumn("avg_delay", average_delay())
        return listed.select(columns[0], F.coalesce(columns[1], F.lit(0)).alias(columns[1]), *columns[2:], number).orderBy("airline")
    return with_average(totals).select(*columns).orderBy("airline")


def type_counts(
    flights: DataFrame,
    aircrafts: DataFrame,
    airlines: DataFrame,
    country: str | None = None,
    measure: str = "flights",
    limit: int | None = None,
) -> DataFrame:
    """How much each airline uses each aircraft type: ``airline, aircraft_type, n``.

    ``n`` counts flights, or different aircraft with ``measure="distinct_tails"``.
    """
    return _type_counts(flights, aircrafts, airlines, country, measure, limit)[0]


def _type_counts(
    flights: DataFrame,
    aircrafts: DataFrame,
    airlines: DataFrame,
    country: str | None,
    measure: str,
    limit: int | None,
    cut: str | None = None,
) -> tuple[DataFrame, int | None]:
    """The same with the number of parts that they lie in (:func:`~tarmac.operators.rollups.rollup_in_parts`)."""
    if country is not None:
        airlines = by_country(airlines, country)
    carriers = airlines.select("carrier_code", F.col("name").alias("airline"))
    described = aircraft_type(F.col("manufacturer"), F.col("model")).alias("aircraft_type")
    dimensions = [
        Dimension(carriers, "carrier_code"),
        Dimension(aircrafts.select("tail_number", described), "tail_number"),
    ]
    group_by = ["airline", "aircraft_type"]
    facts = flights.select("carrier_code", "tail_number")
    if measure == "flights":
        counts, parts = rollup_in_parts(facts, dimensions, group_by, flight_count(), limit, cut)
        return counts.withColumnRenamed("flights", "n"), parts
    if measure == "distinct_tails":
        return distinct_count_in_parts(facts, dimensions, group_by, "tail_number", limit, cut)
    raise ValueError(f"measure must be 'flights' or 'distinct_tails', not {measure!r}")


def top_types(
    flights: DataFrame,
    aircrafts: DataFrame,
    airlines: DataFrame,
    country: str | None = None,
    n: int = 5,
    measure: str = "flights",
    limit: int | None = None,
) -> DataFrame:
    """The ``n`` aircraft types each airline uses most: ``airline, aircraft_type, n, rank``."""
    counts, parts = _type_counts(flights, aircrafts, airlines, country, measure, limit, cut="aircraft_type")
    return ranking.top_n_per_group(counts, "airline", "n", "aircraft_type", n, parts)


def popular_types(
    flights: DataFrame,
    aircrafts: DataFrame,
    airlines: DataFrame,
    country: str | None = None,
    n: int = 5,
    measure: str = "flights",
    limit: int | None = None,
) -> DataFrame:
    """The same as one text per airline, by airline name: ``airline, aircraft_types``.

    ``country=None`` covers all airlines.
    """
    ranked = top_types(flights, aircrafts, airlines, country, n, measure, limit)
    return ranking.ordered_list(ranked, "airline", "aircraft_type", "aircraft_types").orderBy("airline")
