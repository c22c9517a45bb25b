"""Row filters. Each keeps all columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import delay_minutes

# The choices the reports make when not told otherwise.
CESSNA = "CESSNA"
UNITED_STATES = "United States"
YEAR_LENGTH = 4


def by_manufacturer(aircrafts: DataFrame, manufacturer: str = CESSNA) -> DataFrame:
    """Exact, case-sensitive match."""
    return aircrafts.where(F.col("manufacturer") == manufacturer)


def by_country(airlines: DataFrame, country: str = UNITED_STATES) -> DataFrame:
    """Country *contains* the text, so ``United States Minor Outlying Islands`` matches too."""
    return airlines.where(F.contains("country", F.lit(country)))


def by_year(flights: DataFrame, year: str) -> DataFrame:
    """The first four characters of the flight date equal ``year``; shorter dates do not match.

    Written as a prefix test, which parquet scans take as a pushed filter, where
    ``substring`` would not be. On a table partitioned by ``flight_year`` only that
    year's folder is read.
    """
    if len(year) != YEAR_LENGTH:
        return flights.where(F.lit(False))
    if "flight_year" in flights.columns:
        flights = flights.where(F.col("flight_year") == year)
    return flights.where(F.col("flight_date").startswith(year))


def delayed(flights: DataFrame, minutes: str = "of_hour") -> DataFrame:
    """Flights that left late, with their ``delay`` (see :func:`tarmac.functions.delay_minutes`).

    A list of one delay or none in place of a filter, which would be pushed down and read the times again.
    """
    delay = delay_minutes(F.col("scheduled_departure"), F.col("actual_departure"), minutes)
    return flights.withColumn("delay", F.explode(F.array_compact(F.array(delay))))
