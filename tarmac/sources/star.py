"""Flights, aircrafts and airlines derived from a star schema of orders and parts.

Line items play the flights, parts the aircrafts and suppliers the airlines. The
derivation is fixed, so results can be checked against SQL on the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How line numbers and quantities become times of day.
TIME_OF_DAY = "l_orderkey * 61 + l_linenumber * 7919"
DELAY_SECONDS = "(cast(l_quantity as bigint) - 10) * 180"
CANCELLED = "l_returnflag = 'R' and l_linenumber = 1"

# The columns used. Naming them saves a look into each file when planning.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


@dataclass(frozen=True)
class Star:
    flights: DataFrame
    aircrafts: DataFrame
    airlines: DataFrame


def _clock(seconds: str) -> str:
    """``HH:mm:ss`` text of a number of seconds under a day, in any session time zone."""
    moment = f"timestampadd(second, {seconds}, timestamp_ntz'1970-01-01 00:00:00')"
    return f"substring(cast({moment} as string), 12, 8)"


def read_star(spark: SparkSession, folder: str, year: str | None = None) -> Star:
    """The three relations from ``lineitem``, ``part``, ``supplier`` and ``nation`` in a folder.

    Flights of one year only, if that is given: a range of dates, which is tested where the parquet files are read,
    as a test of the text made of a date cannot be.
    """

    def table(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    items = table("lineitem")
    if year is not None:
        first, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, f"{int(year) + 1:04d}"))
        items = items.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < end))
    flights = items.select(
        F.expr("concat('S', cast(l_suppkey as string))").alias("carrier_code"),
        F.col("l_shipdate").cast("date").cast("string").alias("flight_date"),
        F.expr("concat('N', cast(l_partkey as string))").alias("tail_number"),
        F.expr(_clock(f"({TIME_OF_DAY}) % 86400")).alias("scheduled_departure"),
        F.expr(
            f"case when {CANCELLED} then '' "
            f"else {_clock(f'({TIME_OF_DAY} + {DELAY_SECONDS} + 86400) % 86400')} end"
        ).alias("actual_departure"),
    )
    aircrafts = table("part").select(
        F.expr("concat('N', cast(p_partkey as string))").alias("tail_number"),
        F.col("p_type").alias("manufacturer"),
        F.expr(
            "concat(upper(substr(p_name, 1, 1)), cast(100 + 10 * (p_size % 10) as string), "
            "'-', cast(p_size % 2 as string))"
        ).alias("model"),
    )
    airlines = (
        table("supplier")
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.expr("concat('S', cast(s_suppkey as string))").alias("carrier_code"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("country"),
        )
    )
    return Star(flights, aircrafts, airlines)
