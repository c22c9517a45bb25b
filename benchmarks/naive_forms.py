"""The reports as a Spark user would write them at once: filters, joins left to Spark, one
aggregate. Same results as the reports in ``tarmac``; kept to compare results and times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import aircraft_type, model_label
from tarmac.operators.filters import by_country, by_manufacturer, by_year, delayed


def top_models(flights: DataFrame, aircrafts: DataFrame, manufacturer: str) -> DataFrame:
    joined = flights.join(by_manufacturer(aircrafts, manufacturer), "tail_number")
    counts = joined.groupBy(model_label(F.col("model")).alias("model")).agg(F.count("*").alias("flights"))
    return counts.orderBy(F.desc("flights"), "model").limit(3)


def departure_delay(
    flights: DataFrame, aircrafts: DataFrame, airlines: DataFrame, year: str, country: str
) -> DataFrame:
    joined = by_year(flights, year).join(aircrafts, "tail_number").join(by_country(airlines, country), "carrier_code")
    totals = delayed(joined).groupBy(F.col("name").alias("airline")).agg(
        F.count("*").alias("delayed_flights"),
        F.call_function("div", F.sum("delay"), F.count("*")).alias("avg_delay"),
        F.min("delay").alias("min_delay"),
        F.max("delay").alias("max_delay"),
    )
    return totals.orderBy("airline")


def popular_types(flights: DataFrame, aircrafts: DataFrame, airlines: DataFrame, country: str | None = None) -> DataFrame:
    if country is not None:
        airlines = by_country(airlines, country)
    joined = flights.join(aircrafts, "tail_number").join(airlines, "carrier_code")
    used = joined.select(F.col("name").alias("airline"), aircraft_type(F.col("manufacturer"), F.col("model")).alias("t"))
    counts = used.groupBy("airline", "t").agg(F.count("*").alias("n"))
    best_first = Window.partitionBy("airline").orderBy(F.desc("n"), "t")
    top = counts.withColumn("rank", F.row_number().over(best_first)).where("rank <= 5")
    listed = top.groupBy("airline").agg(F.sort_array(F.collect_list(F.struct("rank", "t"))).alias("l"))
    text = F.concat(F.lit("["), F.concat_ws(", ", "l.t"), F.lit("]")).alias("aircraft_types")
    return listed.select("airline", text).orderBy("airline")
