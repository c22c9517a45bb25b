from pyspark.sql import DataFrame, SparkSession

from tarmac.model import AIRCRAFTS, AIRLINES, FLIGHTS


def flights(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, FLIGHTS.schema())


def aircrafts(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, AIRCRAFTS.schema())


def airlines(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, AIRLINES.schema())


def tuples(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def physical(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
