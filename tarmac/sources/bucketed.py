"""Flights and dimensions stored in buckets of a join key, so that joins need no shuffle.

A bucket is a file that holds the rows of some keys. Flights of a key that fills more than a bucket are dealt out to several
buckets when they are written, by the key and the number of a piece, and the dimension rows of such a key are
stored once for each piece. Which keys these are is stored beside the files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tarmac.operators.joins import dealt, hot_cells
from tarmac.sinks import replaced

BUCKETS = 200
PIECE = "bucket_piece"


@dataclass(frozen=True)
class Bucketed:
    """Stored rows, with the column ``bucket_piece`` if there are keys in several pieces, and how they are stored."""

    rows: DataFrame
    key: str
    buckets: int
    hot: tuple[tuple[str, int], ...]  # keys in several pieces, fewer than there are buckets

    @property
    def by(self) -> list[str]:
        return [self.key, PIECE] if self.hot else [self.key]

    def pieces(self) -> DataFrame:
        fields = [self.rows.schema[self.key], StructField("pieces", IntegerType())]
        return F.broadcast(self.rows.sparkSession.createDataFrame(list(self.hot), StructType(fields)))

    def matching(self, dimension: DataFrame) -> DataFrame:
        """Dimension rows with the piece, once for each piece of their key."""
        if not self.hot:
            return dimension
        last = F.coalesce("pieces", F.lit(1)) - 1
        return dimension.join(self.pieces(), self.key, "left").withColumn(PIECE, F.explode(F.sequence(F.lit(0), last))).drop("pieces")


def write_flights_in_buckets(flights: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Store flights in buckets of ``key``, replacing what is there."""
    hot = tuple((value, pieces) for value, pieces, _ in hot_cells(flights, None, key, buckets) if value is not None)
    placed = flights
    if hot:
        fields = StructType([flights.schema[key], StructField("pieces", IntegerType())])
        cut = flights.select(key, F.struct(*flights.columns).alias("row"))
        cut = cut.join(F.broadcast(flights.sparkSession.createDataFrame(list(hot), fields)), key, "left")
        cut = dealt(cut.withColumn("pieces", F.coalesce("pieces", F.lit(1))), [key, "pieces"], "row", "pieces", "copies", PIECE)
        placed = cut.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*", PIECE)
    _write(placed, path, key, buckets, hot)


def write_dimension_in_buckets(dimension: DataFrame, path: str, flights: Bucketed) -> None:
    """Store a dimension in the buckets of flights stored by the same key, replacing what is there."""
    _write(flights.matching(dimension), path, flights.key, flights.buckets, flights.hot)


def _write(rows: DataFrame, path: str, key: str, buckets: int, hot: tuple[tuple[str, int], ...]) -> None:
    spark = rows.sparkSession
    by = [key, PIECE] if hot else [key]
    how = json.dumps({"key": key, "buckets": buckets, "hot": hot, "schema": rows.schema.json()})

    def write(folder: str) -> None:
        name = f"tarmac_{uuid.uuid4().hex}"
        # One file for each bucket: the shuffle deals out as the buckets do.
        dealt_out = rows.repartition(buckets, *by)
        try:
            dealt_out.write.option("path", folder).bucketBy(buckets, *by).sortBy(key).saveAsTable(name)
        finally:
            spark.sql(f"drop table if exists {name}")
        spark.createDataFrame([(how,)], "value string").write.text(f"{folder}/_buckets")

    replaced(spark, path, write)


def read_in_buckets(spark: SparkSession, path: str) -> Bucketed:
    """Stored rows, as a table of the session that knows its buckets."""
    how = json.loads(spark.read.text(f"{path}/_buckets").first()[0])
    schema = StructType.fromJson(json.loads(how["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{c}`" for c in ([how["key"], PIECE] if how["hot"] else [how["key"]]))
    name = f"tarmac_{uuid.uuid4().hex}"
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by ({by}) sorted by (`{how['key']}`) "
        f"into {how['buckets']} buckets location '{path}'"
    )
    return Bucketed(spark.table(name), how["key"], how["buckets"], tuple((k, n) for k, n in how["hot"]))


def join_in_buckets(flights: Bucketed, dimension: Bucketed | DataFrame, how: str = "inner") -> DataFrame:
    """Flights with their dimension rows, bucket by bucket: the flights are not shuffled, nor is a dimension in the same buckets.

    Any other dimension is shuffled to the flights' buckets. A column of the same name as one of the flights replaces it.
    """
    key = flights.key
    if not isinstance(dimension, Bucketed):
        others = flights.matching(dimension)
    elif (dimension.key, dimension.buckets, dimension.hot) == (key, flights.buckets, flights.hot):
        others = dimension.rows
    else:
        once = dimension.rows.where(F.col(PIECE) == 0).drop(PIECE) if dimension.hot else dimension.rows
        others = flights.matching(once)
    facts = flights.rows
    if how == "inner":
        facts = facts.drop(*[c for c in others.columns if c not in flights.by])
    joined = facts.join(others.hint("merge"), flights.by, how).drop(PIECE)
    first = [c for c in facts.columns if c != PIECE]
    return joined.select(*first, *[c for c in joined.columns if c not in first])
