"""Joins of the flights with their dimensions, for dimensions of any size.

A dimension is broadcast only after its size has been measured and found to be within a
limit, by default the session's ``spark.sql.autoBroadcastJoinThreshold``, or if Spark's estimate is an eighth of it
or less. Spark's estimates miss what a filter removes and multiply up over joins; the
measured size keeps the flights from being shuffled whenever that is safe. Beyond the
limit the flights are shuffled: row by row with hot keys spread (:func:`with_dimension`),
or, where only totals are wanted, after adding them up (:mod:`tarmac.operators.rollups`).
"""

from __future__ import annotations

import re
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tarmac.functions import aircraft_type

# Memory of a broadcast row beyond its text: row header, and a word per column.
ROW_BYTES = 32
COLUMN_BYTES = 16
# Pieces of a hot key for each partition it fills: more than one, so that pieces that meet in a partition are small.
PIECES = 4
# Cells of a hot key's grid for each partition that its joined rows fill.
CELLS = 16
# How far below the limit an estimate has to be, as files are smaller than the rows they hold.
ESTIMATE_MARGIN = 8
UNIT_SHIFT = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's automatic broadcast limit in bytes, negative if broadcasting is off."""
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)i?b?", setting).groups()
    return int(number) << UNIT_SHIFT[unit]


def estimated_small(dimension: DataFrame) -> bool:
    """Whether Spark's own estimate, made of file sizes, is far below its broadcast limit.

    Joining such a dimension needs neither measuring nor a hint: Spark broadcasts it by that estimate.
    """
    bytes_estimated = int(str(dimension._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return bytes_estimated * ESTIMATE_MARGIN <= broadcast_limit(dimension.sparkSession)


def fit_broadcast(dimensions: list[DataFrame], limit: int | None = None) -> list[bool]:
    """Measure text dimensions in one job and tell which are within the limit.

    Each is added up where it lies; one number per dimension reaches the driver. Without a ``limit`` of the
    caller's, those that are :func:`estimated_small` are not measured; if all are, there is no job.
    """
    spark = dimensions[0].sparkSession
    fits = [limit is None and estimated_small(d) for d in dimensions]
    limit = broadcast_limit(spark) if limit is None else limit
    unknown = [i for i, fit in enumerate(fits) if not fit]
    if limit <= 0 or not unknown:
        return fits
    sizes = reduce(DataFrame.unionAll, [_measured(dimensions[i], i) for i in unknown])
    for row in sizes.collect():
        fits[row["i"]] = row["bytes"] <= limit
    return fits


def _measured(dimension: DataFrame, i: int) -> DataFrame:
    lengths = [f"coalesce(octet_length(`{c}`), 0) + {COLUMN_BYTES}" for c in dimension.columns]
    row_bytes = f"cast({ROW_BYTES} + {' + '.join(lengths)} as bigint)"
    return dimension.selectExpr(f"{i} as i", f"coalesce(sum({row_bytes}), 0) as bytes")


def with_aircraft(
    flights: DataFrame, aircrafts: DataFrame, how: str = "inner", limit: int | None = None
) -> DataFrame:
    """Flights with the manufacturer, model and ``aircraft_type`` of their tail number.

    Inner by default: a tail number listed twice doubles its flights. ``how="left_semi"``
    only asks whether the aircraft is known and adds no columns.
    """
    known = aircraft_columns(aircrafts) if how == "inner" else aircrafts.select("tail_number")
    return with_dimension(flights, known, "tail_number", how, limit)


def aircraft_columns(aircrafts: DataFrame) -> DataFrame:
    """What flights get of their aircraft."""
    described = aircraft_type(F.col("manufacturer"), F.col("model")).alias("aircraft_type")
    return aircrafts.select("tail_number", "manufacturer", "model", described)


def airline_columns(airlines: DataFrame) -> DataFrame:
    """What flights get of their airline."""
    return airlines.select("carrier_code", F.col("name").alias("airline"), "country")


def with_airline(flights: DataFrame, airlines: DataFrame, limit: int | None = None) -> DataFrame:
    """Flights with the name (``airline``) and country of their carrier."""
    return with_dimension(flights, airline_columns(airlines), "carrier_code", limit=limit)


def with_dimension(
    flights: DataFrame, dimension: DataFrame, key: str, how: str = "inner", limit: int | None = None
) -> DataFrame:
    """Join row by row: broadcast if the dimension is measured to fit, else with hot keys spread.

    The columns of the flights come first, as they were. Where the dimension has a column of the
    same name, other than the key, its values replace those of the flights.
    """
    if how == "inner":
        flights = flights.drop(*[c for c in dimension.columns if c != key])
    if fit_broadcast([dimension], limit)[0]:
        joined = flights.join(F.broadcast(dimension), key, how)
    else:
        joined = spread_join(flights, dimension, key, how)
    return joined.select(*flights.columns, *[c for c in joined.columns if c not in flights.columns])


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions that a shuffle has before adaptive execution puts small ones together."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        return int(usual)
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or usual)


def shuffle_tasks(spark: SparkSession) -> int:
    """The number of tasks that a shuffle may be left with after adaptive execution has put partitions together."""
    return min(shuffle_partitions(spark), spark.sparkContext.defaultParallelism)


def hot_keys(rows: DataFrame, key: str, partitions: int | None = None) -> list[tuple[object, int]]:
    """Keys with more rows than an average partition, of a shuffle if not told, and the number of pieces to cut each into.

    One reading of the rows gives counts and total. There are fewer hot keys than partitions,
    whatever the data, and that many rows at most reach the driver.
    """
    return [(value, pieces) for value, pieces, _ in hot_cells(rows, None, key, partitions)]


def hot_cells(
    rows: DataFrame, dimension: DataFrame | None, key: str, partitions: int | None = None
) -> list[tuple[object, int, int]]:
    """Keys with more rows, or more rows after the join, than an average partition; and the grid to cut each into:
    the number of pieces of its rows and of slices of its dimension rows.

    Both sides are counted in one reading. Each of the two kinds of hot keys has fewer members than there are partitions.
    """
    partitions = partitions or shuffle_partitions(rows.sparkSession)
    value, one, none = F.col(key).alias("value"), F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = rows.select(value, one.alias("n"), none.alias("listed"))
    if dimension is not None:
        sides = sides.unionAll(dimension.select(value, none.alias("n"), one.alias("listed")))
    counts = sides.groupBy("value").agg(F.sum("n").alias("n"), F.sum("listed").alias("listed")).where("n > 0")
    # Doubles: products of two counts may pass 64 bits.
    counts = counts.withColumn("joined", F.col("n") * F.col("listed").cast("double"))
    totals = Observation()
    counts = counts.observe(totals, F.sum("n").alias("n"), F.sum("joined").alias("joined"))
    most = counts.orderBy(F.desc("n"), "value").limit(partitions)
    if dimension is not None:
        most = most.unionAll(counts.orderBy(F.desc("joined"), "value").limit(partitions))
    found = {row["value"]: row for row in most.collect()}
    share = (totals.get["n"] or 0) / partitions if found else 0
    joined_share = (totals.get["joined"] or 0) / partitions if found else 0
    grids = []
    for row in found.values():
        pieces = ceil(PIECES * row["n"] / share) if row["n"] > share else 1
        cells = ceil(CELLS * row["joined"] / joined_share) if row["joined"] > joined_share > 0 else 1
        slices = min(max(1, row["listed"]), ceil(cells / pieces)) if cells > pieces else 1
        pieces = max(pieces, min(row["n"], ceil(cells / slices))) if slices > 1 else pieces
        if pieces > 1 or slices > 1:
            grids.append((row["value"], pieces, slices))
    return grids


def dealt(rows: DataFrame, keys: list[str], row: str, parts: str, copies: str, part: str) -> DataFrame:
    """Each different ``row`` with its number of ``copies``, which is shared out among the ``parts`` of its key.

    A row with fewer copies than parts goes whole to one of them.
    """
    rows = rows.groupBy(*keys, row).agg(F.count("*").alias(copies))
    n, number = F.col(parts), F.col(copies)
    few = number < n
    home = F.pmod(F.xxhash64(row), n).cast("int")
    rows = rows.withColumn(part, F.explode(F.when(few, F.array(home)).otherwise(F.sequence(F.lit(0), n - 1))))
    share = F.floor(number / n) + F.when(F.col(part) < number % n, 1).otherwise(0)
    return rows.withColumn(copies, F.when(few, number).otherwise(share))


def spread_join(flights: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Shuffle join (inner or semi) in which a key that holds a large share of the flights, or of what comes out of
    the join, is cut into a grid: its flights into pieces and its dimension rows into slices. Each piece meets each slice in a task.

    Flights of a hot key are repeated for its slices and dimension rows for its pieces; all other rows go once.
    A key with a single dimension row has one slice, so its flights are not repeated.
    Equal rows of either side travel as one with the number of copies, and that number is shared out among the pieces. So
    equal rows are spread like others, and a task that is run again cuts the same way, which it
    would not if pieces followed from the place of a row in its task. Without hot keys this is a plain join.

    Rows are packed, and the names of helper columns hold the key's, so none can clash with a column.
    """
    flights = flights.where(F.col(key).isNotNull())
    spark = flights.sparkSession
    if how != "inner":
        dimension = dimension.select(key).distinct()
    found = hot_cells(flights, dimension, key)
    if not found:
        return flights.join(dimension, key, how)
    pieces, slices, piece, part, row, listing, copies, listed = (
        f"{key} {name}" for name in ("pieces", "slices", "piece", "slice", "row", "listing", "copies", "listed")
    )
    fields = [flights.schema[key], StructField(pieces, IntegerType()), StructField(slices, IntegerType())]
    hot = F.broadcast(spark.createDataFrame(found, StructType(fields)))
    grid = {pieces: F.coalesce(pieces, F.lit(1)), slices: F.coalesce(slices, F.lit(1))}
    keys = [key, pieces, slices]

    cut = flights.select(key, F.struct(*flights.columns).alias(row)).join(hot, key, "left").withColumns(grid)
    cut = dealt(cut, keys, row, pieces, copies, piece)
    cut = cut.withColumn(part, F.explode(F.sequence(F.lit(0), F.col(slices) - 1))).drop(pieces, slices)

    others = [c for c in dimension.columns if c != key]
    repeated = dimension.select(key, F.struct(F.lit(0).alias(key), *others).alias(listing)).join(hot, key, "left").withColumns(grid)
    repeated = dealt(repeated, keys, listing, slices, listed, part)
    repeated = repeated.withColumn(piece, F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))).drop(pieces, slices)

    joined = cut.join(repeated, [key, piece, part], how)
    times = F.col(copies) * F.col(listed) if how == "inner" else F.col(copies)
    joined = joined.withColumn(copies, F.explode(F.sequence(F.lit(1), times)))
    return joined.select(f"`{row}`.*", *[F.col(f"`{listing}`.`{c}`") for c in others if how == "inner"])
