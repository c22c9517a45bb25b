"""Totals of flights per dimension attribute, in one pass over the flights."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil, prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import delay_minutes, seconds_of_day
from tarmac.operators.joins import fit_broadcast, hot_keys, shuffle_tasks
from tarmac.operators.ranking import in_pieces, piece_of

# Groups that a task may hold. If there are more, rows are dealt out over as many tasks as have this many rows each.
GROUPS = 250_000
ROWS = 250_000


@dataclass(frozen=True)
class Dimension:
    """``rows`` holds ``key`` and the attributes a rollup needs, and nothing else."""

    rows: DataFrame
    key: str

    def counted(self) -> DataFrame:
        """Each key and attributes once, with the number of ``copies``.

        A key listed many times would repeat all of its flights in the join; with the
        copies as a factor the totals are the same and no flight is repeated.
        """
        return self.rows.groupBy(*self.rows.columns).agg(F.count("*").alias("copies"))


@dataclass(frozen=True)
class Measure:
    """What to add up: ``derive`` makes these columns from joined flights, each of which
    stands for ``weight`` rows of the join."""

    derive: Callable[[DataFrame], DataFrame]
    sums: tuple[str, ...]
    mins: tuple[str, ...] = ()
    maxs: tuple[str, ...] = ()

    def combine(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        totals = [F.sum(c).alias(c) for c in self.sums]
        totals += [F.min(c).alias(c) for c in self.mins] + [F.max(c).alias(c) for c in self.maxs]
        return rows.groupBy(*keys).agg(*totals)


def flight_count() -> Measure:
    """``flights``: the number of flights."""
    return Measure(lambda rows: rows.withColumn("flights", F.col("weight")), sums=("flights",))


def delay_statistics(minutes: str = "of_hour", cancelled: bool = False) -> Measure:
    """``delayed_flights``, ``total_delay``, ``min_delay`` and ``max_delay`` of late flights, and ``cancelled_flights`` if asked for.

    Flights that are not late stay in with null delays, which the aggregates pass over.
    """

    def derive(rows: DataFrame) -> DataFrame:
        delay = delay_minutes(F.col("scheduled_departure"), F.col("actual_departure"), minutes)
        if cancelled:
            unreadable = seconds_of_day(F.col("scheduled_departure")).isNull() | seconds_of_day(F.col("actual_departure")).isNull()
            rows = rows.withColumn("cancelled_flights", F.when(unreadable, F.col("weight")))
        return rows.withColumn("delay", delay).withColumns(
            {
                "delayed_flights": F.when(F.col("delay").isNotNull(), F.col("weight")),
                "total_delay": F.col("delay") * F.col("weight"),
                "min_delay": F.col("delay"),
                "max_delay": F.col("delay"),
            }
        )

    sums = ("delayed_flights", "total_delay", *(["cancelled_flights"] if cancelled else []))
    return Measure(derive, sums, ("min_delay",), ("max_delay",))


def rollup(
    flights: DataFrame,
    dimensions: list[Dimension],
    group_by: list[str],
    measure: Measure,
    limit: int | None = None,
) -> DataFrame:
    """Join flights with the dimensions and total ``measure`` per ``group_by``.

    Dimensions measured to fit are broadcast, so the flights are only scanned. Before a
    dimension that does not fit, the flights are first added up per remaining key, in each
    task and then after a shuffle: a key that holds a third of all flights crosses the
    network as one row per task, and the join sees it as a handful of rows.

    With more different keys than the tasks of a shuffle may hold, adding up in each task saves little. Then the flights
    are dealt out over a number of tasks that grows with them, so what a task holds does not (:func:`_dealt_join`).
    """
    return rollup_in_parts(flights, dimensions, group_by, measure, limit)[0]


def rollup_in_parts(
    flights: DataFrame,
    dimensions: list[Dimension],
    group_by: list[str],
    measure: Measure,
    limit: int | None = None,
    cut: str | None = None,
) -> tuple[DataFrame, int | None]:
    """The same with the number of parts that the groups lie in, none if the tasks of a shuffle can hold them.

    With ``cut``, one of the columns, they lie there by the other columns and the piece of this one, which is a column
    more then: a part holds all of a piece, and a group of the other columns is in as many pieces as there are parts.
    """
    rows, deal = _joined(flights, dimensions, group_by, measure, limit)
    rows, keys, parts = deal(rows, group_by, cut)
    return measure.combine(rows, keys), parts


def distinct_count_in_parts(
    flights: DataFrame,
    dimensions: list[Dimension],
    group_by: list[str],
    key: str,
    limit: int | None = None,
    cut: str | None = None,
) -> tuple[DataFrame, int | None]:
    """The number ``n`` of different values of ``key`` among the joined flights per ``group_by``, with the number of parts
    that the groups lie in (:func:`rollup_in_parts`)."""
    measure, each = flight_count(), [*group_by, key]
    rows, deal = _joined(flights, dimensions, each, measure, limit)
    found = measure.combine(deal(rows, each)[0], each)
    found, keys, parts = deal(found, group_by, cut)
    return found.groupBy(*keys).agg(F.count("*").alias("n")), parts


def _joined(
    flights: DataFrame, dimensions: list[Dimension], group_by: list[str], measure: Measure, limit: int | None
) -> tuple[DataFrame, Callable[..., tuple[DataFrame, list[str], int | None]]]:
    """Flights joined with the dimensions, added up on the way, and what deals such rows out before they are grouped: it
    returns them with the columns to group by and the number of parts, none if they were not dealt out."""
    fits = fit_broadcast([d.rows for d in dimensions], limit)
    small = [d for d, fit in zip(dimensions, fits) if fit]
    large = [d for d, fit in zip(dimensions, fits) if not fit]

    rows = flights.withColumn("weight", F.lit(1).cast("bigint"))
    for d in small:
        rows = _multiplied(rows.join(F.broadcast(d.counted()), d.key), ("weight",))
    parts = {} if not large else _parts(rows, [c for c in group_by if c in rows.columns], [d.key for d in large])
    rows = measure.derive(rows)

    for i, d in enumerate(large):
        remaining = [other.key for other in large[i:]]
        keys = list(dict.fromkeys([c for c in group_by if c in rows.columns] + remaining))
        if parts:
            rows = _dealt_join(rows, d, keys, measure, parts)
        else:
            rows = _multiplied(measure.combine(rows, keys).join(d.counted(), d.key), measure.sums)

    def deal(rows: DataFrame, group_by: list[str], cut: str | None = None) -> tuple[DataFrame, list[str], int | None]:
        # After the last join, rows of a key are together unless it was cut into pieces.
        together = bool(parts) and large[-1].key in group_by and not parts[large[-1].key]
        if not parts or together or not _many(dimensions, group_by):
            return rows, group_by, None
        number = parts["number"]
        if cut is None:
            return rows.repartition(number, *group_by), group_by, number
        by = [*[c for c in group_by if c != cut], piece_of(cut)]
        return in_pieces(rows, cut, number).repartition(number, *by), [*group_by, piece_of(cut)], number

    return rows, deal


def _parts(rows: DataFrame, group_by: list[str], keys: list[str]) -> dict:
    """Nothing if the tasks of a shuffle can hold the different keys. Else the ``number`` of parts for the rows, and the
    hot values of each key, which have more rows than a part, with the number of pieces to cut each into.

    One reading of the rows tells, and if there are many keys, one more for each.
    """
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    groups = F.approx_count_distinct(F.struct(*dict.fromkeys(group_by + keys)))
    found = rows.agg(F.count("*").alias("rows"), groups.alias("groups")).first()
    if found["groups"] <= GROUPS * shuffle_tasks(rows.sparkSession):
        return {}
    number = ceil(found["rows"] / ROWS)
    return {"number": number} | {key: hot_keys(rows, key, number) for key in keys}


def _many(dimensions: list[Dimension], group_by: list[str]) -> bool:
    """Whether there may be more groups than the tasks of a shuffle can hold: as many as all attributes make together."""
    attributes = [[c for c in d.rows.columns if c in group_by and c != d.key] for d in dimensions]
    if set(group_by) - {c for columns in attributes for c in columns}:
        return True
    numbers = [
        d.rows.agg(F.approx_count_distinct(F.struct(*columns))).first()[0]
        for d, columns in zip(dimensions, attributes)
        if columns
    ]
    return prod(numbers) > GROUPS * shuffle_tasks(dimensions[0].rows.sparkSession)


def _dealt_join(rows: DataFrame, d: Dimension, keys: list[str], measure: Measure, parts: dict) -> DataFrame:
    """Rows dealt out by the key of a dimension, added up where they are then, and joined there.

    Rows of a hot key go to several pieces, by their other keys and the task they come from, which is the same if that
    task is run again. The dimension's rows of the key are repeated for each piece.
    """
    listed, by, hot = d.counted(), [d.key], parts[d.key]
    rows = rows.where(F.col(d.key).isNotNull())
    if hot:
        pieces, piece = f"{d.key} pieces", f"{d.key} piece"
        schema = f"`{d.key}` {rows.schema[d.key].dataType.simpleString()}, `{pieces}` int"
        found = F.broadcast(rows.sparkSession.createDataFrame(hot, schema))
        number = F.coalesce(F.col(pieces), F.lit(1))
        spread = F.xxhash64(F.spark_partition_id(), *[k for k in keys if k != d.key])
        rows = rows.join(found, d.key, "left").withColumn(piece, F.pmod(spread, number).cast("int")).drop(pieces)
        listed = listed.join(found, d.key, "left")
        listed = listed.withColumn(piece, F.explode(F.sequence(F.lit(0), number - 1))).drop(pieces)
        by = [d.key, piece]
    rows = measure.combine(rows.repartition(parts["number"], *by), list(dict.fromkeys([*keys, *by])))
    rows = _multiplied(rows.join(listed, by), measure.sums)
    return rows.drop(piece) if hot else rows


def _multiplied(rows: DataFrame, totals: tuple[str, ...]) -> DataFrame:
    return rows.withColumns({c: F.col(c) * F.col("copies") for c in totals}).drop("copies")
