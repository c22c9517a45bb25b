"""Sorting, top n, top n per group and lists in rank order. Every order has a tie-break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pieces of a group that is ranked for a large n.
PIECES = 64


def top_n(counts: DataFrame, count: str, names: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the highest count; equal counts by names. Each task keeps ``n`` rows."""
    return counts.orderBy(F.desc(count), *names).limit(n)


def in_pieces(rows: DataFrame, name: str, pieces: int) -> DataFrame:
    """Rows with a ``piece_of(name)``, which is the same for equal names."""
    return rows.withColumn(piece_of(name), F.pmod(F.xxhash64(name), F.lit(pieces)))


def piece_of(name: str) -> str:
    return f"{name} piece"


def top_n_per_group(
    counts: DataFrame, group: str, count: str, name: str, n: int, parts: int | None = None
) -> DataFrame:
    """The same for each group, with the ``rank`` from 1. At most ``n`` rows of a group
    leave a task, so a group of any size is ranked without gathering it.

    Spark cuts groups off in the tasks only up to its ``windowGroupLimitThreshold``. Beyond
    it a group is first ranked in ``PIECES`` pieces, and only the first ``n`` of each meet.

    If the counts lie in a number of ``parts`` by group and piece (:func:`in_pieces`), with more of them than the tasks of a
    shuffle may hold, they are ranked there, and the first ``n`` of each piece are dealt by group over as many parts.
    """
    if parts is not None:
        piece = piece_of(name)
        counts = _ranked(counts, [F.col(group), F.col(piece)], count, name).where(F.col("rank") <= n).drop("rank", piece)
        return _ranked(counts.repartition(parts, group), [F.col(group)], count, name).where(F.col("rank") <= n)
    session = counts.sparkSession
    if n > int(session.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        piece = F.pmod(F.xxhash64(name), F.lit(PIECES))
        counts = _ranked(counts, [F.col(group), piece], count, name).where(F.col("rank") <= n).drop("rank")
    return _ranked(counts, [F.col(group)], count, name).where(F.col("rank") <= n)


def _ranked(counts: DataFrame, group: list[Column], count: str, name: str) -> DataFrame:
    best_first = Window.partitionBy(*group).orderBy(F.desc(count), F.asc(name))
    return counts.withColumn("rank", F.row_number().over(best_first).cast("bigint"))


def ordered_list(ranked: DataFrame, group: str, name: str, into: str) -> DataFrame:
    """One row per group with its names in rank order, as the text ``[a, b, c]``."""
    listed = F.expr(f"listagg(`{name}`, ', ') within group (order by rank)")
    return ranked.groupBy(group).agg(F.concat(F.lit("["), listed, F.lit("]")).alias(into))


