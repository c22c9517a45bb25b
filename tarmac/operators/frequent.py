"""Frequent names per group in bounded memory, for groups with more names than can be counted one by one.

The first reading keeps a summary of ``counters`` counters per group in each task. Summaries are merged after the
shuffle, first in ``MERGERS`` parts of the tasks and then per group, so that no task merges all of a large group.
A name that a summary had to let go can have a known share of the group's rows at most
(:func:`most_left_out`). The second reading counts the names that the summary returned, exactly.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.joins import fit_broadcast
from tarmac.operators.ranking import top_n_per_group
from tarmac.sources.scratch import kept

COUNTERS = 4096
MERGERS = 64
# Fixed values of Spark's frequent-items sketch: the share of its map that is used, and its error per row and map place.
LOAD = 0.75
ERROR = 3.5


def _map_size(counters: int) -> int:
    return 1 << (ceil(counters / LOAD) - 1).bit_length()


def most_left_out(rows: Column, counters: int = COUNTERS) -> Column:
    """How many rows a name that the summary of a group of so many ``rows`` does not return can have at most.

    A name is returned if its count less the error is above the error. There is no error while there are counters for all.
    """
    return F.when(rows <= counters, 0).otherwise(F.floor(rows * F.lit(2 * ERROR / _map_size(counters)))).cast("bigint")


def summaries(rows: DataFrame, group: str, name: str, counters: int = COUNTERS) -> DataFrame:
    """``group``, its number of rows ``total`` and the merged summary ``counts`` of its names.

    What a task sends is one summary per group, however many names it met.
    """
    merger = F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger")
    parts = rows.select(F.col(group).alias("group"), F.col(name).alias("name"), merger).groupBy("group", "merger").agg(
        F.expr(f"approx_top_k_accumulate(name, {counters})").alias("counts"), F.count("*").alias("total")
    )
    merged = F.expr(f"approx_top_k_combine(counts, {counters})").alias("counts")
    return parts.groupBy("group").agg(merged, F.sum("total").alias("total"))


def approx_top_n(
    rows: DataFrame, group: str, name: str, n: int, counters: int = COUNTERS, limit: int | None = None
) -> DataFrame:
    """Top ``n`` names per group by number of rows: the group, ``rank``, name, ``flights`` and ``sure``.

    The counts are exact. A name is missing from its place only if it has :func:`most_left_out` rows or fewer; ranks
    whose count is above that are ``sure``. With no more names than counters in a group the result is that of an exact count.
    Each group gets ``n`` names, or all it has: a group whose summary returns fewer, as one whose many names are
    alike, is filled up with its first names in alphabetical order. Equal counts are in alphabetical order.

    Rows with a null group or name are left out. Candidates are broadcast if they are measured to fit
    (``limit``, see :func:`tarmac.operators.joins.fit_broadcast`); then no more than these cross the network.
    """
    rows = rows.select(F.col(group).alias("group"), F.col(name).alias("name")).dropna()
    # The names that can be among the n most frequent: not below the n-th estimate by more than both estimates may be wrong.
    merged = summaries(rows, "group", "name", counters).withColumn("names", F.expr(f"approx_top_k_estimate(counts, {counters})"))
    least = F.coalesce(F.get("names", F.lit(n - 1))["count"], F.lit(0)) - most_left_out(F.col("total"), counters)
    names = F.transform(F.filter("names", lambda x: x["count"] >= F.col("least")), lambda x: x["item"]).alias("names")
    found = kept(merged.withColumn("least", least).select("group", "total", names))
    frequent = found.select("group", F.explode("names").alias("name"))
    # The first names of a group: each task sends the rows of n names of each such group at most.
    short = found.where(F.size("names") < n).select("group")
    members = rows.join(F.broadcast(short) if fit_broadcast([short], limit)[0] else short, "group", "left_semi")
    place = F.dense_rank().over(Window.partitionBy("group").orderBy("name"))
    first = members.withColumn("place", place).where(F.col("place") <= n).select("group", "name")
    candidates = kept(frequent.unionAll(first).distinct())

    best = top_n_per_group(exact_counts(rows, candidates, limit), "group", "flights", "name", n)
    sure = F.col("flights") > most_left_out(F.col("total"), counters)
    columns = [F.col("group").alias(group), F.col("rank"), F.col("name").alias(name), F.col("flights"), sure.alias("sure")]
    return best.join(found.select("group", "total"), "group").select(*columns)


def exact_counts(rows: DataFrame, candidates: DataFrame, limit: int | None = None) -> DataFrame:
    """``group``, ``name`` and number of ``flights`` of the candidates.

    Candidates that fit are looked up before anything is counted, so tasks send no other names. Beyond that all names
    are counted first, which keeps a name that holds many rows from meeting its candidate row by row.
    """
    keys = ["group", "name"]
    if fit_broadcast([candidates], limit)[0]:
        return rows.join(F.broadcast(candidates), keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("flights"))
    return rows.groupBy(*keys).agg(F.count("*").alias("flights")).join(candidates, keys, "left_semi")
