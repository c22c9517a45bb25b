"""Reproducible shuffle of rows into shards by a keyed permutation of row numbers.

Rows get global numbers 0..n-1 in the order of given keys. A Feistel network permutes a
near-square grid of n numbers and few more; values from n on are sent through again until
they fall below it (cycle walking), which permutes 0..n-1 itself. Shard and slot follow
from the permuted number by division, so anybody with n, the seed and a row number can
compute where the row lies: counts of shards differ by one at most, slots have no gaps.

Row numbers: rows are range partitioned and sorted by the keys, a hash of the whole row
and where it was read, so that equal keys, even a third of all rows, spread over
partitions. Only one count per partition is added up. Nothing but columns of fixed size is
needed; texts need not pass through.

Nulls in keys sort first. Rows with equal keys are ordered by their content, equal rows
are interchangeable. An empty table gives an empty result. Columns with clashing names
pass through in ``row``.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, stored

ROUNDS = 6
WALK = 16
INDEX_BITS = 33


def numbered(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """``row`` (all columns) with ``number``, its place in the order of ``keys``, and the count of rows."""
    whole = F.xxhash64(*[column(c) for c in rows.columns])
    order = [*[column(k) for k in keys], whole, F.monotonically_increasing_id()]
    named = {f"order_{i}": c for i, c in enumerate(order)}
    keyed = rows.select(packed(rows), *[c.alias(name) for name, c in named.items()])
    placed = keyed.repartitionByRange(*named).sortWithinPartitions(*named)
    placed = stored(placed.select("row", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", INDEX_BITS).cast("int")
    # One row per partition.
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    within = F.col("place").bitwiseAND((1 << INDEX_BITS) - 1)
    joined = placed.withColumn("part", part).join(F.broadcast(counts), "part")
    return joined.select("row", (F.col("start") + within).alias("number")), total


def sides(n: int) -> tuple[int, int]:
    """The halves of the network: the least near-square grid of ``n`` numbers and few more."""
    a = max(1, isqrt(max(n, 1) - 1) + 1)
    return a, -(-max(n, 1) // a)


def permuted(number: Column, n: int, seed: int) -> Column:
    """``number`` (0 to n-1) permuted.

    The grid has fewer than sqrt(n) + 1 numbers beyond n, so a walk of ``WALK`` steps always
    ends for n up to WALK**2, and beyond that misses with a chance under WALK**-WALK.
    """
    a, b = sides(n)
    inside = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        _one_pass(number.cast("long"), a, b, seed),
        lambda x, _: F.when(x < n, x).otherwise(_one_pass(x, a, b, seed)),
    )
    return F.when(inside < n, inside).otherwise(F.raise_error(F.lit("the walk did not end; take another seed")))


def _one_pass(value: Column, a: int, b: int, seed: int) -> Column:
    """A number is a place in an a x b grid. Each round shifts one coordinate by a hash of
    the other, which can be undone, so the pass permutes the grid."""

    def step(v: Column, i: Column) -> Column:
        x, y = F.floor(v / b).cast("long"), v % b
        shifted_x = F.pmod(x + F.pmod(F.xxhash64(y, F.lit(seed), i), F.lit(a)), F.lit(a)) * b + y
        shifted_y = x * b + F.pmod(y + F.pmod(F.xxhash64(x, F.lit(seed), i), F.lit(b)), F.lit(b))
        return F.when(i % 2 == 0, shifted_x).otherwise(shifted_y).cast("long")

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), value, step)


def sharded(rows: DataFrame, keys: list[str], shards: int, seed: int = 0) -> DataFrame:
    """``row`` with ``shard`` (0 to shards-1) and ``slot`` (from 0, without gaps) of every row."""
    placed, n = numbered(rows, keys)
    target = permuted(F.col("number"), n, seed)
    return placed.withColumn("target", target).select(
        "row", (F.col("target") % shards).cast("int").alias("shard"), F.floor(F.col("target") / shards).alias("slot")
    )
