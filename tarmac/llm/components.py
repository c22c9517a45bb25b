"""Connected components of links between ids, in a logarithmic number of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest id) for every id in the links ``a``, ``b``.

    Alternates two steps, each one aggregate and one join: every node hands its larger
    neighbours to its smallest one, then its smaller neighbours. Links never get more, no node's
    neighbours are gathered in one place, and each round is written, so nothing is held in memory.
    """
    links = stored(_ordered(links.select("a", "b")))
    seen = None
    for _ in range(MOST_ROUNDS):
        links = stored(_ordered(_small(_large(links))))
        state = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    # Settled links are stars around the smallest id.
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _ordered(links: DataFrame) -> DataFrame:
    """Links from the larger to the smaller id, each once."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    links = _ordered(links)
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
        least.select("a", F.col("m").alias("b"))
    )
