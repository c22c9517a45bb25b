"""Mix sources to target weights by a min-cost flow over membership patterns.

Documents may belong to several sources. They are added up by pattern (the set of sources
they belong to), and a flow sends the words of patterns to the quotas of sources. A
pattern can be sent up to ``most`` times; each repetition costs more than the one before,
so the cheapest flow repeats as little as it can and evenly. Only one number per pattern
is needed for this; the solver runs on the driver with at most ``MOST_PATTERNS`` patterns
and refuses more; parts of the graph that share no source are solved one by one.

Documents are then chosen by seed: a pattern sent r times takes each document floor(r)
times, and once more those that come first in a seeded order until the remaining words are
reached. The order is cut into buckets by hash, so that a source of any size is a table of
bucket totals; only documents of the bucket where the words run out are ranked. Within it,
documents that overshoot are passed over and later, smaller ones taken, which ends within
a few words of the target.

Nulls: a null source is a source of its own, placed last; a null or empty text has no words
and is never taken. Rows with equal ids and sizes in a source are decided alike. An empty
table gives an empty result. Further columns pass through in ``row``.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, stored, word_array

MOST = 3
WEIGHTS = (5, 2, 1)
#: Documents of a bucket of the seeded order, about; the root of a pattern's documents where that is more,
#: so that neither the buckets of a pattern nor the documents of one of them become too many for a task.
BUCKET_DOCS = 2_000
MOST_PATTERNS = 100_000


def shares(sizes: np.ndarray, weights: np.ndarray, most: float = MOST) -> np.ndarray:
    """Targets that share the total of ``sizes`` by ``weights``, none above ``most`` times its size.

    What is cut off a source is shared again among those not cut off, until none is above.
    """
    total, limit = float(sizes.sum()), most * sizes.astype(float)
    targets, full = np.zeros(len(sizes)), sizes <= 0
    while not full.all():
        left = total - limit[full].sum()
        targets = np.where(full, limit, left * weights / weights[~full].sum())
        above = ~full & (targets > limit)
        if not above.any():
            return targets
        full |= above
    return np.where(sizes > 0, limit, 0.0)


def min_cost_flow(supply: list[float], members: list[list[int]], quota: list[float], most: int = MOST) -> list[list[float]]:
    """Words sent from each pattern to each source at least cost, as a table [pattern][source].

    The k-th repetition of a pattern costs k for each word, and words that no pattern can
    give stay unsent. Cheapest paths are augmented one after another (Bellman-Ford on the
    patterns and sources), which is exact for convex costs.
    """
    flow = [[0.0] * len(quota) for _ in supply]
    sent, got = [0.0] * len(supply), [0.0] * len(quota)
    eps = 1e-9 * max(1.0, sum(supply))
    while True:
        cost = [np.inf] * len(quota)
        via: list[tuple[int, int] | None] = [None] * len(quota)
        room = [0.0] * len(supply)
        price = [np.inf] * len(supply)
        for p, words in enumerate(supply):
            tier = int(min(most, (sent[p] + eps) // words)) if words > 0 else most
            if tier < most:
                price[p], room[p] = float(tier), words * (tier + 1) - sent[p]
                for s in members[p]:
                    if price[p] < cost[s]:
                        cost[s], via[s] = price[p], (p, -1)
        # A source may also take words that a pattern now sends to another source, which then is short.
        for _ in quota:
            changed = False
            for p, row in enumerate(flow):
                for t in members[p]:
                    if row[t] <= eps:
                        continue
                    for s in members[p]:
                        if cost[t] < cost[s] - 1e-12:
                            cost[s], via[s], changed = cost[t], (p, t), True
            if not changed:
                break
        open_sources = [s for s in range(len(quota)) if quota[s] - got[s] > eps and cost[s] < np.inf]
        if not open_sources:
            return flow
        end = min(open_sources, key=lambda s: cost[s])
        path, s, step = [], end, quota[end] - got[end]
        while True:
            p, t = via[s]
            path.append((p, t, s))
            if t < 0:
                step = min(step, room[p])
                sent[p] += step
                break
            step, s = min(step, flow[p][t]), t
        for p, t, s in path:
            flow[p][s] += step
            if t >= 0:
                flow[p][t] -= step
        got[end] += step


def solve(supply: list[float], members: list[list[int]], quota: list[float], most: int = MOST) -> list[list[tuple[int, float]]]:
    """The flow of each pattern as (source, words), solved for each connected part by itself."""
    parent = list(range(len(quota)))

    def root(s: int) -> int:
        while parent[s] != s:
            parent[s] = parent[parent[s]]
            s = parent[s]
        return s

    for m in members:
        for s in m[1:]:
            parent[root(s)] = root(m[0])
    parts: dict[int, list[int]] = {}
    for p, m in enumerate(members):
        parts.setdefault(root(m[0]), []).append(p)
    result: list[list[tuple[int, float]]] = [[] for _ in supply]
    for patterns in parts.values():
        sources = sorted({s for p in patterns for s in members[p]})
        place = {s: i for i, s in enumerate(sources)}
        flow = min_cost_flow(
            [supply[p] for p in patterns],
            [[place[s] for s in members[p]] for p in patterns],
            [quota[s] for s in sources],
            most,
        )
        for p, row in zip(patterns, flow):
            result[p] = [(s, row[place[s]]) for s in members[p]]
    return result


def source_keys(sources: Column) -> Column:
    """Sorted distinct sources of a document. The prefix puts null after every text."""
    return F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.coalesce(F.concat(F.lit("a"), s), F.lit("b")))))


def sized(docs: DataFrame, sources: Column, ident: str, text: str) -> DataFrame:
    """``row``, ``ident``, ``pattern`` and ``size`` in words of every document."""
    return docs.select(
        packed(docs),
        column(ident).alias("ident"),
        source_keys(sources).alias("pattern"),
        F.size(word_array(column(text))).cast("long").alias("size"),
    )


def decided(documents: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """How often each ``pattern``, ``ident`` and ``size`` is ``repeats``, and the sources' ``key``,
    ``source_size`` and ``target``."""
    spark = documents.sparkSession
    units = stored(documents.groupBy("pattern", "ident", "size").agg(F.count("*").alias("copies")))
    units = units.withColumn("words", F.col("size") * F.col("copies"))
    totals = stored(units.groupBy("pattern").agg(F.sum("words").alias("words"), F.count("*").alias("units")))
    n_patterns = totals.count()
    if n_patterns > MOST_PATTERNS:
        raise ValueError(f"{n_patterns} patterns of sources; at most {MOST_PATTERNS} can be balanced at once")
    patterns = totals.orderBy("pattern").collect()

    keys = sorted({k for row in patterns for k in row["pattern"]})
    place = {k: i for i, k in enumerate(keys)}
    sizes = np.zeros(len(keys))
    for row in patterns:
        for k in row["pattern"]:
            sizes[place[k]] += row["words"] / len(row["pattern"])
    weights = np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(keys))], dtype=float)
    targets = shares(sizes, weights)
    flows = solve(
        [float(row["words"]) for row in patterns], [[place[k] for k in row["pattern"]] for row in patterns], list(targets)
    )
    plan = []
    for row, flow in zip(patterns, flows):
        words = sum(w for _, w in flow)
        times = min(MOST, int(words / row["words"] + 1e-9)) if row["words"] else 0
        rest = max(0.0, words - times * row["words"]) if times < MOST else 0.0
        plan.append((row["pattern"], times, float(rest), -(-row["units"] // max(BUCKET_DOCS, isqrt(row["units"])))))
    # One row per pattern, MOST_PATTERNS at most.
    planned = spark.createDataFrame(plan, "pattern array<string>, times int, rest double, buckets long")
    sources = spark.createDataFrame(
        [(k, int(round(s)), float(t)) for k, s, t in zip(keys, sizes, targets)],
        "key string, source_size long, target double",
    )
    return _chosen(units, planned, seed), sources


def _chosen(units: DataFrame, planned: DataFrame, seed: int) -> DataFrame:
    turn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("ident"), F.col("size")), 1)
    units = units.withColumn("turn", turn).join(F.broadcast(planned), "pattern")
    units = units.withColumn("bucket", F.floor(F.col("turn") / float(1 << 63) * F.col("buckets")))
    in_order = Window.partitionBy("pattern").orderBy("bucket")
    # One row per bucket, that is one in BUCKET_DOCS of the documents or fewer.
    upto = (
        units.groupBy("pattern", "bucket", "rest").agg(F.sum("words").alias("words"))
        .withColumn("upto", F.sum("words").over(in_order))
    )
    last = upto.where(F.col("upto") > F.col("rest")).groupBy("pattern").agg(
        F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")), "bucket").alias("last")
    )
    units = units.join(F.broadcast(last), "pattern", "left")
    border = units.where(F.col("bucket") == F.col("last.bucket")).withColumn("left_over", F.col("rest") - F.col("last.before"))
    picked = border.select("pattern", "ident", "size", "words", "times", "turn", "left_over").groupBy("pattern").applyInArrow(
        _fill, f"pattern array<string>, ident {units.schema['ident'].dataType.simpleString()}, size long, repeats int"
    )
    clear = units.where(F.col("last").isNull() | (F.col("bucket") != F.col("last.bucket")))
    more = F.col("last").isNull() | (F.col("bucket") < F.col("last.bucket"))
    # All words of a pattern without a last bucket fit into the rest, which is none if it is empty.
    repeats = F.col("times") + F.when(more & (F.col("rest") > 0), 1).otherwise(0)
    chosen = clear.select("pattern", "ident", "size", repeats.alias("repeats")).unionByName(picked)
    return chosen.withColumn("repeats", F.when(F.col("size") > 0, F.col("repeats")).otherwise(0))


def _fill(units: pa.Table) -> pa.Table:
    """Take units in seeded order as long as they fit; pass over those that do not. One more is
    taken in the end if that comes nearer to the target."""
    units = units.sort_by([("turn", "ascending"), ("ident", "ascending"), ("size", "ascending")])
    left, times = units["left_over"][0].as_py(), units["times"][0].as_py()
    sizes, repeats = units["words"].to_pylist(), []
    for words in sizes:
        take = 0 < words <= left
        left -= words if take else 0
        repeats.append(times + take)
    spare = [i for i, r in enumerate(repeats) if r == times and sizes[i] > 0]
    nearest = min(spare, key=lambda i: abs(sizes[i] - left), default=None)
    if nearest is not None and abs(sizes[nearest] - left) < left:
        repeats[nearest] += 1
    return units.select(["pattern", "ident", "size"]).append_column("repeats", pa.array(repeats, pa.int32()))


def mixed(docs: DataFrame, sources: Column, ident: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken."""
    documents = sized(docs, sources, ident, text)
    repeats, _ = decided(documents, seed)
    keys = [documents[k].eqNullSafe(repeats[k]) for k in ("pattern", "ident", "size")]
    rows = documents.join(repeats.where("repeats > 0"), keys).select("row", "repeats")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select("row.*")


def accounted(docs: DataFrame, sources: Column, ident: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """``row`` of every document with its ``size``, ``pattern`` and how often the mix ``repeats`` it,
    and ``source_size`` and ``target`` of its first source."""
    documents = sized(docs, sources, ident, text)
    repeats, per_source = decided(documents, seed)
    keys = [documents[k].eqNullSafe(repeats[k]) for k in ("pattern", "ident", "size")]
    rows = documents.join(repeats, keys).select("row", documents["pattern"], documents["size"], "repeats")
    rows = rows.withColumn("key", F.get("pattern", F.lit(0)))
    return rows.join(F.broadcast(per_source), "key")
