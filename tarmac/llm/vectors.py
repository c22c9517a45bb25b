"""Near-duplicate vectors by product quantisation.

A coarse quantiser sends each vector to an inverted list; what is left of it is coded by one of
``CODES`` codewords in each of ``PARTS`` subspaces. A query looks into the lists that can hold a
neighbour: a vector within the wanted angle of the query has its home in another list only if
that list is hardly farther, by an amount that follows from the angle and the distance of
the two centroids. There distances are table lookups: products of the query with all
codewords are computed once, and the product with a coded vector is a sum of table
entries. Each code carries the length of its error, so that the sum plus that length is an upper
bound; pairs whose bound reaches the threshold get their exact cosine in double precision.

The quantisers are fitted on the driver on the ``SAMPLE`` vectors with the lowest hash of
their id; all vectors are coded and searched. Only vectors of one label meet. Lists of any size are
cut into blocks of members and of queries, and each pair of blocks is a task of its own. Tasks
report the number of links of each vector and one link to the smallest vector it is connected with
there, never pairs. A pair that can be found from both sides is looked at in one list only.

Vectors that are null, zero, of another length than most, or that hold null or non-finite
components link with nothing, and so do vectors without a label or id. Equal vectors are
links. Rows that repeat an id are one vector. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import column, groups, small_join, stored
from tarmac.llm.components import components

SAMPLE = 20_000
PARTS = 8
CODES = 256
MOST_LISTS = 1024
MEMBERS = 2_000
QUERIES = 4_000
ROUNDS = 12


@dataclass(frozen=True)
class Quantiser:
    centroids: np.ndarray  # lists x length
    between: np.ndarray  # distances of centroids
    codewords: np.ndarray  # PARTS x CODES x width; the length is filled up with zeros to PARTS x width
    angle: float  # largest distance of two unit vectors that are links
    slack: float

    def padded(self, x: np.ndarray) -> np.ndarray:
        width = self.codewords.shape[2]
        return np.pad(x, ((0, 0), (0, PARTS * width - x.shape[1]))).reshape(len(x), PARTS, width)


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) - 2 * x @ centers.T, axis=1)


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centers (fewer if there are fewer points); empty ones take points at random."""
    draw = np.random.default_rng(seed)
    centers = x[draw.permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        own = _nearest(x, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=len(centers))
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[draw.integers(len(x), size=len(centers))])
    return centers


def fitted(sample: np.ndarray, n: int, threshold: float) -> Quantiser:
    """Quantisers for ``n`` unit vectors from a sample of them."""
    lists = int(min(MOST_LISTS, max(1, round(n**0.5 / 2)), max(1, len(sample) // 8)))
    centroids = k_means(sample, lists, 1)
    rest = sample - centroids[_nearest(sample, centroids)]
    width = -(-sample.shape[1] // PARTS)
    parts = np.pad(rest, ((0, 0), (0, PARTS * width - rest.shape[1]))).reshape(len(rest), PARTS, width)
    codewords = np.zeros((PARTS, CODES, width))
    for p in range(PARTS):
        words = k_means(parts[:, p], CODES, 2 + p)
        codewords[p] = np.vstack([words, np.repeat(words[:1], CODES - len(words), axis=0)])
    gaps = (centroids**2).sum(axis=1)
    between = np.sqrt(np.maximum(gaps[:, None] + gaps - 2 * centroids @ centroids.T, 0))
    # The offset of a neighbour has a random direction: four standard deviations of its part along any line.
    slack = min(1.0, 4 / sample.shape[1] ** 0.5)
    return Quantiser(centroids, between, codewords, (2 - 2 * threshold) ** 0.5, slack)


def units(vectors: list) -> np.ndarray:
    """Unit vectors in double precision."""
    x = np.array(vectors, dtype=np.float64)
    return x / np.sqrt((x**2).sum(axis=1))[:, None]


def coded(rows: DataFrame, q: Quantiser) -> DataFrame:
    """``id``, ``label``, ``vector`` with the ``home`` list, the ``probes``, the ``codes`` and the ``error`` of the codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = units(batch.column("vector").to_pylist())
            far = (x**2).sum(axis=1)[:, None] + (q.centroids**2).sum(axis=1) - 2 * x @ q.centroids.T
            home = np.argmin(far, axis=1)
            reach = far[np.arange(len(x)), home][:, None] + 2 * q.slack * q.angle * q.between[home]
            probes = [np.flatnonzero(row).astype(np.int32) for row in far <= reach + 1e-9]
            rest = q.padded(x - q.centroids[home])
            codes = np.stack([_nearest(rest[:, p], q.codewords[p]) for p in range(PARTS)], axis=1)
            left = rest - q.codewords[np.arange(PARTS), codes]
            error = np.sqrt((left**2).sum(axis=(1, 2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("vector"), pa.array(home, pa.int32()),
                 pa.array(probes, pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary()),
                 pa.array(error, pa.float64())],
                ["id", "label", "vector", "home", "probes", "codes", "error"],
            )

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id long, label string, vector {kind}, home int, probes array<int>, codes binary, error double"
    )


def linked(vectors: DataFrame, threshold: float, ident: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id``, ``n_links`` and ``component_id`` of all vectors with an id."""
    rows = vectors.select(
        column(ident).cast("long").alias("id"),
        column(label).cast("string").alias("label"),
        _numbers(vectors, vector).alias("vector"),
    ).where("id is not null")
    finite = ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = rows.where(F.col("label").isNotNull() & finite & F.exists("vector", lambda v: v != 0)).dropDuplicates(["id"])
    lengths = usable.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    ids = rows.select("id").distinct()
    if lengths is None:
        return ids.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    usable = stored(usable.where(F.size("vector") == lengths["length"]))
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()
    q = fitted(units([r["vector"] for r in sample]), lengths["count"], threshold)
    found = stored(searched(stored(coded(usable, q)), q, threshold))
    degrees = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b")).withColumnRenamed("node", "id")
    return ids.join(degrees, "id", "left").join(roots, "id", "left").select(
        "id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )


def _numbers(vectors: DataFrame, vector: str) -> Column:
    """The vectors in single precision if they are given so, which halves what is shuffled, else in double."""
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    return column(vector).cast("array<float>" if single else "array<double>")


def searched(rows: DataFrame, q: Quantiser, threshold: float) -> DataFrame:
    """Links of the vectors of a pair of blocks: ``a``, ``b`` (smallest vector connected with it there) and the number ``links``."""
    asked = rows.select("label", "id", F.explode("probes").alias("list"), F.lit(False).alias("member"))
    placed = asked.unionAll(rows.select("label", "id", F.col("home").alias("list"), F.lit(True).alias("member")))
    sizes = stored(
        placed.groupBy("label", "list").agg(
            F.ceil(F.count_if("member") / MEMBERS).cast("int").alias("member_blocks"),
            F.ceil(F.count_if(~F.col("member")) / QUERIES).cast("int").alias("query_blocks"),
        )
    )
    # Lists without members answer nobody.
    sizes = sizes.where("member_blocks > 0")
    payload = F.struct("id", "vector", "home", "probes", "codes", "error").alias("v")
    each = rows.select(
        "label", payload,
        F.explode(F.concat(
            F.transform("probes", lambda p: F.struct(p.alias("list"), F.lit(False).alias("member"))),
            F.array(F.struct(F.col("home").alias("list"), F.lit(True).alias("member"))),
        )).alias("in"),
    ).select("label", "v", "in.list", "in.member")
    each = small_join(each, sizes, ["label", "list"], "inner")
    own = F.pmod(F.xxhash64("v.id"), F.when(F.col("member"), F.col("member_blocks")).otherwise(F.col("query_blocks"))).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("member"), F.col("query_blocks")).otherwise(F.col("member_blocks")) - 1)
    tasks = each.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "label", "list",
        F.when(F.col("member"), F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("member"), F.col("other")).otherwise(F.col("own")).alias("j"),
        "member", "v.*",
    )
    tasks = tasks.repartition("label", "list", "i", "j").sortWithinPartitions("label", "list", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["label", "list", "i", "j"]):
            links = block_links(group, q, threshold)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in links], ["a", "b", "links"])

    return tasks.mapInArrow(run, "a long, b long, links long")


def block_links(group: pa.Table, q: Quantiser, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Links between the queries and the members of a block."""
    member = np.array(group.column("member").to_pylist())
    if member.all() or not member.any():
        return None
    x = units(group.column("vector").to_pylist())
    ids, home, error = (group.column(c).to_numpy() for c in ("id", "home", "error"))
    codes = np.frombuffer(b"".join(group.column("codes").to_pylist()), np.uint8).reshape(-1, PARTS)
    probes = group.column("probes").combine_chunks()
    bounds, flat = probes.offsets.to_numpy(), probes.flatten().to_numpy()
    asks = np.zeros((len(ids), len(q.centroids)), bool)
    asks[np.repeat(np.arange(len(ids)), np.diff(bounds)), flat] = True
    here = group.column("list")[0].as_py()
    members, queries = np.flatnonzero(member), np.flatnonzero(~member)
    left, right = [], []
    for start in range(0, len(queries), 256):
        part = queries[start : start + 256]
        tables = np.einsum("qpw,pcw->qpc", q.padded(x[part]), q.codewords)
        bound = np.repeat((x[part] @ q.centroids[here])[:, None], len(members), axis=1) + error[members]
        for p in range(PARTS):
            bound += tables[:, p][:, codes[members, p]]
        a, b = np.nonzero(bound >= threshold - 1e-9)
        a, b = part[a], members[b]
        # Two of one list: once. Two that ask each other's lists: in the lower list.
        once = np.where(home[a] == here, ids[a] < ids[b], ~(asks[b, home[a]] & (home[a] < here)))
        a, b = a[once], b[once]
        for k in range(0, len(a), 100_000):
            close = np.einsum("ij,ij->i", x[a[k : k + 100_000]], x[b[k : k + 100_000]]) >= threshold
            left.append(a[k : k + 100_000][close])
            right.append(b[k : k + 100_000][close])
    a, b = (np.concatenate(s) if s else np.zeros(0, np.int64) for s in (left, right))
    if not len(a):
        return None
    # A vector may be here twice, as a query and as a member.
    names, place = np.unique(ids, return_inverse=True)
    a, b = place[a], place[b]
    links = np.bincount(a, minlength=len(names)) + np.bincount(b, minlength=len(names))
    roots = names.copy()
    while True:
        before = roots.copy()
        np.minimum.at(roots, a, roots[b])
        np.minimum.at(roots, b, roots[a])
        if (before == roots).all():
            break
    some = links > 0
    return names[some], roots[some], links[some]
