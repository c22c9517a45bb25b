"""Near-duplicate join of texts by the Jaccard similarity of their five-word shingles.

Texts with the same words are one class, represented by its smallest id. Representatives
that share all values of a band of MinHash values meet in a bucket. Pairs are pruned in
the Bayesian way: MinHash values are compared a few at a time, and a pair is dropped as soon as
the posterior probability that it reaches the threshold falls below ``TOLERANCE`` (with a
uniform prior, given m of n equal values, it is the chance of at most m hits in n + 1 tries).
The others are verified exactly on their shingle sets.

A pair that shares several buckets is looked at in the first of them only; buckets with the
same members count as one. No pair is written: a bucket reports, for each member, the number
of its links and one link to the smallest member it is connected with. Buckets of any
size are cut into blocks of about ``BLOCK`` members, and each pair of blocks is a task of its own.

Nulls: a null text or id has no words and links with nothing. A text of one to four words is
one shingle. Texts are compared whole. Rows of equal words and different ids are links. Rows that repeat
an id are one document; if their texts differ, it is found by one of them and compared by the first in order. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import column, groups, packed, stored, text_chunks
from tarmac.llm.components import components
from tarmac.llm.shingles import min_hashes, shingles

BANDS = 32
BAND_ROWS = 4
VALUES = BANDS * BAND_ROWS
STEP = 16
TOLERANCE = 1e-9
BLOCK = 1000
#: Bytes of text whose shingles are hashed at once; few enough to stay in the processor's cache.
CHUNK = 400_000
#: The threshold as a fraction: 4/5.
NUMERATOR, DENOMINATOR = 4, 5


def signatures(docs: DataFrame) -> DataFrame:
    """``id``, ``code`` (of the word sequence), the ``keys`` of the bands and 16 bits of each MinHash value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch.column("text"), CHUNK):
                runs, first, codes = shingles([t.encode() for t in texts])
                values = min_hashes(runs, first, VALUES)
                keys = band_keys(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(start, len(texts)),
                        pa.array(codes.view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, (len(texts) + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys.ravel())
                        ),
                        pa.array([row.tobytes() for row in values.astype(np.uint16)], pa.binary()),
                    ],
                    ["id", "code", "keys", "values"],
                )

    return docs.mapInArrow(run, "id long, code long, keys array<long>, values binary").where("code <> 0")


def band_keys(values: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, different from band to band."""
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(values), 1))
    for k in range(BAND_ROWS):
        keys = (keys ^ values[:, k::BAND_ROWS].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def least_matches() -> list[int]:
    """For each number of compared values, the fewest equal ones with which a pair goes on."""
    t = NUMERATOR / DENOMINATOR
    result = []
    for n in range(STEP, VALUES + 1, STEP):
        chance, m = 0.0, 0
        while True:
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= TOLERANCE:
                break
            m += 1
        result.append(m)
    return result


def linked(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``class_id`` (smallest id connected by links) and ``n_links`` of all documents with an id."""
    rows = docs.select(column(ident).cast("long").alias("id"), column(text).alias("text")).where("id is not null")
    signed = signatures(rows).groupBy("id").agg(F.min(F.struct("code", "keys", "values")).alias("s")).select("id", "s.*")
    signed = stored(signed)
    classes = stored(signed.groupBy("code").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    members = stored(signed.select("id", "code").join(classes, "code").select("id", "rep", "copies"))
    reps = signed.join(classes, (signed["code"] == classes["code"]) & (signed["id"] == classes["rep"])).select(
        "id", "copies", "keys", "values"
    )
    work = candidates(stored(reps))
    texts = rows.groupBy("id").agg(F.min("text").alias("text"))
    pairs = stored(compared(work.join(texts, "id")))
    degrees = pairs.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(pairs.select("a", "b")).select(F.col("node").alias("rep"), "component")
    found = members.join(degrees, "rep", "left").join(roots, "rep", "left").select(
        "id",
        F.coalesce("component", "rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    ids = rows.select("id").distinct()
    return ids.join(found, "id", "left").select(
        "id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def candidates(reps: DataFrame) -> DataFrame:
    """Representatives that meet others, with their buckets ``met``: key and number of blocks;
    keys of other bands become 0."""
    keyed = reps.select("id", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    )
    # Of buckets with the same members one is enough.
    kept = buckets.where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    kept = kept.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    met = keyed.join(stored(kept), "key").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("key", "blocks"))).alias("met"))
    return reps.join(met, "id").select(
        "id", "copies", "values",
        F.transform("keys", lambda k: F.when(F.map_contains_key("met", k), k).otherwise(0)).alias("keys"),
        F.map_entries("met").alias("met"),
    )


def compared(work: DataFrame) -> DataFrame:
    """Links of each member of a bucket: ``a``, ``b`` (smallest member connected with it there) and the number ``links``."""
    each = work.select("id", "copies", "values", "keys", "text", F.explode("met").alias("bucket"))
    block = F.pmod(F.xxhash64("id"), F.col("bucket.value")).cast("int")
    each = each.select("id", "copies", "values", "keys", "text", "bucket", block.alias("block"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("bucket.value") - 1)))
    tasks = each.select(
        F.col("bucket.key").alias("key"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "id", "copies", "values", "keys", "text",
    )
    placed = tasks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    least = least_matches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["key", "i", "j"]):
            found = bucket_links(group, least)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["a", "b", "links"])

    return placed.mapInArrow(run, "a long, b long, links long")


def bucket_links(group: pa.Table, least: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Links among the members of a block, or between those of two blocks."""
    m = group.num_rows
    if m < 2:
        return None
    key, i, j = (group.column(c)[0].as_py() for c in ("key", "i", "j"))
    ids, copies, block = (group.column(c).to_numpy() for c in ("id", "copies", "block"))
    keys = group.column("keys").combine_chunks().flatten().to_numpy().reshape(m, BANDS)
    values = np.frombuffer(b"".join(group.column("values").to_pylist()), np.uint16).reshape(m, VALUES)

    if i == j:
        a, b = np.triu_indices(m, 1)
    else:
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        a, b = np.repeat(left, len(right)), np.tile(right, len(left))
    # Pairs that share an earlier bucket are looked at there.
    for band in range(int(np.flatnonzero(keys[0] == key)[0])):
        new = (keys[a, band] != keys[b, band]) | (keys[a, band] == 0)
        a, b = a[new], b[new]
    equal = np.zeros(len(a), np.int32)
    for step, fewest in enumerate(least):
        part = slice(step * STEP, (step + 1) * STEP)
        equal += (values[a, part] == values[b, part]).sum(axis=1, dtype=np.int32)
        going = equal >= fewest
        a, b, equal = a[going], b[going], equal[going]
    a, b = verified(group.column("text"), a, b)
    if not len(a):
        return None
    links = np.bincount(a, copies[b], m) + np.bincount(b, copies[a], m)
    roots = ids.copy()
    while True:
        before = roots.copy()
        np.minimum.at(roots, a, roots[b])
        np.minimum.at(roots, b, roots[a])
        if (before == roots).all():
            break
    some = links > 0
    return ids[some], roots[some], links[some].astype(np.int64)


def verified(texts: pa.ChunkedArray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (sorted by ``a``) whose shingle sets are as similar as asked for."""
    if not len(a):
        return a, b
    used = np.unique(np.r_[a, b])
    place = np.zeros(used[-1] + 1, np.int64)
    place[used] = np.arange(len(used))
    runs, first, _ = shingles([(t or "").encode() for t in texts.take(pa.array(used)).to_pylist()])
    names, inverse = np.unique(runs, return_inverse=True)
    owners = np.repeat(np.arange(len(used)), np.diff(first))
    sets = np.unique(owners * len(names) + inverse)
    first = np.searchsorted(sets, np.arange(len(used) + 1) * len(names))
    sets %= len(names)
    sizes = np.diff(first)
    good = np.zeros(len(a), bool)
    mark = np.zeros(len(names), bool)
    for start, stop in runs_of_equal(a, sizes[place[b]]):
        own = place[a[start]]
        others = place[b[start:stop]]
        mark[sets[first[own] : first[own + 1]]] = True
        lengths = sizes[others]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(first[others] - (ends - lengths), lengths)
        common = np.add.reduceat(mark[sets[at]], ends - lengths, dtype=np.int64)
        mark[sets[first[own] : first[own + 1]]] = False
        good[start:stop] = common * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (sizes[own] + lengths)
    return a[good], b[good]


def runs_of_equal(a: np.ndarray, sizes: np.ndarray, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of equal values, cut where their sizes add up to more than ``most``."""
    bounds = [0, *(np.flatnonzero(a[1:] != a[:-1]) + 1).tolist(), len(a)]
    for start, stop in zip(bounds, bounds[1:]):
        while start < stop:
            upto = np.cumsum(sizes[start:stop])
            end = start + max(1, int(np.searchsorted(upto, most, side="right")))
            yield start, end
            start = end


def one_of_each(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the smallest id of their class, and those without an id, with their own columns.

    Of rows that repeat an id the first in order stays.
    """
    kept = linked(docs, ident, text).where("id = class_id").select("id")
    rows = docs.select(packed(docs), column(ident).cast("long").alias("id"))
    first = rows.join(kept, "id").groupBy("id").agg(F.min("row").alias("row"))
    return first.select("row.*").unionByName(rows.where("id is null").select("row.*"))
