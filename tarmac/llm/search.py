"""Ranked lexical search: the best documents of all for each of a set of queries.

Two readings of the documents. The first counts documents, terms and the documents of each term asked for. The
second scores: a batch of documents is a block with posting lists of the terms asked for, and each query is worked off
a term at a time, rarest first. A document gets an accumulator when one of the query's terms reaches
it first. As soon as the terms that are left cannot lift a new document to the score that the
query's k-th best accumulator has already, no more accumulators are made; those that
can still reach that score take the remaining terms exactly. The bounds of terms are the largest contributions in
the block. A task carries the k best of each query from block to block, so later blocks start with the bound of earlier
ones; it returns k rows of each query at most, and Spark ranks those.

Texts are neither shuffled nor collected. Queries are taken in blocks of ``QUERIES`` and ``QUERY_BYTES`` at
most, one pair of readings each, so that what is broadcast does not grow with their number (one query alone is never cut).

Null texts have no terms; documents and queries without terms find nothing. Equal scores are ranked by
document id. Rows that repeat an id are ranked each; equal rows of queries are merged by id: the terms of a query id are those of all its rows. Rows without a query id
or document id are left out. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import column, stored
from tarmac.llm.cuts import BREAK, byte_classes, cut

# Letters and digits of ASCII and all beyond it are terms.
TERM_BYTES = bytes(b for b in range(256) if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
# Fixed values of the scores.
SCALE, SATURATION, FLAT, SLOPE = 1_000_000_000, 8, 10, 90

QUERIES = 5_000
QUERY_BYTES = 16_000_000
BLOCK_BYTES = 8_000_000


@dataclass(frozen=True)
class Asked:
    """Queries with their terms as places in ``terms``."""

    ids: np.ndarray
    terms: pa.Array
    of: list[np.ndarray]


@dataclass(frozen=True)
class Corpus:
    documents: int
    length: int  # all terms, with repeats
    found: np.ndarray  # documents of each term asked for

    def weights(self) -> np.ndarray:
        return np.floor(1000 * np.log((2 * self.documents + 2) / (2 * self.found + 1))).astype(np.int64)


@dataclass(frozen=True)
class Block:
    """Documents with their number of terms, and the postings of the terms asked for, ordered by term and document."""

    ids: np.ndarray
    length: np.ndarray
    bounds: np.ndarray  # of the postings of each term
    doc: np.ndarray
    often: np.ndarray


def asked(rows: list, classes: np.ndarray) -> Asked:
    """Queries of rows ``id`` and ``text``, a row of no terms included."""
    found = cut(pa.array([r["text"] for r in rows], pa.string()), classes)
    coded = found.words.dictionary_encode()
    ids, place = np.unique(np.array([r["id"] for r in rows], np.int64), return_inverse=True)
    pairs = np.unique(np.stack([place[found.text], coded.indices.to_numpy()]), axis=1) if len(found.words) else np.zeros((2, 0), int)
    cuts = np.searchsorted(pairs[0], np.arange(len(ids) + 1))
    return Asked(ids, coded.dictionary, [pairs[1][a:b] for a, b in zip(cuts, cuts[1:])])


def blocks(batches: Iterator[pa.RecordBatch], terms: pa.Array, classes: np.ndarray) -> Iterator[Block]:
    for batch in batches:
        texts = batch.column("text")
        upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(texts):
            before = upto[start - 1] if start else 0
            stop = min(len(texts), int(np.searchsorted(upto, before + BLOCK_BYTES)) + 1)
            found = cut(texts.slice(start, stop - start), classes)
            ids = batch.column("id").slice(start, stop - start).to_numpy()
            start = stop
            term = pc.index_in(found.words, terms.cast(pa.large_string()))
            some = pc.is_valid(term).to_numpy(zero_copy_only=False)
            pairs = pc.fill_null(term, 0).to_numpy()[some].astype(np.int64) * len(ids) + found.text[some]
            pairs, often = np.unique(pairs, return_counts=True)
            bounds = np.searchsorted(pairs, np.arange(len(terms) + 1) * len(ids))
            yield Block(ids, np.bincount(found.text, minlength=len(ids)), bounds, pairs % len(ids), often)


def statistics(docs: DataFrame, shared, classes: np.ndarray) -> Corpus:
    """Counts over all documents. The driver sees one number for each term asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value.terms
        total, documents, length = np.zeros(len(terms), np.int64), 0, 0
        for b in blocks(batches, terms, classes):
            total += np.diff(b.bounds)
            documents += int((b.length > 0).sum())
            length += int(b.length.sum())
        some = np.flatnonzero(total)
        names = np.concatenate([[-2, -1], some])
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.concatenate([[documents, length], total[some]]))], ["name", "n"])

    sums = docs.mapInArrow(run, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")).toArrow()
    n = dict(zip(sums["name"].to_pylist(), sums["n"].to_pylist()))
    return Corpus(n.get(-2, 0), n.get(-1, 0), np.array([n.get(i, 0) for i in range(len(shared.value.terms))], np.int64))


class Best:
    """The ``k`` best documents of a query so far."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """What a document must reach at least, 1 as long as there are fewer than ``k``."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


def work_off(b: Block, gains: np.ndarray, most: np.ndarray, terms: np.ndarray, best: Best, sums: np.ndarray) -> None:
    """Score a block for one query. ``terms`` are rarest first; ``sums`` is all zero and is left so."""
    terms = terms[most[terms] > 0]
    left = np.cumsum(most[terms][::-1])[::-1]
    least, made, at = best.least(), [], 0
    # As long as a new document could reach the k-th best, accumulators are made.
    while at < len(terms) and left[at] >= least:
        lo, hi = b.bounds[terms[at]], b.bounds[terms[at] + 1]
        made.append(b.doc[lo:hi])
        sums[made[-1]] += gains[lo:hi]
        at += 1
        if at < len(terms) and at % 4 == 0:
            known = np.unique(np.concatenate(made))
            made = [known]
            if len(known) >= best.k:
                least = max(least, int(np.partition(sums[known], -best.k)[-best.k]))
    if not made:
        return
    known = np.unique(np.concatenate(made))
    scores = sums[known]
    sums[known] = 0
    for t, rest in zip(terms[at:], left[at:]):
        reach = scores + rest >= least
        known, scores = known[reach], scores[reach]
        lo, hi = b.bounds[t], b.bounds[t + 1]
        place = np.searchsorted(b.doc[lo:hi], known)
        place[place == hi - lo] = 0
        hit = b.doc[lo:hi][place] == known
        scores[hit] += gains[lo:hi][place[hit]]
        if len(scores) >= best.k:
            least = max(least, int(np.partition(scores, -best.k)[-best.k]))
    good = scores >= least
    if good.any():
        best.add(b.ids[known[good]], scores[good])


def gained(b: Block, corpus: Corpus, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each posting adds to its document's score, and the most that each term adds in the block."""
    m = FLAT + (SLOPE * b.length * corpus.documents) // max(1, corpus.length)
    term = np.repeat(np.arange(len(weights)), np.diff(b.bounds))
    gains = weights[term] * ((SCALE * b.often) // (1000 * b.often + SATURATION * m[b.doc]))
    most = np.zeros(len(weights), np.int64)
    np.maximum.at(most, term, gains)
    return gains, most


def _searched(docs: DataFrame, rows: list, k: int) -> DataFrame:
    classes = byte_classes(word=TERM_BYTES, others=BREAK)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(asked(rows, classes))
    corpus = statistics(docs, shared, classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, weights = shared.value, corpus.weights()
        rarest = [t[np.lexsort((t, corpus.found[t]))] for t in q.of]
        best = [Best(k) for _ in q.of]
        for b in blocks(batches, q.terms, classes):
            gains, most = gained(b, corpus, weights)
            sums = np.zeros(len(b.ids), np.int64)
            for terms, own in zip(rarest, best):
                work_off(b, gains, most, terms, own, sums)
        counts = [len(own.ids) for own in best]
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(q.ids, counts)), pa.array(np.concatenate([own.ids for own in best])),
                 pa.array(np.concatenate([own.scores for own in best]))],
                ["query", "id", "score"],
            )

    return docs.mapInArrow(run, "query long, id long, score long")


def searched(
    docs: DataFrame, queries: DataFrame, k: int = 10, ident: str = "doc_id", text: str = "text",
    query_ident: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """``query``, ``rank``, ``id`` and ``score`` of the ``k`` best documents of each query."""
    rows = docs.select(column(ident).cast("long").alias("id"), column(text).cast("string").alias("text")).where("id is not null")
    # The bytes before each query tell its block; blocks never part the rows of an id.
    wanted = queries.select(column(query_ident).cast("long").alias("id"), column(query_text).cast("string").alias("text"))
    wanted = stored(wanted.where("id is not null"))
    size = wanted.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-size["n"] // QUERIES), -(-size["bytes"] // QUERY_BYTES))
    results = []
    for part in range(parts):
        some = wanted.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).distinct().collect()
        if some:
            found = _searched(rows, some, k)
            results.append(stored(found) if parts > 1 else found)
    if not results:
        return rows.selectExpr("id as query", "0 as rank", "id", "id as score").where("false")
    found = results[0]
    for more in results[1:]:
        found = found.unionAll(more)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "id", "score")
