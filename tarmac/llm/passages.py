"""Repeated passages: units of text are hashed, and all but the earliest occurrence removed.

Units are sentences within lines, since passages also stand in the middle of lines; a line
or paragraph is the run of its units. Normalised units (case, punctuation and white space do not count)
are digested, digests are grouped over the corpus, and the occurrence with the lowest document
id and offset stays. Of the others only passages go: runs of repeated units of one document with
``min_words`` words together, so that stock sentences and headings stay. Units of fewer than
``SHORT`` words are too common to tell anything; they go with a run that goes on behind them.

Results keep the original offsets: removed spans are given in code points of the
original text, end exclusive. Rows are told apart by id: rows of one id count as one document.
Nulls: a null text stays null, a null id is an id of its own and comes first. Texts are
handled whole. An empty table gives an empty result. Further columns pass through in ``row``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, stored

MIN_WORDS = 25
SHORT = 4
# Up to a sign that ends a sentence and other signs, with white space or nothing after them, or to the end of the line.
# Of a run of signs that end sentences only the first is tried, with all signs behind it, as none of the others can do better.
SENTENCE = re.compile(r"[^\n]*?(?<![.!?])[.!?][^\w\s]*+(?=\s|$)|[^\n]+")
PLAIN = re.compile(r"[^\w]+")


def units_of(text: str) -> list[tuple[int, int, int, int]]:
    """Start, end, number of words and digest of each unit; the digest of short units is 0."""
    result = []
    for m in SENTENCE.finditer(text):
        words = m[0].split()
        if not words:
            continue
        plain = PLAIN.sub("", m[0].casefold())
        digest = int.from_bytes(blake2b(plain.encode(), digest_size=8).digest(), "little", signed=True) if len(words) >= SHORT else 0
        result.append((m.start(), m.end(), len(words), digest))
    return result



def unit_rows(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """``ident``, ``place`` (number of the unit in its text) and ``digest`` of units that are not short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column("text")):
                units = units_of(t.as_py() or "")
                digests = np.array([u[3] for u in units], np.int64)
                places = np.flatnonzero(digests)
                own = pa.concat_arrays([batch.column("ident").slice(i, 1)]).take(pa.array(np.zeros(len(places), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(places, pa.int32()), pa.array(digests[places], pa.int64())], ["ident", "place", "digest"]
                )

    rows = docs.select(column(ident).alias("ident"), column(text).alias("text"))
    kind = rows.schema["ident"].dataType.simpleString()
    return rows.mapInArrow(run, f"ident {kind}, place int, digest long")


def repeated(units: DataFrame) -> DataFrame:
    """``ident`` and ``places`` of its units that occur earlier elsewhere or in the document."""
    own = F.struct(F.col("ident"), F.col("place"))
    first = (
        units.groupBy("digest").agg(F.min(own).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    later = units.join(first, "digest").where(~own.eqNullSafe(F.col("first")))
    return later.groupBy("ident").agg(F.collect_set("place").alias("places"))


def spans_to_remove(text: str, places: list[int], min_words: int) -> list[tuple[int, int]]:
    """Spans of runs of repeated units with ``min_words`` words or more."""
    units, seen = units_of(text), set(places)
    spans, run = [], []

    def end(run: list[int]) -> None:
        while run and units[run[-1]][3] == 0:
            run.pop()
        if sum(units[k][2] for k in run) >= min_words:
            spans.append((units[run[0]][0], units[run[-1]][1]))

    for k, unit in enumerate(units):
        if k in seen or (run and unit[3] == 0):
            run.append(k)
        else:
            end(run)
            run = []
    end(run)
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    parts, at = [], 0
    for start, stop in spans:
        parts.append(text[at:start])
        at = stop
    return "".join([*parts, text[at:]])


def deduplicated(docs: DataFrame, ident: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``row`` (all columns), the ``clean`` text, ``removed`` (spans as ``start:stop`` joined by
    commas, empty if none) and ``n_removed``, the number of removed spans."""
    units = stored(unit_rows(docs, ident, text))
    lists = repeated(units)
    rows = docs.select(packed(docs), column(ident).alias("own"), column(text).alias("text"))
    rows = rows.join(lists, F.col("own").eqNullSafe(F.col("ident")), "left").select("row", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, counts = [], [], []
            for t, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                spans = spans_to_remove(t, places, min_words) if t and places else []
                texts.append(without(t, spans) if spans else t)
                removed.append(",".join(f"{a}:{b}" for a, b in spans))
                counts.append(len(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(removed, pa.string()), pa.array(counts, pa.int64())],
                ["row", "clean", "removed", "n_removed"],
            )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, clean string, removed string, n_removed long")
