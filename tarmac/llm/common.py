"""What several operators need."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.sources.scratch import scratch_folder

def stored(rows: DataFrame) -> DataFrame:
    """Write rows as parquet in the cluster's shared folder and read them back.

    Cuts the lineage: later jobs read the files, also after an executor is lost.
    """
    path = f"{scratch_folder(rows.sparkSession)}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def column(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def packed(rows: DataFrame) -> Column:
    """All columns as one struct ``row``, so that no helper column can clash with one of them."""
    return F.struct(*[column(c) for c in rows.columns]).alias("row")


def small_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str, most_rows: int = 20_000) -> DataFrame:
    """Join with a stored table, which is broadcast only if it is counted to have ``most_rows`` rows at most."""
    fits = table.count() <= most_rows
    return rows.join(F.broadcast(table) if fits else table, keys, how)


def word_array(text: Column) -> Column:
    """The words of a text; none for null.

    The words are cut at blanks, after the rarer kinds of white space have become blanks,
    which is faster than a pattern for all of them.
    """
    t = F.coalesce(text, F.lit(""))
    spaced = F.replace(t, F.lit("\n"), F.lit(" "))
    spaced = F.when(t.rlike(r"[\x09\x0B-\x0D]"), F.translate(spaced, "\t\x0b\x0c\r", "    ")).otherwise(spaced)
    return F.array_remove(F.split(spaced, " "), "")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of rows with equal keys, from batches in which such rows stand together."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            name = tuple(c[a] for c in columns)
            if held and name != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = name
    if held:
        yield pa.Table.from_batches(held)


def text_chunks(texts: pa.Array, size: int) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in turn, about ``size`` bytes at a time, with the place of the first; null is empty."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = upto[start - 1] if start else 0
        stop = min(len(texts), int(np.searchsorted(upto, before + size)) + 1)
        yield start, [t or "" for t in texts.slice(start, stop - start).to_pylist()]
        start = stop
