"""Lines and quoted records of text files that are read in splits, in parallel.

What comes first in a file, and whether a split begins inside quotes, follows from the place of lines: the
split's offset in its file, and the order of lines in their task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType

FILE = "_metadata.file_path"
START = "_metadata.file_block_start"
QUOTE = '"'


@pandas_udf(BooleanType())
def _first_of_run(numbers: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Whether a number other than zero differs from the one before, through all batches of a task."""
    before = 0
    for batch in numbers:
        n = batch.to_numpy()
        last = np.concatenate([[before], n[:-1]])
        before = n[-1] if len(n) else before
        yield pd.Series((n != 0) & (n != last))


# Never moved past a filter, which would change what comes before a line.
first_of_run = _first_of_run.asNondeterministic()


def lines_below_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``line``: all lines but the first of each file, as they are, blank ones too.

    Python sees one number per line, never the text: a file's own number in its first split, else zero. The
    first line of a run of such numbers is the file's first. A file that is listed twice is read twice.
    """
    paths = [path] if isinstance(path, str) else path
    # One after the other, so that two readings of a file never follow each other in a task.
    rounds = [[p for p in dict.fromkeys(paths) if paths.count(p) > i] for i in range(max(map(paths.count, paths)))]
    readings = [_below_headers(spark.read.text(some)) for some in rounds]
    lines = readings[0]
    for more in readings[1:]:
        lines = lines.unionAll(more)
    return lines


def _below_headers(text: DataFrame) -> DataFrame:
    own = F.when(F.col(START) == 0, F.xxhash64(FILE).bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    placed = text.select(F.col("value").alias("line"), own.alias("own"))
    return placed.withColumn("is_header", first_of_run("own")).where(~F.col("is_header")).select("line")


# Quoted records


def quoted_records(spark: SparkSession, path: str | list[str], header: bool) -> DataFrame:
    """``line``: the records of CSV files whose quoted fields may hold line breaks.

    A line break ends a record if an even number of quotes stands before it in the file. A first reading counts the
    quotes of each split; their running sum tells which splits begin inside quotes. That is one number per split,
    kept by the driver. In the second reading each task puts the lines of its splits together; the ends of records
    that reach over splits are joined by their place. A file is never read by one task. Records end at ``\\n`` or ``\\r\\n``;
    a quote that is never closed takes all up to the end of its file. The first record of a file is its header.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))
    lines = text.select(F.xxhash64(FILE).alias("file"), F.col(START).alias("start"), (quotes % 2 == 1).alias("odd"), F.col("value").alias("line"))
    splits = _splits(lines)
    pieces = lines.mapInArrow(_assembled(spark.sparkContext.broadcast(splits), header), "line string, file long, start long, opens boolean, dropped boolean")
    whole = pieces.where("file is null").select("line")
    if not any(inside for inside, _ in splits.values()):
        return whole
    return whole.unionAll(_joined(pieces.where("file is not null")))


def _splits(lines: DataFrame) -> dict[tuple[int, int], tuple[bool, bool]]:
    """For each split, by file and offset, whether it begins inside quotes and whether it is the last of its file."""
    odd = lines.groupBy("file", "start").agg((F.count_if("odd") % 2).alias("odd"))
    order = Window.partitionBy("file").orderBy("start")
    inside = (F.sum("odd").over(order) - F.col("odd")) % 2 == 1
    rows = odd.select("file", "start", inside.alias("inside"), F.lead("start").over(order).isNull().alias("last")).collect()
    return {(r["file"], r["start"]): (r["inside"], r["last"]) for r in rows}


def _assembled(splits, header: bool):
    """Turns the lines of splits into whole records, and into pieces of records that begin or end in another split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        inside = first = last = False
        held: list[str] = []  # lines of the record that is not complete yet
        is_tail = False  # it began in an earlier split

        def piece(line: str, whole: bool, opens: bool, dropped: bool) -> pa.RecordBatch:
            file, start = (None, None) if whole else at
            values = zip(SCHEMA, [[line], [file], [start], [opens], [dropped]])
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for f, v in values], schema=SCHEMA)

        def closed() -> Iterator[pa.RecordBatch]:
            """The split has ended."""
            if held:
                line = "\n".join(held)
                if is_tail:
                    yield piece(line, False, False, False)
                elif inside and not last:
                    yield piece(line, False, True, first)
                elif not first:
                    yield piece(_ended(line), True, False, False)

        for batch in batches:
            files, starts = (batch.column(c).to_numpy() for c in ("file", "start"))
            cuts = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1 if len(files) else []
            for a, b in zip([0, *cuts], [*cuts, len(files)]):
                if a == b:
                    continue
                here = (int(files[a]), int(starts[a]))
                if here != at:
                    yield from closed()
                    held, at = [], here
                    if at not in splits.value:
                        raise RuntimeError("the files were split in another way than when their quotes were counted; read them again")
                    inside, last = splits.value[at]
                    first, is_tail = header and at[1] == 0, inside
                odd = batch.column("odd").slice(a, b - a).to_numpy(zero_copy_only=False)
                before = (np.cumsum(odd) - odd + inside) % 2 == 1
                lines = batch.column("line").slice(a, b - a)
                begins = np.append(np.flatnonzero(~before), len(before))
                # What comes before the first beginning belongs to the record held.
                held += lines.slice(0, int(begins[0])).to_pylist()
                inside = bool((odd.sum() + inside) % 2)
                if begins[0] == len(before):
                    continue
                if held:
                    line = "\n".join(held)
                    if is_tail:
                        yield piece(line, False, False, False)
                    elif not first:
                        yield piece(_ended(line), True, False, False)
                    first = False
                is_tail = False
                held = lines.slice(int(begins[-2])).to_pylist()
                records = _between(lines, begins[:-1])
                if first and len(records):
                    records, first = records[1:], False
                if records:
                    none = pa.nulls(len(records), pa.int64())
                    no = pa.array(np.zeros(len(records), bool))
                    yield pa.RecordBatch.from_arrays([pa.array(records, pa.string()), none, none, no, no], schema=SCHEMA)
        if at is not None:
            yield from closed()

    return run


SCHEMA = pa.schema([("line", pa.string()), ("file", pa.int64()), ("start", pa.int64()), ("opens", pa.bool_()), ("dropped", pa.bool_())])


def _ended(line: str) -> str:
    return line.removesuffix("\r")


def _between(lines: pa.Array, begins: np.ndarray) -> list[str]:
    """The records from each beginning to the next."""
    texts = lines.slice(0, int(begins[-1])).to_pylist()
    if len(begins) - 1 == len(texts) - (begins[0] if len(begins) > 1 else len(texts)):
        return [_ended(t) for t in texts[int(begins[0]) :]]
    return [_ended("\n".join(texts[a:b])) for a, b in zip(begins.tolist(), begins[1:].tolist())]


def _joined(pieces: DataFrame) -> DataFrame:
    """Records of pieces in several splits: each piece that opens a record, with all that follow up to the next such."""
    order = Window.partitionBy("file").orderBy("start", "opens")
    numbered = pieces.withColumn("record", F.sum(F.col("opens").cast("int")).over(order))
    parts: Column = F.array_sort(F.collect_list(F.struct("start", "opens", "line")))
    # A piece that opens a record is the last of its split, so it comes first among its own.
    text = F.array_join(F.transform(parts, lambda p: p["line"]), "\n")
    joined = numbered.groupBy("file", "record").agg(text.alias("line"), F.bool_or("dropped").alias("dropped"))
    return joined.where(~F.col("dropped")).select(F.regexp_replace("line", "\r$", "").alias("line"))
