"""Writing results as text, and flights as a table partitioned by year.

Results are written beside the old ones and take their place when they are complete, so a write that fails
leaves what was there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import tuple_line
from tarmac.operators.filters import YEAR_LENGTH
from tarmac.sources.scratch import file_system

COPY_BYTES = 1 << 20


def replaced(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder beside ``path``, which then takes its place.

    If writing fails, the new folder goes and ``path`` stays as it was. The change of places is two renames: a driver
    lost between them leaves the old result in a folder ``.old-*`` beside ``path``, and none in ``path``. Names
    with a point in front are passed over by readers. Where renaming copies, as in object stores, it is not cheap.
    """
    files, target = file_system(spark, path)
    target = files.makeQualified(target)
    name = uuid.uuid4().hex
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{kind}-{name}") for kind in ("new", "old"))
    files.mkdirs(target.getParent())
    try:
        write(new.toString())
    except BaseException:
        files.delete(new, True)
        raise
    had = files.exists(target)
    if had and not files.rename(target, old):
        files.delete(new, True)
        raise OSError(f"cannot move {path}")
    if not files.rename(new, target):
        if had:
            files.rename(old, target)
        raise OSError(f"cannot replace {path}; the new result is in {new.toString()}")
    if had:
        files.delete(old, True)


def tuple_lines(result: DataFrame) -> DataFrame:
    """One text column ``line`` holding ``(a,b,c)`` per row."""
    return result.select(tuple_line(*[F.col(c) for c in result.columns]).alias("line"))


def write_tuple_text(
    result: DataFrame, path: str, single_file: bool = False, order_by: list[str | Column] | None = None
) -> None:
    """Write a result as text lines, replacing what is there, in the result's order.

    A sorted result, or one with ``order_by``, is in order across its files too. ``single_file`` puts these files
    together in one, see :func:`put_together`; no task holds more than its own part.
    """
    if order_by:
        result = result.orderBy(*order_by)
    lines, spark = tuple_lines(result), result.sparkSession

    def write(folder: str) -> None:
        if single_file:
            lines.write.text(f"{folder}/_parts")
            put_together(spark, f"{folder}/_parts", f"{folder}/part-00000.txt")
        else:
            lines.write.text(folder)

    replaced(spark, path, write)


def put_together(spark: SparkSession, folder: str, target: str) -> None:
    """One file of the part files of a folder, in their order; the folder goes.

    HDFS joins them without moving a byte. Elsewhere the driver copies them one after the other, a buffer at a time.
    """
    files, source = file_system(spark, folder)
    _, out = file_system(spark, target)
    parts = sorted((s.getPath() for s in files.listStatus(source) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    if files.getScheme() == "hdfs" and len(parts) > 1:
        files.rename(parts[0], out)
        others = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
        for i, part in enumerate(parts[1:]):
            others[i] = part
        files.concat(out, others)
    else:
        to = files.create(out, True)
        try:
            for part in parts:
                data = files.open(part)
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, to, COPY_BYTES, False)
                finally:
                    data.close()
        finally:
            to.close()
    files.delete(source, True)


def write_flights_by_year(flights: DataFrame, path: str, replace: str = "table") -> None:
    """Write flights as parquet in one folder per year, so that a report on a year reads only that.

    The rebalance hint gathers each year into files of a good size and cuts years that are
    larger than that into several. ``replace="years"`` replaces the years that the flights are of and leaves the files
    of all others as they are; ``"table"`` replaces all.
    """
    dated = flights.withColumn("flight_year", F.substring("flight_date", 1, YEAR_LENGTH)).hint("rebalance", "flight_year")
    if replace == "years":
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("flight_year").parquet(path)
    elif replace == "table":
        replaced(flights.sparkSession, path, lambda folder: dated.write.partitionBy("flight_year").parquet(folder))
    else:
        raise ValueError(f"replace must be 'table' or 'years', not {replace!r}")
