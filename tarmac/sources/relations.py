"""Reading the relations from CSV or parquet, at any path Spark can read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.model import Relation
from tarmac.sources.lines import lines_below_headers, quoted_records


def read_relation(
    spark: SparkSession,
    path: str | list[str],
    relation: Relation,
    columns: list[str] | None = None,
    quoted: bool = False,
    header: bool = True,
    dropped: Observation | None = None,
) -> DataFrame:
    """Read a relation from CSV files, with a header line each unless ``header`` is off.

    Lines with too few fields for the wanted columns are dropped, further fields are
    ignored, and an empty field is ``''``. So a line that ends early is still read if only
    its first columns are wanted. Quotes are ordinary characters unless ``quoted``, which
    takes a field in quotes as it stands there, with commas and line breaks, two quotes being one.

    Lines are read whole, as they are, and then split, because the CSV reader's own handling of bad
    lines also drops lines that are too long or blank and changes with the columns wanted.

    ``dropped`` observes the number of ``lines`` and that of ``dropped`` ones, in the same pass, for the first action on the
    result. Tasks that failed or ran twice count once; a stage that is run again after losing an executor may count again.
    """
    wanted = relation.position_of(columns)
    last = max(wanted.values())
    if quoted:
        lines = quoted_records(spark, path, header)
        complete = _has_commas(F.regexp_replace("line", '"[^"]*"', ""), last)
        fields = F.from_csv("line", ", ".join(f"_{i} string" for i in range(last + 1)), {"escape": '"'})
        picked = [F.coalesce(F.col(f"fields._{i}"), F.lit("")).alias(name) for name, i in wanted.items()]
    else:
        lines = lines_below_headers(spark, path) if header else spark.read.text(path).select(F.col("value").alias("line"))
        complete = _has_commas(F.col("line"), last)
        fields = F.split("line", ",", -1)
        picked = [F.get("fields", F.lit(i)).alias(name) for name, i in wanted.items()]
    if dropped is not None:
        lines = lines.observe(dropped, F.count("*").alias("lines"), F.count_if(~complete).alias("dropped"))
    return lines.where(complete).select(fields.alias("fields")).select(*picked)


def _has_commas(text: Column, n: int) -> Column:
    """Whether there are at least ``n`` commas, without splitting the text.

    ``substring_index`` cuts before the n-th comma, and returns the whole text if there is none.
    """
    return F.substring_index(text, ",", n) != text if n else F.lit(True)


def read_parquet(
    spark: SparkSession, path: str, relation: Relation, columns: list[str] | None = None
) -> DataFrame:
    """Read a relation from parquet with the relation's column names.

    Folder names of years are read as text; as numbers, a year that is none would not compare.
    """
    table = spark.read.parquet(path)
    if "flight_year" in table.columns:
        names = [StructField(f.name, StringType() if f.name == "flight_year" else f.dataType) for f in table.schema]
        table = spark.read.schema(StructType(names)).parquet(path)
    extra = [c for c in ("flight_year",) if c in table.columns]
    return table.select(*(columns or relation.columns), *extra)
