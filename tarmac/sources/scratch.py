"""Files that a query writes in order to read them back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.model import Relation


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as one of its own."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def scratch_folder(spark: SparkSession) -> str:
    """A new path in the cluster's shared checkpoint folder, gone when the driver ends.

    Only a local session without one gets a temporary folder; executors on other machines
    could not read that.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        shared = tempfile.mkdtemp(prefix="tarmac-")
    folder = f"{shared}/tarmac-{uuid.uuid4()}"
    files, path = file_system(spark, folder)
    # The folder has to be there to be put down for deletion when the driver ends.
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/data"


def kept(rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder and read back, so that jobs that follow do not work them out again."""
    path = scratch_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_csv_lines(rows: DataFrame, relation: Relation, path: str, header: bool = True, quoted: bool = False) -> None:
    """Write a relation as CSV files, with a header line each or without, in the relation's column positions.

    About half of the lines carry further fields, and each line of the other half is followed by a
    copy that ends before the last column; reading must keep the former and drop the latter. ``quoted`` puts
    all fields in quotes, which may then hold commas, quotes and line breaks; such files have no header.
    """
    width = max(relation.positions) + 1
    fields = [F.col(relation.positions[i]) if i in relation.positions else F.lit("-") for i in range(width)]
    if quoted:
        fields = [F.concat(F.lit('"'), F.replace(f, F.lit('"'), F.lit('""')), F.lit('"')) for f in fields]
    whole = F.concat_ws(",", *fields)
    longer = F.concat(whole, F.lit(",more,fields"))
    shorter = F.concat_ws(",", *fields[:-1])
    is_long = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 0
    lines = rows.select(F.explode(F.when(is_long, F.array(longer)).otherwise(F.array(whole, shorter))).alias("line"))
    if not header:
        lines.write.text(path)
        return
    # The writer's header is the name of the one column; a separator that no line holds and no quoting leave lines as they are.
    lines.write.options(header=True, sep="\u0001", quote="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
