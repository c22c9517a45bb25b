"""Boilerplate lines: lines that are spread over many distinct sites are removed.

Per line hash a HyperLogLog sketch of the sites it occurs on is built in each task and
merged by the shuffle, so that a line that every page of a site carries is one row per
task. Where the estimate is so near to the threshold that the sketch may be wrong, the
distinct sites are counted exactly. Lines at or over ``min_sites`` are boilerplate and go
from all documents, but for documents that would lose all their words: those are whole
copies, not pages with boilerplate, and stay as they are for a later near-duplicate step.

A line is compared by its words, whatever the white space around them. Lines with fewer than
``min_words`` words are left out; the queries ask for 1, so that only lines without words are. Lines that stay keep their
white space.

Nulls: a null text stays null; a null site is a site of its own. Texts are split whole.
Equal rows are treated alike; rows of one id share the lists of lines to remove, which are
the same wherever a line stands. An empty table gives an empty result. Further columns
pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, stored

MIN_SITES = 10
MIN_WORDS = 4
#: The sketch has 2**LG_REGISTERS registers, for a relative error of about 1.04 / sqrt of that.
LG_REGISTERS = 10
#: Estimates within this share of the threshold, three times the error, are counted exactly.
NEAR = 0.1


def line_code(line: Column, min_words: int = MIN_WORDS) -> Column:
    """Hash of the words of a line; null if it has fewer than ``min_words``."""
    spaced = F.btrim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))
    enough = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) >= min_words - 1
    return F.when(enough & (spaced != ""), F.xxhash64(spaced))


def occurrences(docs: DataFrame, ident: str, text: str, site: str, min_words: int = MIN_WORDS) -> DataFrame:
    """``ident``, ``site`` and ``code`` of each line, once per document."""
    codes = F.array_distinct(F.filter(F.transform(F.split(column(text), "\n"), lambda line: line_code(line, min_words)), lambda c: c.isNotNull()))
    named = F.coalesce(F.concat(F.lit("+"), column(site).cast("string")), F.lit("-"))
    return docs.select(column(ident).alias("ident"), named.alias("site"), F.explode(codes).alias("code"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The ``code`` of lines on ``min_sites`` distinct sites or more."""
    spread = lines.groupBy("code").agg(F.hll_sketch_agg("site", LG_REGISTERS).alias("sketch"))
    spread = stored(
        spread.select("code", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - NEAR) - 1)
    )
    near = spread.where(F.col("sites") <= min_sites * (1 + NEAR) + 1).select("code")
    exact = (
        lines.join(near, "code").groupBy("code", "site").agg(F.lit(1)).groupBy("code").agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    sure = spread.where(F.col("sites") > min_sites * (1 + NEAR) + 1)
    return sure.select("code").unionByName(exact.select("code"))


def removals(docs: DataFrame, ident: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``ident`` and the ``codes`` of the boilerplate lines it holds, for documents with any."""
    lines = stored(occurrences(docs, ident, text, site, min_words))
    found = stored(boilerplate(lines, min_sites))
    return lines.join(found, "code").groupBy("ident").agg(F.collect_set("code").alias("codes"))


def cleaned(docs: DataFrame, ident: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``row`` (all columns), the ``clean`` text and ``n_removed``, the number of removed lines."""
    lists = removals(docs, ident, text, site, min_sites, min_words)
    rows = docs.select(packed(docs), column(ident).alias("own"), column(text).alias("t"))
    rows = rows.join(lists, F.col("own").eqNullSafe(F.col("ident")), "left")
    left = F.filter(F.split("t", "\n"), lambda line: ~F.coalesce(F.array_contains("codes", line_code(line, min_words)), F.lit(False)))
    rows = rows.withColumn("left", F.when(F.col("codes").isNotNull(), left))
    rows = rows.withColumn("short", F.array_join("left", "\n"))
    # A document without any words left is a whole copy.
    cut = F.col("left").isNotNull() & F.col("short").rlike(r"[^\x20\x09-\x0D]")
    return rows.select(
        "row",
        F.when(cut, F.col("short")).otherwise(F.col("t")).alias("clean"),
        F.when(cut, F.size(F.split("t", "\n")) - F.size("left")).otherwise(0).cast("long").alias("n_removed"),
    )


def without_boilerplate(docs: DataFrame, ident: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """The documents with their own columns and the clean text."""
    rows = cleaned(docs, ident, text, site, min_words=1)
    return rows.select(
        *[(F.col("clean") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns]
    )
