"""From raw documents to training tokens, in stages that are each written and read again.

``STAGES`` names the stages in order. Each takes the documents that the one before kept;
all but the last return documents with their own columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import lines, mixing, ngrams, pieces, quality
from tarmac.llm.common import stored
from tarmac.llm.queries import table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a quality rule go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are spread over many sources go from the texts."""
    return lines.without_boilerplate(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return ngrams.one_of_each(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the target weights of their sources ask for."""
    return mixing.mixed(docs, F.array("source"), seed=11)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts of the documents, with digests of their ids and of the decoded text."""
    rows = pieces.round_trip_digests(docs.select("doc_id", "text"), tokenizer_path())
    return rows.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mixing_sources),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: Pruned joins, the mix and the tokens are not SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stage's result written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
