"""Training corpus from raw documents: language ID, quality rules, near-duplicate removal, packing.

Each stage takes what the one before kept, as a written Parquet table, and its decisions take effect: rejected documents are
gone from its result. All but the last return the columns of ``documents``; the last returns the pieces of the packed
sequences with their token ids. SQL cannot express any of the stages, so there is no ORACLE_SQL; the tests compare
the whole with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from godown.llm.lang_fusion import keep_identified
from godown.llm.mcd_quality import quality_filter
from godown.llm.ngram_jaccard import first_of_components
from godown.llm.ordered_pack import pack_ordered
from godown.session import cut_lineage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus languages; text, declared language and source are the evidence (3)."""
    return keep_identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source (2)."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by word shingles (5)."""
    return first_of_components(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens, in the order of the documents (9)."""
    return pack_ordered(docs)


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents under ``sf_dir``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
