"""The corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's docs; all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwright.llm.decontaminate import decontaminated
from gapwright.llm.lines import stripped
from gapwright.llm.minhash import near_duplicates
from gapwright.llm.packing import pack
from gapwright.llm.rules import kept_documents
from gapwright.llm.shared import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; n_chars follows the text. Copied documents keep theirs for the next stage."""
    found = stripped(docs, most_share=0.5)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*(changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates (five words, 0.8); all without an id."""
    dropped = staged(near_duplicates(docs, words=5, percent=80).where("not kept").select("doc_id").distinct())
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contaminate no benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences; ids as their checksum."""
    return pack(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The near-duplicate and packing stages can't be expressed in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs)
    return docs
