"""Writers of FASTA, BED, CSV, TSV, AGP and JSON, and the rows that they write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bed_rows(gaps: DataFrame) -> DataFrame:
    return gaps.select(F.col("seq_id").alias("chrom"), "start", "end", F.concat(F.lit("gap_"), "seq_id", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string")).alias("name"), F.col("length").alias("score"), F.lit(".").alias("strand"))


def gap_csv_rows(gaps: DataFrame) -> DataFrame:
    return gaps.select(F.col("seq_id").alias("chromosome"), F.col("start").alias("start_0based"), F.col("end").alias("end_0based"), (F.col("start") + 1).alias("start_1based"), F.col("end").alias("end_1based"), "length")


def gap_rows(gaps: DataFrame) -> DataFrame:
    """Gaps with names that count them within their sequence."""
    n = F.row_number().over(Window.partitionBy("seq_id").orderBy("start", "end"))
    return gaps.select("seq_id", "start", "end", F.concat(F.lit("gap_"), n.cast("string")).alias("name"))


def fragment_rows(frags: DataFrame) -> DataFrame:
    """Fragments (with status) as their file has them."""
    return frags.select("seq_id", "start", "end", "status", "length")


def fasta_lines(chunks: DataFrame, width: int = 80) -> DataFrame:
    """chunks (seq_ord, seq_id, chunk_ix, bases) on a grid that `width` divides -> one text row a chunk, in order.

    Each range has whole sequences, so that no file begins within a record; a task streams their chunks."""
    head = F.when(F.col("chunk_ix") == 0, F.concat(F.lit(">"), "seq_id", F.lit("\n"))).otherwise("")
    lines = F.regexp_replace(F.regexp_replace("bases", "(.{%d})" % width, "$1\n"), "\n$", "")
    return chunks.repartitionByRange("seq_ord", "seq_id").sortWithinPartitions("seq_ord", "seq_id", "chunk_ix").select(F.concat(head, lines).alias("value"))


def write_fasta(chunks: DataFrame, path: str, width: int = 80) -> None:
    fasta_lines(chunks, width).write.text(path)


def write_fasta_files(chunks: DataFrame, path: str, by: str, name: str, width: int = 80) -> None:
    """One FASTA file for each value of column `by`, as {path}/{by}={value}/{base}-....{extension} with name's base and extension.

    A file is one task's rows, a chunk each, sorted on disk where they don't fit."""
    base, extension = name.rsplit(".", 1)
    head = F.when(F.col("chunk_ix") == 0, F.array(F.concat(F.lit(">"), "seq_id"))).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(F.regexp_replace("bases", "(.{%d})" % width, "$1\n"), "\n"), lambda x: x != "")
    rows = chunks.repartition(by).sortWithinPartitions(by, "seq_ord", "chunk_ix").select(by, F.explode(F.concat(head, lines)).alias("value"))
    # a line is a row of one column, so that the writer's options for extension and base name serve
    rows.write.option("mapreduce.output.basename", base).option("extension", extension).option("sep", "\x01").option("quote", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").partitionBy(by).csv(path)


def write_tsv(rows: DataFrame, path: str, header: bool = False) -> None:
    rows.write.option("sep", "\t").option("header", header).csv(path)


def write_report(rows: DataFrame, path: str) -> None:
    rows.write.json(path)


def gap_report(gaps: DataFrame) -> DataFrame:
    """A nested row a sequence: seq_id, summary, and its gaps in order (coordinates only)."""
    at = F.sort_array(F.collect_list(F.struct("start", "end", "length")))
    return gaps.groupBy("seq_id").agg(F.struct(F.count("*").alias("n_gaps"), F.sum("length").alias("total")).alias("summary"), at.alias("gaps"))
