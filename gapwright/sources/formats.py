"""Readers of sequence, alignment and assembly files. All are DataFrame readers; nothing is read on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.gaps import GRID, HALO


def read_fasta(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """sample (file name), seq_ord, seq_id, description, bases (upper case) of FASTA files.

    A record is what a line break and '>' end. seq_ord follows the file's order within a file."""
    reader = spark.read.option("lineSep", "\n>").option("recursiveFileLookup", str(recursive).lower())
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    rows = reader.text(path).select("value", F.col("_metadata.file_name").alias("sample"), (F.col("_metadata.file_block_start")).alias("block"), F.monotonically_increasing_id().alias("at"))
    record = F.regexp_replace("value", "^>", "")
    head = F.split_part(record, F.lit("\n"), F.lit(1))
    bases = F.upper(F.translate(F.regexp_replace(record, r"^[^\n]*\n?", ""), "\n\r \t", ""))
    head = F.trim(F.translate(head, "\r", ""))
    return rows.where("trim(value) <> ''").select("sample", F.col("at").alias("seq_ord"), F.split_part(head, F.lit(" "), F.lit(1)).alias("seq_id"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"), bases.alias("bases"))


def read_fasta_chunks(spark: SparkSession, path: str, grid: int = GRID, glob: str | None = None, halo: int = HALO) -> DataFrame:
    """sample, record, seq_id, description, chunk_ix, start, bases, more of FASTA files, cut on a grid by lines: no record is ever in one
    row. A line's bases go to their chunk, and those of a chunk's first `halo` also to the one before (as its `more`).

    A file's blocks are read apart; what a line belongs to follows from the headers and bases counted in the blocks before it."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("sample"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")]
    lines = reader.text(path).select(F.regexp_replace("value", r"\s+$", "").alias("line"), *at).where("line <> ''")
    head = F.col("line").startswith(">")
    w = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    size = F.when(head, 0).otherwise(F.length("line"))
    # bases since the block began, and what they were at the last header
    own = lines.withColumn("n_heads", F.count(F.when(head, 1)).over(w)).withColumn("upto", F.sum(size).over(w)).withColumn("mark", F.last(F.when(head, F.col("upto")), ignorenulls=True).over(w))
    per = own.groupBy("file", "block").agg(F.max("n_heads").alias("heads"), F.max("upto").alias("bases"), F.max("mark").alias("mark"))
    over = Window.partitionBy("file").orderBy("block")  # a row for each block
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    # bases since the last header of all blocks before: all so far, less all up to that header
    per = per.withColumn("all_upto", F.sum("bases").over(over)).withColumn("last_mark", F.when(F.col("mark").isNotNull(), F.col("all_upto") - F.col("bases") + F.col("mark")))
    per = per.select("file", "block", F.coalesce(F.sum("heads").over(before), F.lit(0)).alias("heads0"), F.coalesce(F.last("all_upto").over(before), F.lit(0)).alias("all0"), F.coalesce(F.last("last_mark", ignorenulls=True).over(before), F.lit(0)).alias("mark0"))
    j = own.join(per, ["file", "block"]).withColumn("record", F.col("heads0") + F.col("n_heads"))
    begin = F.when(F.col("mark").isNotNull(), F.col("upto") - F.col("mark")).otherwise(F.col("all0") + F.col("upto") - F.col("mark0")) - F.length("line")
    title = F.trim(F.substring("line", 2, 1 << 20))
    names = j.where(head).select("file", "sample", "record", F.split_part(title, F.lit(" "), F.lit(1)).alias("seq_id"), F.trim(F.regexp_replace(title, r"^\S+", "")).alias("description"))
    pieces = j.where(~head).select("file", "record", begin.alias("begin"), F.upper(F.regexp_replace("line", r"\s", "")).alias("piece"))
    cut = pieces.select("*", F.explode(F.expr(f"sequence(greatest(0, begin - {halo}) div {grid}, (begin + length(piece) - 1) div {grid})")).alias("chunk_ix"))
    lo, hi = F.greatest("begin", F.col("chunk_ix") * grid), F.least(F.col("begin") + F.length("piece"), (F.col("chunk_ix") + 1) * grid + halo)
    cut = cut.withColumn("lo", lo).withColumn("hi", hi).select("file", "record", "chunk_ix", "lo", F.expr("substring(piece, cast(lo - begin + 1 as int), cast(hi - lo as int))").alias("part"))
    whole = cut.groupBy("file", "record", "chunk_ix").agg(F.sort_array(F.collect_list(F.struct("lo", "part"))).alias("p"))
    whole = whole.withColumn("long", F.array_join(F.transform("p", lambda x: x["part"]), ""))
    return whole.join(names, ["file", "record"]).select("sample", "record", "seq_id", "description", F.col("chunk_ix").cast("int").alias("chunk_ix"), (F.col("chunk_ix") * grid).alias("start"), F.substring("long", 1, grid).alias("bases"), F.substring("long", grid + 1, halo).alias("more"))


def fasta_dir_summary(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """sample, n_sequences, n_bases, ok for each FASTA file of a folder; a file without a sequence, or with one that has no bases, isn't ok."""
    r = read_fasta(spark, path, glob, recursive)
    return r.groupBy("sample").agg(F.count("*").alias("n_sequences"), F.sum(F.length("bases").cast("bigint")).alias("n_bases"), F.bool_and((F.col("seq_id") != "") & (F.col("bases") != "")).alias("ok"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """path, length of files; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").where("path not rlike '/[._][^/]*$'")


def parse_coords(lines: DataFrame) -> DataFrame:
    """lines (value) of a coords file -> alignment rows; headers, short and bad lines are dropped.

    The separators '|' vanish; the fields stand at fixed places: S1 E1 S2 E2 LEN1 LEN2 IDY [LENR LENQ] REF QRY."""
    skip = F.col("t").rlike(r"^(/|NUCMER|\[|=)") | (F.col("t") == "")
    # exploding the one value has it computed once: a filter on a mere column would be pushed below and compute it anew for each use
    once = lambda c, a: F.explode(F.array(c)).alias(a)
    x = lines.select(once(F.trim("value"), "t")).where(~skip).select(once(F.split(F.trim(F.translate("t", "|", " ")), r"\s+"), "f")).where(F.size("f") >= 9)
    f = lambda i, t: F.expr(f"try_cast(try_element_at(f, {i}) as {t})")
    out = x.select(f(1, "bigint").alias("ref_start"), f(2, "bigint").alias("ref_end"), f(3, "bigint").alias("query_start"), f(4, "bigint").alias("query_end"), f(5, "bigint").alias("len1"), f(6, "bigint").alias("len2"), f(7, "double").alias("identity"), F.when(F.size("f") >= 11, f(8, "bigint")).alias("ref_len"), F.when(F.size("f") >= 11, f(9, "bigint")).alias("query_len"), F.expr("try_element_at(f, -2)").alias("ref_contig"), F.expr("try_element_at(f, -1)").alias("query_contig"))
    return out.dropna(subset=["ref_start", "ref_end", "query_start", "query_end", "identity"])


def read_coords(spark: SparkSession, *paths: str) -> DataFrame:
    """Alignment rows of one or many coords files (many are one table), with aln_id in reading order."""
    return parse_coords(spark.read.text(list(paths))).withColumn("aln_id", F.monotonically_increasing_id())


def validate_coords(rows: DataFrame) -> DataFrame:
    """rows as they are; raises if there is none."""
    if rows.isEmpty():
        raise ValueError("no alignment line in the coords input")
    return rows


def parse_paf(lines: DataFrame) -> DataFrame:
    """lines (value) of a PAF file -> hits with identity and CIGAR."""
    x = lines.withColumn("f", F.split("value", "\t")).where(F.size("f") >= 12)
    n = lambda i: F.expr(f"try_cast(f[{i}] as bigint)")
    tag = F.try_element_at(F.filter(F.slice("f", F.lit(13), F.size("f")), lambda t: t.startswith("cg:Z:")), F.lit(1))
    out = x.select(F.col("f")[0].alias("qryid"), n(1).alias("qrylen"), n(2).alias("qrystart"), n(3).alias("qryend"), F.col("f")[4].alias("strand"), F.col("f")[5].alias("refid"), n(6).alias("reflen"), n(7).alias("refstart"), n(8).alias("refend"), n(9).alias("matches"), n(10).alias("alnlen"), n(11).alias("mapq"), F.substring(tag, 6, 1 << 30).alias("cigar"))
    return out.dropna(subset=["qrylen", "matches", "alnlen"]).withColumn("identity", F.col("matches") / F.greatest("alnlen", F.lit(1)))


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    return parse_paf(spark.read.text(path)).withColumn("hit_id", F.monotonically_increasing_id())


def read_gfa_segments(spark: SparkSession, path: str) -> DataFrame:
    """seq_id, bases of a GFA file's S lines."""
    f = F.split("value", r"\s+")
    return spark.read.text(path).where(F.col("value").startswith("S")).select(f[1].alias("seq_id"), F.upper(f[2]).alias("bases"))


def repair_header(description, seq_id):
    """repair_end and target of an extracted sequence: by region_type, overridden by aligned_to's ending."""
    fields = F.str_to_map(F.array_join(F.filter(F.split(description, " "), lambda x: F.contains(x, F.lit(":"))), " "), F.lit(" "), F.lit(":"))
    kind, to = F.try_element_at(fields, F.lit("region_type")), F.try_element_at(fields, F.lit("aligned_to"))
    first = F.when(kind == "first_alignment_with_preceding", "5prime").when(kind == "last_alignment_with_subsequent", "3prime")
    end = F.when(to.endswith("_5prime"), "5prime").when(to.endswith("_3prime"), "3prime").otherwise(first)
    return F.struct(end.alias("repair_end"), F.coalesce(F.regexp_replace(to, "_[53]prime$", ""), F.split_part(seq_id, F.lit("_"), F.lit(2))).alias("target"))


#: Words in the names of contig files, and names of files that assemblers leave (fixed values).
CONTIG_WORDS = ["contig", "scaffold", "assembly"]
CONTIG_FILES = ["assemblies.fasta", "shasta.fa", "flye.fa", "nextdenovo.fa", "verkko.fa"]


def discover_contigs(spark: SparkSession, path: str, least: int = 1_000) -> DataFrame:
    """path, length of the contig files of more than `least` bytes below a folder, at any depth; contents aren't read.

    A contig file ends in .fasta or .fa and has one of CONTIG_WORDS in its name, or is one of CONTIG_FILES, all in the case written here."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    name = F.regexp_extract("path", "[^/]*$", 0)
    named = name.rlike(f"({'|'.join(CONTIG_WORDS)}).*\\.(fasta|fa)$") | name.isin(CONTIG_FILES)
    return files.where((F.col("length") > least) & named).distinct()


def fastq_lengths(spark: SparkSession, path: str) -> DataFrame:
    """Read lengths of FASTQ files: each record begins with a line break and '@' whose third line is '+'."""
    text = spark.read.option("lineSep", "\n@").text(path)
    f = F.split("value", "\n")
    return text.where((F.size(f) >= 3) & f[2].startswith("+")).select(F.length(f[1]).cast("bigint").alias("read_length"))
