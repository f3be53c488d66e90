"""Column functions on sequences, names and labels. All are native expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(bases: Column) -> Column:
    return F.reverse(F.translate(bases, "ACGTacgt", "TGCAtgca"))


def reverse_complement_as(bases: Column, letters: str = "ACGTacgt") -> Column:
    """The reverse complement in one of three flavours: of "ACGT" alone, with "N" as itself, or of either case; other letters stay as they are."""
    other = {"A": "T", "C": "G", "G": "C", "T": "A", "N": "N"}
    pairs = {x: other[x.upper()] if x.isupper() else other[x.upper()].lower() for x in letters}
    return F.reverse(F.translate(bases, letters, "".join(pairs.values())))


def gc_count(bases: Column) -> Column:
    """G and C bases of a chunk (either case counts once upper-cased by the reader)."""
    return F.length(bases) - F.length(F.translate(bases, "GC", ""))


def clean_chrom_name(name: Column) -> Column:
    """First token without a .fa or .fasta ending."""
    return F.regexp_replace(F.split_part(F.trim(name), F.lit(" "), F.lit(1)), r"\.(fasta|fa)$", "")


def is_junk(bases: Column) -> Column:
    return bases.rlike("^[*Nn]*$")


def cigar_anchors(cigar: Column, least: int = 15) -> Column:
    """Match operations of at least `least` bases: 0 without a CIGAR, else 1 or more."""
    runs = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)M"), 1), lambda x: x.cast("bigint"))
    n = F.size(F.filter(runs, lambda x: x >= least))
    return F.when(F.coalesce(cigar, F.lit("")) == "", 0).otherwise(F.greatest(n, F.lit(1))).cast("bigint")


def format_genome_size(bp: Column) -> Column:
    """1.2g, 35m or 900k."""
    return F.when(bp >= 1_000_000_000, F.concat(F.round(bp / 1e9, 1).cast("string"), F.lit("g"))).when(bp >= 1_000_000, F.concat(F.floor(bp / 1e6).cast("string"), F.lit("m"))).otherwise(F.concat(F.floor(bp / 1e3).cast("string"), F.lit("k")))


def parse_genome_size(text: Column) -> Column:
    """Base pairs of 1.2g, 35m, 900k or a plain number."""
    n = F.regexp_extract(F.lower(text), r"^([0-9.]+)", 1).try_cast("double")
    unit = F.regexp_extract(F.lower(text), r"([gmk])", 1)
    return n * F.when(unit == "g", 1e9).when(unit == "m", 1e6).when(unit == "k", 1e3).otherwise(1.0)


def read_cutoff(bp: Column) -> Column:
    """Shortest read that is used for a genome of this size."""
    return F.when(bp >= 1e9, 2000).when(bp >= 1e8, 1000).otherwise(500)


def human_interval(start: Column, end: Column) -> Column:
    return F.concat_ws("-", (start + 1).cast("string"), end.cast("string"))


def patch_label(gap: Column, n: Column, contig: Column, start: Column, end: Column, direction: Column, flank: Column) -> Column:
    strand = F.when(direction < 0, F.lit("_revcomp")).otherwise(F.lit(""))
    return F.concat(F.lit("gap"), gap.cast("string"), F.lit("_patch"), n.cast("string"), F.lit("_contig"), contig, F.lit("_"), start.cast("string"), F.lit("_"), end.cast("string"), strand, F.lit("_flank"), flank.cast("string"))


def repair_label(contig: Column, target: Column, start: Column, end: Column) -> Column:
    """Id of an extracted repair sequence; the chromosome is the target's first token."""
    return F.concat_ws("_", contig, F.split_part(target, F.lit("_"), F.lit(1)), start.cast("string"), end.cast("string"))


def repair_description(length: Column, kind: Column, target: Column, end: Column) -> Column:
    """The name:value fields that follow a repair sequence's id."""
    return F.concat_ws(" ", F.concat(F.lit("length:"), length.cast("string")), F.concat(F.lit("region_type:"), kind), F.concat(F.lit("aligned_to:"), target, F.lit("_"), end))
