"""Patches: nearest anchors, regions on the reference contigs, flank matches and cut points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sides import nearest


def nearest_anchors(alignments: DataFrame, gaps: DataFrame, least: int = 2, strict_left: bool = False) -> DataFrame:
    """gap_key, query_contig, gap_pos, ref_contig, left, right: the nearest alignment ending at or before a gap, and beginning after it, on each
    reference contig that the gap's query contig has at least `least` alignments with.

    Gaps (gap_key, query_contig, gap_pos) and alignments meet in cells of the query contig and are never paired. Ties go to the lowest aln_id."""
    return nearest(alignments, gaps, least, strict_left)


def valid_pairs(anchors: DataFrame, low: int = 1_000, high: int = 1_000_000) -> DataFrame:
    return anchors.where("left is not null and right is not null").withColumn("distance", F.col("right.q_min") - F.col("left.q_max")).where(F.col("distance").between(low, high))


def patch_regions(pairs: DataFrame, lengths: DataFrame, flank: int = 10_000) -> DataFrame:
    """Direction by the anchors' order on the reference (none if they overlap), and the region with flanks, clipped to 1..length."""
    forward, backward = F.col("left.r_max") < F.col("right.r_min"), F.col("right.r_max") < F.col("left.r_min")
    p = pairs.withColumn("direction", F.when(forward, 1).when(backward, -1)).where("direction is not null")
    lo = F.when(F.col("direction") == 1, F.col("left.r_max")).otherwise(F.col("right.r_max"))
    hi = F.when(F.col("direction") == 1, F.col("right.r_min")).otherwise(F.col("left.r_min"))
    return p.join(lengths, "ref_contig").select("gap_key", "ref_contig", "direction", "distance", F.greatest(F.lit(1), lo - flank + 1).cast("bigint").alias("patch_start"), F.least(hi + flank - 1, F.col("ref_length")).cast("bigint").alias("patch_end"))


def numbered_patches(regions: DataFrame) -> DataFrame:
    return regions.withColumn("patch_no", F.row_number().over(Window.partitionBy("gap_key").orderBy("ref_contig")))


def patch_histogram(patches: DataFrame) -> DataFrame:
    """How many gaps have how many patches."""
    return patches.groupBy("gap_key").agg(F.count("*").alias("n_patches")).groupBy("n_patches").agg(F.count("*").alias("n_gaps"))


def parse_patch_header(header):
    """gap position, patch number, contig, region of a patch label; 0, 0 and unknown where missing."""
    pick = lambda p, d: F.coalesce(F.nullif(F.regexp_extract(header, p, 1), F.lit("")), F.lit(d))
    return F.struct(pick(r"(?i)gap[_-]?(\d+)", "0").cast("bigint").alias("gap_pos"), pick(r"(?i)len(?:gth)?[_:=-]?(\d+)", "0").cast("bigint").alias("length"), pick(r"(?i)(chr[a-z0-9]+)", "unknown").alias("chrom"))


def first_patch(patches: DataFrame, gaps: DataFrame) -> DataFrame:
    """The first patch in file order whose header names the gap's position."""
    w = Window.partitionBy("gap_key").orderBy("file_ord")
    p = patches.withColumn("at", parse_patch_header(F.col("header"))["gap_pos"])
    return gaps.join(p, gaps["gap_pos"] == p["at"]).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "at")


def valid_patch(bases, seq_id, least: int = 10, least_file: int = 100):
    """Whether a patch has enough bases, and its file (header and bases) enough bytes."""
    return (F.length(bases) >= least) & (F.length(bases) + F.length(seq_id) + 2 >= least_file)


def reheader(header, gap_pos):
    """A patch label with another gap position."""
    return F.regexp_replace(header, F.lit(r"gap\d+"), F.concat(F.lit("gap"), gap_pos.cast("string")))


def patch_flanks(size, flank: int = 10_000):
    """Flank length of a patch: the wish, else a quarter of the patch, else up to 100 or half of it; null under 20 bases."""
    n = F.when(2 * flank <= size, F.lit(flank)).when(F.floor(size / 4) >= 20, F.floor(size / 4)).otherwise(F.least(F.lit(100), F.floor(size / 2)))
    return F.when(n >= 20, n.cast("bigint"))


def match_score(identity, size):
    return identity * (0.7 + 0.3 * F.least(F.lit(1.0), size / 1000.0))


def best_matches(hits: DataFrame, least_mapq: int = 20, least_score: float = 0.7, least: int = 100, by: tuple = ("qryid",)) -> DataFrame:
    """The highest score of each flank among hits of enough mapq; kept if the score and the length suffice. Ties: lowest hit_id."""
    s = hits.where(F.col("mapq") >= least_mapq).withColumn("score", match_score(F.col("matches") / F.col("alnlen"), F.col("alnlen")))
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "hit_id")
    return s.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").where((F.col("score") >= least_score) & (F.col("alnlen") >= least))


def match_gate(best: DataFrame, threshold: float = 0.7, relaxed: bool = False) -> DataFrame:
    """Gaps whose both flanks match; with `relaxed`, mapq of 60 lowers the threshold to max(0.5, 0.8 t)."""
    t = F.when(F.lit(relaxed) & (F.col("mapq") >= 60), F.lit(max(0.5, 0.8 * threshold))).otherwise(F.lit(threshold))
    ok = best.where(F.col("score") >= t).withColumn("gap_id", F.regexp_extract("qryid", r"^(.*)\.[LR]$", 1)).withColumn("side", F.regexp_extract("qryid", r"\.([LR])$", 1))
    side = lambda s: ok.where(F.col("side") == s).select("gap_id", *(F.col(c).alias(f"{s.lower()}_{c}") for c in ("hit_id", "score", "mapq", "strand", "refstart", "refend", "qrystart", "qryend")))
    return side("L").join(side("R"), "gap_id")


def search_window(gap_pos, seq_length, wide: int = 500_000, near: int = 200_000):
    """lo, hi: where a patch's flanks are looked for. First `wide` on both sides of the gap, clipped to the sequence; within that, `near` (at
    most half of it) round the place where the gap is expected, unless no more than 1,000 bases would be left."""
    lo, hi = F.greatest(F.lit(0), gap_pos - wide).cast("bigint"), F.least(seq_length, gap_pos + wide).cast("bigint")
    radius = F.least(F.lit(near), F.floor((hi - lo) / 2))
    closer_lo, closer_hi = F.greatest(lo, gap_pos - radius), F.least(hi, gap_pos + radius)
    narrow = (gap_pos >= lo) & (gap_pos < hi) & (closer_hi - closer_lo > 1_000)
    return F.struct(F.when(narrow, closer_lo).otherwise(lo).cast("bigint").alias("lo"), F.when(narrow, closer_hi).otherwise(hi).cast("bigint").alias("hi"))


def matches_in_window(hits: DataFrame, gaps: DataFrame) -> DataFrame:
    """Hits of patch flanks (named gap_id.L or .R) that lie wholly in their gap's search window. gaps: gap_id, query_contig, gap_pos, seq_length."""
    at = gaps.select(F.col("gap_id").alias("_gap"), F.col("query_contig").alias("_seq"), search_window(F.col("gap_pos"), F.col("seq_length")).alias("_w"))
    named = hits.withColumn("_gap", F.regexp_extract("qryid", r"^(.*)\.[LR]$", 1))
    return named.join(at, "_gap").where((F.col("refid") == F.col("_seq")) & (F.col("refstart") >= F.col("_w.lo")) & (F.col("refend") <= F.col("_w.hi"))).select(hits.columns)


def cut_points(m: DataFrame, search: int = 500_000) -> DataFrame:
    """m (gap_id, gap_start, seq_length, patch_length, left_flank, right_flank, l_*, r_* matches, has_cigar) -> left_cut, right_cut, ins_start, ins_end, net.

    Where both flanks match on the reverse strand the patch is reverse-complemented and its offsets with it."""
    cross = F.col("l_refend") > F.col("r_refstart")
    mid = F.expr("(l_refend + r_refstart) div 2")
    left = F.when(~cross, F.col("l_refend")).when(F.col("has_cigar"), F.least(mid, "gap_start")).otherwise(F.least("l_refend", "gap_start"))
    right = F.when(~cross, F.col("r_refstart")).when(F.col("has_cigar"), F.greatest(mid, F.col("gap_start") + 100)).otherwise(F.greatest("r_refstart", F.col("gap_start") + 100))
    m = m.withColumn("left_cut", F.greatest(F.lit(0), F.least(left, F.col("gap_start") + search))).withColumn("right_cut", F.greatest(F.col("gap_start") - search, F.least(right, F.col("seq_length"))))
    shift = F.col("patch_length") - F.col("right_flank")
    both = (F.col("l_strand") == "-") & (F.col("r_strand") == "-")
    ls, le = F.col("l_qrystart"), F.col("l_qryend")
    rs, re = shift + F.col("r_qrystart"), shift + F.col("r_qryend")
    flip = lambda x: F.col("patch_length") - x
    ls, le, rs, re = F.when(both, flip(re)).otherwise(ls), F.when(both, flip(rs)).otherwise(le), F.when(both, flip(le)).otherwise(rs), F.when(both, flip(ls)).otherwise(re)
    m = m.withColumns({"_ls": ls, "_le": le, "_rs": rs, "_re": re})
    over = F.col("_le") > F.col("_rs")
    clamp = lambda x: F.greatest(F.lit(0), F.least(x, F.col("patch_length")))
    m = m.withColumn("_a", clamp(F.when(over, F.least("_ls", "_rs")).otherwise(F.col("_le")))).withColumn("_b", clamp(F.when(over, F.greatest("_le", "_re")).otherwise(F.col("_rs"))))
    core = F.col("_a") >= F.col("_b")
    m = m.withColumn("ins_start", F.when(core, F.col("left_flank")).otherwise(F.col("_a"))).withColumn("ins_end", F.when(core, F.greatest("left_flank", shift)).otherwise(F.col("_b")))
    removed = F.greatest(F.lit(0), F.col("right_cut") - F.col("left_cut"))
    return m.withColumn("removed", removed).withColumn("inserted", F.col("ins_end") - F.col("ins_start")).withColumn("net", F.col("inserted") - F.col("removed")).drop("_ls", "_le", "_rs", "_re", "_a", "_b")


def accepted(cuts: DataFrame, least: int = 100) -> DataFrame:
    return cuts.where(F.abs("net") > least)


def patch_summary(cuts: DataFrame) -> DataFrame:
    return cuts.agg(F.count("*").alias("n"), F.sum("inserted").alias("inserted"), F.sum("removed").alias("removed"), F.sum("net").alias("net"), F.avg((F.col("l_score") + F.col("r_score")) / 2).alias("mean_score"))
