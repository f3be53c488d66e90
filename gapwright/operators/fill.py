"""Gap filling from flank hits, and composition of genomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import clean_chrom_name
from .sides import id_type


def gap_flanks(gaps: DataFrame, seqs: DataFrame, flank: int = 5_000, least: int = 100) -> DataFrame:
    """Left and right flank intervals of gaps of `least`; both dropped if either holds part of at least `least` Ns of another gap."""
    w = Window.partitionBy("seq_id").orderBy("start")
    g = gaps.where(F.col("length") >= least).join(seqs.select("seq_id", "seq_length"), "seq_id")
    g = g.withColumn("gap_no", F.row_number().over(w)).withColumn("l0", F.greatest(F.lit(0), F.col("start") - flank)).withColumn("r1", F.least("seq_length", F.col("end") + flank))
    # overlap of a flank with the neighbouring gaps: gaps are disjoint and sorted, so the nearest shows the longest run inside
    inside_l = F.lag("end").over(w) - F.greatest(F.lag("start").over(w), F.col("l0"))
    inside_r = F.least(F.lead("end").over(w), F.col("r1")) - F.lead("start").over(w)
    ok = (F.coalesce(inside_l, F.lit(0)) < least) & (F.coalesce(inside_r, F.lit(0)) < least)
    return g.withColumn("ok", ok).where("ok").select("seq_id", "gap_no", "start", "end", F.col("l0").alias("left_start"), F.col("start").alias("left_end"), F.col("end").alias("right_start"), F.col("r1").alias("right_end"))


def flank_hits(paf: DataFrame, least: int = 1_000, identity: float = 0.40) -> DataFrame:
    """Hits long and similar enough, with gap_id and side (L or R) off the flank's name."""
    share = F.col("matches") / F.col("alnlen")
    return paf.where((F.col("alnlen") >= least) & (share >= identity)).select("*", share.alias("identity"), F.regexp_extract("qryid", r"^(.*)\.[LR]$", 1).alias("gap_id"), F.regexp_extract("qryid", r"\.([LR])$", 1).alias("side"))


def anchor_pairs(hits: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Pairs of a left and a right hit of a gap on one contig and strand, in order, with a fill of 1..most bases."""
    keep = ["gap_id", "refid", "strand"]
    l = hits.where("side = 'L'").select(*keep, F.col("hit_id").alias("l_id"), F.col("refstart").alias("ls"), F.col("refend").alias("le"), F.col("identity").alias("li"))  # noqa: E741
    r = hits.where("side = 'R'").select(*keep, F.col("hit_id").alias("r_id"), F.col("refstart").alias("rs"), F.col("refend").alias("re"), F.col("identity").alias("ri"))
    back = F.col("strand") == "-"
    pair = l.join(r, keep).withColumn("fill_start", F.when(back, F.col("re")).otherwise(F.col("le"))).withColumn("fill_end", F.when(back, F.col("ls")).otherwise(F.col("rs")))
    return pair.where(F.col("fill_end").cast("bigint") - F.col("fill_start") > 0).where(F.col("fill_end") - F.col("fill_start") <= most).select(*keep, "l_id", "r_id", "fill_start", "fill_end", ((F.col("li") + F.col("ri")) / 2).alias("score"))


def best_fill(hits: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Of each gap the pair of anchor_pairs with the highest mean identity (ties: the lowest hit ids), without listing the pairs.

    For each left hit the best right hit lies in the next `most` bases. On a line cut into blocks of that length, such a stretch is the end of one
    block and the beginning of the next: running maxima from either end of a block give it, so a repeat on which many hits lie costs one pass.
    The hits are read once, each put on both lines, which one sort orders."""
    keep = ["gap_id", "refid", "strand"]
    back = F.col("strand") == "-"
    # on the reverse strand all is mirrored: the fill runs from the right hit's end to the left one's start
    l_at, r_at = F.when(back, -F.col("refstart")).otherwise(F.col("refend")).cast("bigint"), F.when(back, -F.col("refend")).otherwise(F.col("refstart")).cast("bigint")
    kind = id_type(hits, "hit_id")
    id_ = F.col("hit_id").cast(kind)
    left, right = F.struct(l_at.alias("at"), "identity", id_.alias("id")), F.struct("identity", (-id_).alias("id"), r_at.alias("at"))
    no_left, no_right = (F.lit(None).cast(f"struct<{x}>") for x in (f"at:bigint,identity:double,id:{kind}", f"identity:double,id:{kind},at:bigint"))
    # the line of odd cells is read forwards, that of even ones backwards
    place = lambda x, o, ahead, l, r: F.struct((F.floor(x / most) * 2 + ahead).alias("cell"), (x if ahead else -x).alias("x"), F.lit(o).alias("o"), l.alias("left"), r.alias("right"))  # noqa: E731,E741
    both = F.when(F.col("side") == "L", F.array(place(l_at + 1, 1, 0, left, no_right), place(l_at + most, 1, 1, left, no_right))).when(F.col("side") == "R", F.array(*(place(r_at, 0, k, no_left, right) for k in (0, 1))))
    line = hits.select(*keep, F.explode(both).alias("p")).select(*keep, "p.*")
    w = Window.partitionBy(*keep, "cell").orderBy("x", "o").rowsBetween(Window.unboundedPreceding, 0)
    best = line.withColumn("right", F.max("right").over(w)).where("o = 1 and right is not null")
    size = F.col("right.at") - F.col("left.at")
    start = F.when(back, -F.col("right.at")).otherwise(F.col("left.at"))
    row = F.struct(((F.col("left.identity") + F.col("right.identity")) / 2).alias("score"), (-F.col("left.id")).alias("l"), F.col("right.id").alias("r"), "refid", "strand", start.alias("fill_start"), (start + size).alias("fill_end"))
    top = best.where(size.between(1, most)).groupBy("gap_id").agg(F.max(row).alias("t"))
    return top.select("gap_id", "t.refid", "t.strand", (-F.col("t.l")).alias("l_id"), (-F.col("t.r")).alias("r_id"), "t.fill_start", "t.fill_end", "t.score")


def fill_edits(fills: DataFrame, gaps: DataFrame) -> DataFrame:
    """Edits that replace a gap's Ns (gap_id, seq_id, start, end) by its contig slice."""
    return fills.join(gaps.select("gap_id", "seq_id", "start", "end"), "gap_id").select("seq_id", F.col("start").alias("del_start"), F.col("end").alias("del_end"), F.lit("contig").alias("src_kind"), F.col("refid").alias("src_id"), F.col("fill_start").alias("src_start"), F.col("fill_end").alias("src_end"), "strand", F.lit(0).alias("priority"))


def fill_detail(gap_ids: DataFrame, fills: DataFrame) -> DataFrame:
    """One row a gap: Closed or Not_closed, with source, range, length, strand and identity."""
    size = F.col("fill_end") - F.col("fill_start")
    return gap_ids.join(fills, "gap_id", "left").select("gap_id", F.when(F.col("refid").isNull(), "Not_closed").otherwise("Closed").alias("status"), F.col("refid").alias("source"), F.col("fill_start"), F.col("fill_end"), size.alias("fill_length"), "strand", F.col("score").alias("identity"))


def merge_unique(parts: DataFrame) -> DataFrame:
    """parts (file_ord, seq_ord, seq_id): repeated ids get _1, _2, ... in order."""
    w = Window.partitionBy("seq_id").orderBy("file_ord", "seq_ord")
    n = F.row_number().over(w) - 1
    return parts.withColumn("_n", n).withColumn("new_id", F.when(F.col("_n") == 0, F.col("seq_id")).otherwise(F.concat("seq_id", F.lit("_"), F.col("_n").cast("string")))).drop("_n")


def overlay(repaired: DataFrame, original: DataFrame) -> DataFrame:
    """Repaired sequences, and the original ones (by exact id) that are missing among them."""
    rest = original.join(repaired.select("seq_id").distinct(), "seq_id", "left_anti")
    return repaired.withColumn("origin", F.lit("repaired")).unionByName(rest.withColumn("origin", F.lit("original")))


def final_labels(seqs: DataFrame, filled: DataFrame, gapped: DataFrame) -> DataFrame:
    """seq_id, label: as it was, filled_ or unfilled_, for sequences without gaps, closed and still open."""
    f = filled.select("seq_id").distinct().withColumn("_f", F.lit(True))
    g = gapped.select("seq_id").distinct().withColumn("_g", F.lit(True))
    prefix = F.when(F.col("_g").isNull(), "").when(F.col("_f"), "filled_").otherwise("unfilled_")
    return seqs.join(f, "seq_id", "left").join(g, "seq_id", "left").select("seq_id", F.concat(prefix, "seq_id").alias("label"))


def _substrings(name, sizes: list[int]):
    """All distinct substrings of a short name that have one of the sizes."""
    none = F.array().cast("array<string>")

    def cuts(n: int):
        return F.when(F.length(name) >= n, F.transform(F.sequence(F.lit(1), F.length(name) - n + 1), lambda i: F.substring(name, i, F.lit(n)))).otherwise(none)

    return F.array_distinct(F.concat(*map(cuts, sizes))) if sizes else none


def _sizes(names: DataFrame, column: str) -> list[int]:
    """The distinct lengths of names (few: names are short)."""
    return sorted(r["n"] for r in names.select(F.length(column).alias("n")).distinct().collect() if r["n"])


def select_sequences(seqs: DataFrame, names: DataFrame) -> DataFrame:
    """name -> seq_id: the exact id, else the first (by seq_ord) that contains it in any case.

    Containment is an equi-join with the ids' substrings of the names' lengths."""
    exact = names.join(seqs.select(F.col("seq_id").alias("name"), "seq_id", "seq_ord"), "name", "left").withColumn("rank", F.lit(1))
    open_ = exact.where("seq_id is null").select("name", F.lower("name").alias("part"))
    parts = seqs.select("seq_id", "seq_ord", F.explode(_substrings(F.lower("seq_id"), _sizes(open_, "part"))).alias("part"))
    loose = open_.join(parts, "part").select("name", "seq_id", "seq_ord", F.lit(2).alias("rank"))
    w = Window.partitionBy("name").orderBy("rank", "seq_ord")
    return exact.where("seq_id is not null").unionByName(loose).withColumn("_r", F.row_number().over(w)).where("_r = 1").select("name", "seq_id", "rank")


def rename_sequences(seqs: DataFrame) -> DataFrame:
    """seq_id, name, description: the cleaned first token as the name, the description emptied."""
    return seqs.select("seq_id", clean_chrom_name(F.col("seq_id")).alias("name"), F.lit("").alias("description"))


def select_patched(seqs: DataFrame, names: DataFrame) -> DataFrame:
    """name -> seq_id: the exact id, then name_..., then name among the id's tokens; renamed to the name."""
    tokens = seqs.select("seq_id", "seq_ord", F.explode(F.array_distinct(F.concat(F.array("seq_id"), F.split("seq_id", "_")))).alias("name"))
    rank = F.when(F.col("seq_id") == F.col("name"), 1).when(F.startswith("seq_id", F.concat("name", F.lit("_"))), 2).otherwise(3)
    w = Window.partitionBy("name").orderBy("rank", "seq_ord")
    return tokens.join(names, "name").withColumn("rank", rank).withColumn("_r", F.row_number().over(w)).where("_r = 1").select("name", "seq_id", "rank")


def syntenic_contigs(alignments: DataFrame, least: int = 10_000, identity: float = 95.0) -> DataFrame:
    """query_contig, ref_contig, total aligned length of long, similar alignments."""
    size = F.abs(F.col("ref_end") - F.col("ref_start")) + 1
    return alignments.where((size >= least) & (F.col("identity") >= identity)).groupBy("query_contig", "ref_contig").agg(F.sum(size).alias("aligned"), F.count("*").alias("n"))


def match_names(names: DataFrame, targets: DataFrame) -> DataFrame:
    """Fuzzy chromosome names: equal without chr, then one within the other, then the first number; the first by seq_ord.

    Each rule is an equi-join: on the bare names, on substrings of the other side's lengths, on the numbers."""
    bare = lambda c: F.regexp_replace(F.lower(c), "^chr", "")
    n = names.select("name", "seq_ord", bare("name").alias("a"))
    t = targets.select("target", bare("target").alias("b"))
    inner = t.join(n.select("name", "seq_ord", "a", F.explode(_substrings(F.col("a"), _sizes(t, "b"))).alias("b")), "b")
    outer = n.join(t.select("target", F.explode(_substrings(F.col("b"), _sizes(n, "a"))).alias("a")), "a")
    within = inner.select("target", "name", "seq_ord").unionByName(outer.select("target", "name", "seq_ord")).withColumn("rank", F.lit(2))
    equal = n.join(t, n["a"] == t["b"]).select("target", "name", "seq_ord", F.lit(1).alias("rank"))
    number = lambda c: F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit(""))
    numbered = n.withColumn("number", number("a")).join(t.withColumn("number", number("b")), "number").select("target", "name", "seq_ord", F.lit(3).alias("rank"))
    w = Window.partitionBy("target").orderBy("rank", "seq_ord")
    every = equal.unionByName(within).unionByName(numbered)
    return every.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("target", "name", "rank")
