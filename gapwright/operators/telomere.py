"""Telomere arrays, chromosome ends, extraction of repair sequences and choice among them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.packed import arrow_map, occurrences, texts
from ..sources.scratch import kept
from .fill import match_names
from .gaps import islands, joined_runs

#: Telomere repeat units (fixed values).
UNITS = ["TTTAGGG", "CCCTAAA", "TTAGGG", "CCCTAA"]
END_UNITS = ["TTTAGGG", "CCCTAAA"]
#: Bases of a bin in which regions and arrays meet.
BIN = 1_000_000


def end_repeat_counts(seqs: DataFrame, window: int = 2_000) -> DataFrame:
    """left, right: non-overlapping end units in the first and last `window` bases."""
    n = lambda part: sum((F.length(part) - F.length(F.replace(part, F.lit(u)))) / len(u) for u in END_UNITS).cast("bigint")
    # exploding the one value has it computed once: a filter on the counts would be pushed below and make the sequences anew for each unit
    once = lambda *c: F.inline(F.array(F.struct(*c)))
    ends = seqs.select("seq_id", once(F.length("bases").cast("bigint").alias("seq_length"), F.substring("bases", 1, window).alias("head"), F.right("bases", F.lit(window)).alias("tail")))
    return ends.select("seq_id", once("seq_length", n(F.col("head")).alias("left_repeats"), n(F.col("tail")).alias("right_repeats")))


def telomere_status(counts: DataFrame, least: int = 5) -> DataFrame:
    five, three = F.col("left_repeats") >= least, F.col("right_repeats") >= least
    status = F.when(five & three, "complete").when(five, "missing_3prime").when(three, "missing_5prime").otherwise("missing_both")
    return counts.withColumns({"has_5prime": five, "has_3prime": three, "status": status, "needs_repair": ~(five & three)})


def telomere_arrays(chunks: DataFrame, least: int = 20, least_bp: int = 500, units: list[str] | None = None) -> DataFrame:
    """seq_id, pattern, start, end, length, repeats of tandem arrays.

    chunks: as chunk_sequences cuts them, with `more`, so that a unit over an edge is seen in the chunk where it begins. No unit overlaps
    itself, so occurrences at steps of the unit's length are what a tandem match finds. Arrays are put together where the chunk's
    bases are; only the coordinates of those that may go on in a neighbour are moved."""
    units = units or UNITS

    def scan(batches):
        for part in batches:
            buf, at = texts(pc.binary_join_element_wise(part.column("bases"), pc.fill_null(part.column("more"), ""), ""))
            own = pc.binary_length(part.column("bases")).to_numpy()
            start = part.column("start").to_numpy()
            for u in units:
                n = len(u)
                pos = occurrences(buf, u.encode())
                row = np.searchsorted(at, pos, side="right") - 1
                off = pos - at[row]
                keep = (off < own[row]) & (pos + n <= at[row + 1])
                row, off = row[keep], off[keep]
                goes_on = np.zeros(len(off), bool)
                goes_on[1:] = (row[1:] == row[:-1]) & (off[1:] - off[:-1] == n)
                first = np.flatnonzero(~goes_on)
                repeats = np.diff(np.append(first, len(off)))
                row, off = row[first], off[first]
                last = off + (repeats - 1) * n
                edge = (off < n) | (last + n >= own[row])
                keep = edge | (repeats >= least) & (repeats * n >= least_bp)
                row, off, repeats, edge = (x[keep] for x in (row, off, repeats, edge))
                begin = start[row] + off
                yield pa.RecordBatch.from_arrays([part.column("seq_id").take(pa.array(row)), pa.array([u] * len(row), pa.string()), pa.array(begin), pa.array(begin + repeats * n), pa.array(edge)], names=["seq_id", "pattern", "start", "end", "edge"])

    found = arrow_map(chunks.select("seq_id", "start", "bases", "more"), scan, "seq_id string, pattern string, start bigint, end bigint, edge boolean")
    size = F.col("end") - F.col("start")
    every = joined_runs(found, ["seq_id", "pattern"]).withColumn("repeats", F.expr("(end - start) div length(pattern)"))
    return every.where((F.col("repeats") >= least) & (size >= least_bp)).select("seq_id", "pattern", "start", "end", size.alias("length"), "repeats")


def internal_telomeres(arrays: DataFrame, lengths: DataFrame, flank: int = 5_000, reach: int = 1_000) -> DataFrame:
    """Arrays wholly inside [flank, length - flank], merged within `reach`; the first pattern stands."""
    inner = arrays.join(lengths, "seq_id").where((F.col("start") >= flank) & (F.col("end") <= F.col("seq_length") - flank))
    m = islands(inner, ["seq_id"], reach)
    return m.groupBy("seq_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("pattern", F.struct("start", "end", "pattern")).alias("pattern"), F.count("*").alias("n")).drop("island")


def telomere_contigs(contigs: DataFrame, arrays: DataFrame) -> DataFrame:
    """Contigs that have an array, with their arrays as text in order."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "end", "pattern"))), lambda x: F.concat(x["pattern"], F.lit(":"), x["start"].cast("string"), F.lit("-"), x["end"].cast("string"))), ";")
    return contigs.select("seq_id", "seq_length").join(arrays.groupBy("seq_id").agg(F.count("*").alias("n_arrays"), text.alias("arrays")), "seq_id")


def chromosome_ends(status: DataFrame, size: int = 5_000_000) -> DataFrame:
    """end_id, seq_id, start, end of the ends that lack repeats."""
    five = status.where("not has_5prime").select(F.concat("seq_id", F.lit("_5prime")).alias("end_id"), "seq_id", F.lit(0).cast("bigint").alias("start"), F.least("seq_length", F.lit(size)).cast("bigint").alias("end"))
    three = status.where("not has_3prime").select(F.concat("seq_id", F.lit("_3prime")).alias("end_id"), "seq_id", F.greatest(F.lit(0), F.col("seq_length") - size).cast("bigint").alias("start"), F.col("seq_length").alias("end"))
    return five.unionByName(three)


def directed(alignments: DataFrame) -> DataFrame:
    """Telomere flavour of alignment rows: s1 <= e1 on the contig, is_reverse by the query's order."""
    return alignments.select("aln_id", "ref_contig", "query_contig", "identity", F.least("ref_start", "ref_end").alias("s1"), F.greatest("ref_start", "ref_end").alias("e1"), "query_start", "query_end", (F.abs(F.col("ref_end") - F.col("ref_start")) + 1).alias("len1"), (F.col("query_start") > F.col("query_end")).alias("is_reverse"))


def alignment_direction(d: DataFrame) -> DataFrame:
    share = F.avg(F.when(F.col("is_reverse"), 0.0).otherwise(1.0))
    return d.groupBy("ref_contig", "query_contig").agg(share.alias("forward_ratio"), F.count("*").alias("n")).withColumn("mostly_forward", F.col("forward_ratio") >= 0.5)


def good_alignment(d: DataFrame, end: str, least_identity: float = 95.0, least: int = 100) -> DataFrame:
    """Of each pair the first by s1 ('5prime') or last by e1 ('3prime') good alignment; a reverse one of a mostly forward pair
    gives way to the extreme forward one, or drops the pair."""
    by = ["ref_contig", "query_contig"]
    order = [F.col("s1"), F.col("aln_id")] if end == "5prime" else [F.desc("e1"), F.col("aln_id")]
    good = d.where((F.col("identity") >= least_identity) & (F.col("len1") >= least))
    first = good.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")
    ahead = good.where("not is_reverse").withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1")
    ahead = ahead.select(*by, F.struct("aln_id", "s1", "e1", "is_reverse").alias("sub"))
    j = first.join(alignment_direction(d).select(*by, "mostly_forward"), by).join(ahead, by, "left")
    swap = F.col("mostly_forward") & F.col("is_reverse")
    pick = F.when(swap, F.col("sub")).otherwise(F.struct("aln_id", "s1", "e1", "is_reverse"))
    return j.withColumn("pick", pick).where("pick is not null").select(*by, "mostly_forward", swap.alias("substituted"), "pick.aln_id", "pick.s1", "pick.e1", "pick.is_reverse", F.lit(end).alias("repair_end"))


def truncated(regions: DataFrame, most: int = 5_000_000, most_alignment: int = 10_000) -> DataFrame:
    """regions (start, end 1-based inclusive, s1, e1, tel_start, tel_end, repair_end): shortened where longer than `most`, keeping the telomere and
    up to most_alignment of the alignment."""
    keep = F.least(F.lit(most_alignment), F.col("e1") - F.col("s1") + 1)
    long = F.col("end") - F.col("start") + 1 > most
    five = F.col("repair_end") == "5prime"
    stop = F.least(F.col("start") + most - 1, F.greatest(F.coalesce("tel_end", "start"), F.col("s1") + keep - 1))
    begin = F.greatest(F.col("end") - most + 1, F.least(F.coalesce("tel_start", "end"), F.col("e1") - keep + 1))
    return regions.withColumns({"cut_start": F.when(long & ~five, begin).otherwise(F.col("start")), "cut_end": F.when(long & five, stop).otherwise(F.col("end"))})


def in_region(arrays: DataFrame, regions: DataFrame) -> DataFrame:
    """Regions (region_id, seq_id, start, end) with the arrays wholly inside: count, first start and last end."""
    # both sides meet in bins of the array's start
    a = arrays.select("seq_id", F.col("start").alias("a0"), F.col("end").alias("a1"), F.expr(f"start div {BIN}").alias("bin"))
    hit = regions.withColumn("bin", F.explode(F.expr(f"sequence(start div {BIN}, end div {BIN})"))).join(a, ["seq_id", "bin"]).where((F.col("a0") >= F.col("start")) & (F.col("a1") <= F.col("end")))
    return hit.groupBy("region_id").agg(F.count("*").alias("n_arrays"), F.min("a0").alias("tel_start"), F.max("a1").alias("tel_end"))


def validated_ends(arrays: DataFrame, lengths: DataFrame, share: float = 0.10) -> DataFrame:
    """seq_id, ok_5prime, ok_3prime: an array begins in the first, or ends in the last tenth."""
    j = arrays.join(lengths, "seq_id")
    return j.groupBy("seq_id").agg(F.bool_or(F.col("start") < share * F.col("seq_length")).alias("ok_5prime"), F.bool_or(F.col("end") > (1 - share) * F.col("seq_length")).alias("ok_3prime"))


def repair_groups(repairs: DataFrame) -> DataFrame:
    """Repairs (repair_id, target, length) ranked by length within their target."""
    return repairs.withColumn("place", F.row_number().over(Window.partitionBy("target").orderBy(F.desc("length"), "repair_id")))


def telomere_score(identity, size, mapq):
    return identity * (0.5 + 0.5 * F.least(F.lit(1.0), size / 5000.0)) * (0.7 + 0.3 * F.least(F.lit(1.0), mapq / 60.0))


def quality_score(identity, size, mapq, coverage):
    return 0.4 * identity + 0.3 * F.least(F.lit(1.0), size / 10000.0) + 0.2 * F.least(F.lit(1.0), mapq / 60.0) + 0.1 * coverage


def best_telomere_match(paf: DataFrame) -> DataFrame:
    """The first best-scored hit of each repair sequence, with its quality."""
    ident = F.col("matches") / F.col("alnlen")
    s = paf.withColumns({"identity": ident, "score": telomere_score(ident, F.col("alnlen"), F.col("mapq")), "quality": quality_score(ident, F.col("alnlen"), F.col("mapq"), (F.col("qryend") - F.col("qrystart")) / F.col("qrylen"))})
    return s.withColumn("_r", F.row_number().over(Window.partitionBy("qryid").orderBy(F.desc("score"), "hit_id"))).where("_r = 1").drop("_r")


def validated(matches: DataFrame, identity: float = 0.7, least: int = 100, mapq: int = 20, quality: float = 0.5) -> DataFrame:
    reason = F.when(F.col("identity") < identity, "low_identity").when(F.col("alnlen") < least, "too_short").when(F.col("mapq") < mapq, "low_mapq").when(F.col("quality") < quality, "low_quality")
    return matches.withColumn("reason", reason)


def merge_plan(matches: DataFrame) -> DataFrame:
    """5': repair[0:q_end] replaces chromosome [0:t_end]; 3': repair[q_end:] replaces chromosome [t_end:]. On '-', coordinates flip.
    repair_end is 5prime or 3prime; reflen is the chromosome's length."""
    back = F.col("strand") == "-"
    qe = F.when(back, F.col("qrylen") - F.col("qrystart")).otherwise(F.col("qryend"))
    five = F.col("repair_end") == "5prime"
    m = matches.withColumn("q_end", qe)
    m = m.withColumns({"del_start": F.when(five, F.lit(0)).otherwise(F.col("refend")).cast("bigint"), "del_end": F.when(five, F.col("refend")).otherwise(F.col("reflen")), "src_start": F.when(five, F.lit(0)).otherwise(F.col("q_end")).cast("bigint"), "src_end": F.when(five, F.col("q_end")).otherwise(F.col("qrylen"))})
    return m.withColumn("extension", F.col("src_end") - F.col("src_start") - (F.col("del_end") - F.col("del_start")))


STRATEGIES = ("first_success", "minimal_extension", "balanced")


def selection_score(strategy: str):
    """The score of a merge plan under a strategy: how little it changes the length, its quality, identity and (balanced) mapq."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {', '.join(STRATEGIES)}")
    norm = F.greatest(F.lit(0.0), 1.0 - F.least(F.lit(1.0), F.abs("extension") / 100000.0))
    minimal = 0.6 * norm + 0.3 * F.col("quality") + 0.1 * F.col("identity")
    balanced = 0.4 * norm + 0.3 * F.col("quality") + 0.2 * F.col("identity") + 0.1 * F.least(F.lit(1.0), F.col("mapq") / 60.0)
    # ties go by the order of attempts, not by the last bit
    return F.round({"first_success": F.lit(1.0), "minimal_extension": minimal, "balanced": balanced}[strategy], 9)


def ranked_repairs(plans: DataFrame, strategy: str = "minimal_extension", order: tuple = ("hit_id",)) -> DataFrame:
    """Valid plans of each target with selection and place, best first. Ties go by `order`, the order in which repairs are tried.

    first_success stops at the first in that order: no other plan is listed."""
    p = plans.withColumn("selection", selection_score(strategy))
    p = p.withColumn("place", F.row_number().over(Window.partitionBy("target").orderBy(F.desc("selection"), *order)))
    return p.where("place = 1") if strategy == "first_success" else p


def select_repair(plans: DataFrame, strategy: str = "minimal_extension", order: tuple = ("hit_id",), close: float = 0.1) -> DataFrame:
    """Best repair of each target with n_successful (plans that were compared), is_close (the second scores within `close`, so
    the choice asks for a look) and the alternatives in order."""
    p = ranked_repairs(plans, strategy, order)
    best = p.groupBy("target").agg(F.count("*").alias("n_successful"), F.max(F.when(F.col("place") == 1, F.col("selection"))).alias("_first"), F.max(F.when(F.col("place") == 2, F.col("selection"))).alias("_second"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("place") > 1, F.struct("place", "qryid")))), lambda x: x["qryid"]), ",").alias("alternatives"))
    best = best.select("target", "n_successful", F.coalesce(F.round(F.col("_first") - F.col("_second"), 9) < close, F.lit(False)).alias("is_close"), "alternatives")
    return p.where("place = 1").join(best, "target").drop("place")


def repair_targets(repairs: DataFrame, chromosomes: DataFrame) -> DataFrame:
    """target, group_ord, chromosome of repairs (target, ord): the groups in the order in which their first repair stands, each with
    the chromosome (name, seq_ord) that its name means, null if none."""
    groups = kept(repairs.groupBy("target").agg(F.min("ord").alias("group_ord")))
    return groups.join(match_names(chromosomes, groups.select("target")).select("target", F.col("name").alias("chromosome")), "target", "left")


def first_repairs(chosen: DataFrame, groups: DataFrame) -> DataFrame:
    """Of the chosen repairs (target) those that are made: the first group of each chromosome that has one; a chromosome is repaired once."""
    j = chosen.join(groups.where("chromosome is not null"), "target")
    first = j.groupBy("chromosome").agg(F.min(F.struct("group_ord", "target"))["target"].alias("target"))
    return j.join(first, ["chromosome", "target"], "left_semi")


def outcomes(plans: DataFrame, made: DataFrame, groups: DataFrame) -> DataFrame:
    """Every repair sequence with success, failed or skipped, why, and what its own match lacked (detail).

    plans: qryid, target, reason; made: first_repairs; groups: repair_targets. A group that comes after the one which repaired its
    chromosome is skipped; of a group that has a success all others are skipped, of one that has none all have failed."""
    won = made.select("target", F.col("qryid").alias("won"))
    until = made.select("chromosome", F.col("group_ord").alias("until"), F.col("target").alias("by"))
    j = plans.join(groups, "target", "left").join(won, "target", "left").join(until, "chromosome", "left")
    o = lambda a, b: F.struct(F.lit(a).alias("outcome"), F.lit(b).alias("why"))
    out = F.when(F.col("chromosome").isNull(), o("skipped", "chromosome_not_found"))
    out = out.when(F.col("won").isNull() & F.col("until").isNotNull() & (F.struct("group_ord", "target") > F.struct("until", "by")), o("skipped", "chromosome_already_repaired"))
    out = out.when(F.col("won").isNull(), o("failed", "repair_attempt_failed")).when(F.col("qryid") == F.col("won"), o("success", "")).otherwise(o("skipped", "not_used_alternative"))
    return j.withColumn("o", out).select("qryid", "target", "o.outcome", "o.why", F.col("reason").alias("detail"))


def run_stats(chosen: DataFrame, tried: DataFrame) -> DataFrame:
    return chosen.agg(F.count("*").alias("repaired"), F.sum("extension").alias("extension"), F.avg("extension").alias("mean_extension")).crossJoin(tried.agg(F.count("*").alias("tried"))).withColumn("efficiency", F.col("repaired") / F.greatest("tried", F.lit(1)))


def genome_summary(status: DataFrame, internal: DataFrame) -> DataFrame:
    inner = internal.groupBy("seq_id").agg(F.count("*").alias("n_internal"))
    n = lambda c: F.count(F.when(c, 1))
    return status.join(inner, "seq_id", "left").agg(F.count("*").alias("n"), n(F.col("has_5prime") | F.col("has_3prime")).alias("any_end"), n(F.col("has_5prime") & F.col("has_3prime")).alias("both_ends"), n(F.col("n_internal") > 0).alias("with_internal"))


def end_matches(hits: DataFrame) -> DataFrame:
    """hits (target, repair_end): matches at each end and in all."""
    return hits.groupBy("target").agg(F.count(F.when(F.col("repair_end") == "5prime", 1)).alias("n_5prime"), F.count(F.when(F.col("repair_end") == "3prime", 1)).alias("n_3prime"), F.count("*").alias("n"))
