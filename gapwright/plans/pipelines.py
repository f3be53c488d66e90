"""User-level composites: each is one lazy plan over the operators. Runs over many genomes by prefixing seq_id with the sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as S
from ..operators import edits as E
from ..operators import fill as L
from ..operators import gaps as D
from ..operators import lift as M
from ..operators import patch as P
from ..operators import synteny as Y
from ..operators import telomere as T
from ..sources.scratch import dropped, kept, only

#: So many gap names may be broadcast.
FEW = 100_000


def analyze_genome(seqs: DataFrame, least_gap: int = 1, least_fragment: int | None = None, least_repeats: int = 5, window: int = 2_000, internal_flank: int = 5_000, bins: int = 50) -> dict[str, DataFrame]:
    """Gaps, fragments, telomere status, internal telomeres, tracks, and one row a sequence."""
    chunks, lens = kept(D.chunk_sequences(seqs)), kept(D.lengths(seqs))
    gaps = kept(D.find_gaps(chunks, least_gap, any_case=True))
    frags = D.fragment_status(D.fragments(gaps, lens), least_fragment)
    status = kept(T.telomere_status(T.end_repeat_counts(seqs, window), least_repeats))
    internal = T.internal_telomeres(T.telomere_arrays(chunks, 10, 100), lens, internal_flank)
    feats = gaps.select("seq_id", F.lit("gap").alias("kind"), "start", "end").unionByName(internal.select("seq_id", F.lit("internal").alias("kind"), "start", "end"))
    ends = status.where("has_5prime").select("seq_id", F.lit("telomere").alias("kind"), F.lit(0).cast("bigint").alias("start"), F.least(F.lit(window), "seq_length").cast("bigint").alias("end"))
    ends = ends.unionByName(status.where("has_3prime").select("seq_id", F.lit("telomere").alias("kind"), F.greatest(F.lit(0), F.col("seq_length") - window).cast("bigint").alias("start"), F.col("seq_length").alias("end")))
    track = D.structure_track(lens, feats.unionByName(ends), bins)
    sums = D.gap_stats_by_chrom(gaps).select("seq_id", "n_gaps", F.col("total").alias("gap_bases"))
    n_frags = frags.groupBy("seq_id").agg(F.count("*").alias("n_fragments"))
    rows = status.select("seq_id", "seq_length", "status").join(sums, "seq_id", "left").join(n_frags, "seq_id", "left").join(track, "seq_id")
    rows = rows.fillna(0, ["n_gaps", "gap_bases", "n_fragments"])
    return {"gaps": gaps, "fragments": frags, "telomeres": status, "internal": internal, "sequences": rows}


def numbered_gaps(gaps: DataFrame) -> DataFrame:
    """gaps with gap_no, counted along each sequence, and gap_id as flank names have it."""
    g = gaps.withColumn("gap_no", F.row_number().over(Window.partitionBy("seq_id").orderBy("start")))
    return g.withColumn("gap_id", F.concat_ws(".", "seq_id", F.col("gap_no").cast("string")))


def fill_gaps(lens: DataFrame, gaps: DataFrame, hits: DataFrame) -> dict[str, DataFrame]:
    """Gaps of draft sequences filled from contigs by flank hits (PAF rows named seq.gap_no.L or .R).

    lens: seq_id, seq_ord, seq_length; gaps: seq_id, start, end, length. edits and segments are coordinates (edits.materialize makes bases)."""
    named = kept(numbered_gaps(gaps))
    found = L.flank_hits(hits)
    if named.count() <= FEW:  # hits of other gaps aren't sorted
        found = found.join(F.broadcast(named.select("gap_id")), "gap_id", "left_semi")
    best = kept(L.best_fill(found))
    made = kept(E.resolve(L.fill_edits(best, named)))
    segments = E.apply_edits(made, lens)
    left = named.join(best.select("gap_id"), "gap_id", "left_anti").select("seq_id", "start", "end", "length")
    return {"edits": made, "segments": segments, "agp": E.agp_rows(segments), "detail": L.fill_detail(named.select("gap_id"), best), "open": left, "stats": D.fill_stat_table(lens, left, 1), "closure": D.gap_closure(gaps, left, 1)}


def moved_gaps(gaps: DataFrame, edits: DataFrame) -> DataFrame:
    """Gaps (outside the edits) at their places after the edits."""
    at = gaps.withColumn("key", F.xxhash64("seq_id", "start")).select("key", "seq_id", "start", "end", "length")
    lift = lambda p: E.lift_by_edits(at.select("key", "seq_id", F.col(p).alias("pos")), edits).select("key", F.col("lifted").alias(f"_{p}"))
    return at.join(lift("start"), "key").join(lift("end"), "key").select("seq_id", F.col("_start").alias("start"), F.col("_end").alias("end"), "length")


def new_lengths(lens: DataFrame, edits: DataFrame) -> DataFrame:
    """Sequence lengths after the edits."""
    more = edits.groupBy("seq_id").agg(F.sum(F.expr("src_end - src_start - (del_end - del_start)")).alias("_more"))
    return lens.join(more, "seq_id", "left").withColumn("seq_length", F.col("seq_length") + F.coalesce("_more", F.lit(0))).drop("_more")


def two_round_fill(lens: DataFrame, gaps: DataFrame, hits: DataFrame, hits2: DataFrame, least: int = 100_000, joint: int = 100) -> DataFrame:
    """Fill, drop fragments below `least` (what is kept is joined by `joint` Ns), fill again: a row a round with its gap counts.

    hits2 name the gaps of the second round, the joints, by their number in each sequence."""
    lens, gaps = kept(lens), kept(gaps)
    one = fill_gaps(lens, gaps, hits)
    lens1 = kept(new_lengths(lens, one["edits"]))
    frags = D.fragment_status(D.fragments(moved_gaps(one["open"], one["edits"]), lens1), least)
    pieces = kept(D.filtered_segments(frags, joint))
    w = Window.partitionBy("seq_id").orderBy("n")
    joints = pieces.withColumn("next", F.lead("out_start").over(w)).where("next is not null").select("seq_id", (F.col("next") - joint).alias("start"), F.col("next").alias("end"), F.lit(joint).cast("bigint").alias("length"))
    lens2 = pieces.groupBy("seq_id").agg(F.max(F.expr("out_start + end - start")).cast("bigint").alias("seq_length"))
    two = fill_gaps(lens2.join(lens.select("seq_id", "seq_ord"), "seq_id"), joints, hits2)
    count = lambda n, g, o: g.agg(F.lit(n).alias("round"), F.count("*").alias("gaps_before")).crossJoin(o.agg(F.count("*").alias("gaps_after")))
    return count(1, gaps, one["open"]).unionByName(count(2, joints, two["open"]))


def patch_gaps(alignments: DataFrame, gaps: DataFrame, ref_lengths: DataFrame, matches: DataFrame, lens: DataFrame, flank: int = 10_000, least_net: int = 100) -> dict[str, DataFrame]:
    """Every gap's patches off the reference contigs, their flanks' matches on the sequence, cut points, accepted edits, and the rebuilt genome.

    gaps: gap_key, query_contig, gap_pos, gap_id; matches: PAF rows of the patch flanks on the sequence, named gap_id.L and .R;
    lens: seq_id, seq_length of the whole genome. The first patch of a gap is tried."""
    numbered = kept(P.numbered_patches(P.patch_regions(P.valid_pairs(P.nearest_anchors(alignments, gaps)), ref_lengths, flank)))
    first = numbered.where("patch_no = 1").withColumn("patch_length", F.col("patch_end") - F.col("patch_start") + 1)
    first = first.withColumn("left_flank", P.patch_flanks(F.col("patch_length"), flank)).where("left_flank is not null").withColumn("right_flank", F.col("left_flank"))
    first = first.join(gaps.select("gap_key", "query_contig", "gap_pos", "gap_id"), "gap_key").join(lens.select(F.col("seq_id").alias("query_contig"), "seq_length"), "query_contig")
    found = P.match_gate(P.best_matches(P.matches_in_window(matches, first))).join(first.withColumn("gap_start", F.col("gap_pos")), "gap_id").withColumn("has_cigar", F.lit(False))
    cuts = kept(P.accepted(P.cut_points(found), least_net))
    # the patch lies in patch_start..patch_end of its contig, read backwards where its direction, or both flanks' strand, says so
    turned = (F.col("direction") < 0) != ((F.col("l_strand") == "-") & (F.col("r_strand") == "-"))
    base = F.col("patch_start") - 1
    src = F.when(turned, F.col("patch_end") - F.col("ins_end")).otherwise(base + F.col("ins_start")).alias("src_start"), F.when(turned, F.col("patch_end") - F.col("ins_start")).otherwise(base + F.col("ins_end")).alias("src_end")
    offered = cuts.select("gap_key", F.col("query_contig").alias("seq_id"), F.col("left_cut").alias("del_start"), F.greatest("left_cut", "right_cut").alias("del_end"), F.lit("contig").alias("src_kind"), F.col("ref_contig").alias("src_id"), *src, F.when(turned, "-").otherwise("+").alias("strand"), F.lit(0).alias("priority"))
    edits = kept(E.resolve(offered.drop("gap_key")))
    changed = new_lengths(lens.join(edits.select("seq_id").distinct(), "seq_id", "left_semi"), edits)
    return {"patches": gaps.select("gap_key", "query_contig", "gap_pos").join(numbered, "gap_key", "left"), "offered": offered, "edits": edits, "segments": E.apply_edits(edits, lens), "genome": L.overlay(changed, lens), "summary": P.patch_summary(cuts)}


def correct_gaps(alignments: DataFrame, gaps: DataFrame, lens: DataFrame, mode: str = "conservative", mask: int = 100, gap_size: int = 100) -> dict[str, DataFrame]:
    """Every gap with its error type, region and decision; the regions to mask, the masked genome and how far it is better.

    Gaps without support near them fall back on synteny. gaps: gap_key, query_contig, gap_pos; lens: seq_id, seq_length."""
    near = kept(Y.analyses(Y.gap_evidence(alignments, gaps), every=True))
    more = Y.analyses(Y.fallback_support(alignments, gaps, near))
    decided = kept(Y.repair_decision(near.where("error_type is not null").unionByName(more)).withColumnRenamed("query_contig", "seq_id"))
    cut = decided.where(mode).join(lens.select("seq_id", "seq_length"), "seq_id").select("seq_id", F.greatest(F.lit(1), "replace_start").cast("bigint").alias("start"), F.least("replace_end", "seq_length").alias("end"), "error_type", "confidence", "anchor_length").where("end >= start")
    merged = kept(Y.merge_regions(cut))
    edits = Y.mask_edits(merged, mask)
    runs = gaps.select(F.col("query_contig").alias("seq_id"), F.col("gap_pos").alias("start"), (F.col("gap_pos") + gap_size).alias("end"), F.lit(gap_size).cast("bigint").alias("length"))
    gone = decided.where(mode).select("seq_id", F.col("gap_pos").alias("start")).distinct()
    after = runs.join(gone, ["seq_id", "start"], "left_anti").select("length").unionByName(merged.select(F.lit(mask).cast("bigint").alias("length")))
    return {"decided": decided, "merged": merged, "edits": edits, "segments": E.apply_edits(edits, lens), "improvement": D.fix_improvement(runs, after, lens, new_lengths(lens, edits)), "stats": Y.repair_stats(decided)}


def patch_then_correct(alignments: DataFrame, gaps: DataFrame, ref_lengths: DataFrame, matches: DataFrame, lens: DataFrame, second: DataFrame | None = None, size: int = 100) -> dict[str, DataFrame]:
    """Patches first; sequences whose strategy asks for it are corrected, and their patches tried again on what the correction left.

    second: flank matches for the second try, in original coordinates (matches if None). They and the gaps are lifted through the
    masks; gaps that a mask has taken have no patch any more, and a patch that would cut into a mask is dropped. What is left is resolved and applied, and the
    final genome is that of the corrected sequences with it, and of the patched ones. Gaps are `size` long."""
    p = patch_gaps(alignments, gaps, ref_lengths, matches, lens)
    counts = p["patches"].groupBy(F.col("query_contig").alias("seq_id")).agg(F.count_distinct("gap_key").alias("n_gaps"), F.count_distinct(F.when(F.col("patch_no").isNotNull(), F.col("gap_key"))).alias("n_extracted"))
    applied = p["edits"].groupBy("seq_id").agg(F.count("*").alias("n_applied"))
    strategy = kept(Y.chrom_strategy(counts.join(applied, "seq_id", "left").fillna(0, ["n_applied"])))
    chosen = strategy.where(F.col("strategy").isin("no_patch_fixer", "full_fixer_reuse_patches")).select("seq_id")
    own = gaps.join(chosen, gaps["query_contig"] == chosen["seq_id"], "left_semi")
    c = correct_gaps(alignments, own, lens, mask=size, gap_size=size)
    few = lens.join(chosen, "seq_id", "left_semi")
    masks, after = kept(E.apply_edits(c["edits"], few)), kept(new_lengths(few, c["edits"]))
    runs = own.select(F.col("query_contig").alias("seq_id"), F.col("gap_pos").cast("bigint").alias("start"), (F.col("gap_pos") + size).cast("bigint").alias("end"), F.lit(size).cast("bigint").alias("length"), "gap_key", "gap_id")
    left = kept(M.lift_gaps(runs, masks, "correct").where("gap_id is not null"))
    hits = M.lift_hits((matches if second is None else second).join(chosen.withColumnRenamed("seq_id", "refid"), "refid", "left_semi").select(matches.columns), masks, after)
    asked = left.select("gap_key", F.col("seq_id").alias("query_contig"), F.col("start").alias("gap_pos"), "gap_id")
    tried = patch_gaps(M.lift_alignments(alignments.join(chosen.withColumnRenamed("seq_id", "query_contig"), "query_contig", "left_semi").select(alignments.columns), masks), asked, ref_lengths, hits, after)["offered"]
    again = kept(E.resolve(clear_of_masks(tried, masks).drop("gap_key")))
    fixed = c["decided"].groupBy("seq_id").agg(F.count(F.when(F.col("conservative"), 1)).alias("n_corrected"))
    repaired = M.compose(masks, E.apply_edits(again, after))
    segments = p["segments"].join(chosen, "seq_id", "left_anti").unionByName(repaired)
    genome = p["genome"].join(chosen, "seq_id", "left_anti").unionByName(new_lengths(after, again).withColumn("origin", F.lit("repaired")))
    return {"strategy": strategy.join(fixed, "seq_id", "left").fillna(0, ["n_corrected"]), "patch": p, "correct": c, "again": again, "segments": segments, "genome": genome}


def clear_of_masks(offered: DataFrame, masked: DataFrame) -> DataFrame:
    """Edits that cut into no run of Ns that a segment table has put in (its coordinates are the edits'). Both meet by place, never in pairs."""
    size = F.col("src_end") - F.col("src_start")
    parts = masked.where("kind = 'N'").select("seq_id", F.col("out_start").alias("lo"), (F.col("out_start") + size).alias("hi"), F.lit(True).alias("mask"))
    # an insertion stands between two bases: it is in a run that holds both
    rows = offered.select("seq_id", F.col("del_start").alias("start"), F.greatest("del_end", F.col("del_start") + 1).alias("end"), (F.col("del_end") == F.col("del_start")).alias("point")).distinct()
    hit = M.meet(rows, parts).where("not point or p_lo < start").select("seq_id", F.col("start").alias("del_start"), F.when(F.col("point"), F.col("start")).otherwise(F.col("end")).alias("del_end")).distinct()
    return offered.join(hit, ["seq_id", "del_start", "del_end"], "left_anti").select(offered.columns)


def correct_then_refill(alignments: DataFrame, gaps: DataFrame, lens: DataFrame, hits: DataFrame) -> dict[str, DataFrame]:
    """Correct the sequences that have gaps, keep the rest, then fill the masks from contigs."""
    c = correct_gaps(alignments, gaps, lens)
    after = new_lengths(lens, c["edits"])
    w = Window.partitionBy("seq_id").orderBy("del_start")
    at = F.col("del_start") + F.coalesce(F.sum(F.expr("src_end - src_start - (del_end - del_start)")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    masks = c["edits"].withColumn("start", at).select("seq_id", "start", (F.col("start") + F.col("src_end")).alias("end"), F.col("src_end").alias("length"))
    return {"correct": c, "fill": fill_gaps(after, masks, hits)}


def extract_repairs(alignments: DataFrame, contigs: DataFrame, arrays: DataFrame, most: int = 5_000_000, least_telomeres: int = 1) -> DataFrame:
    """Repair sequences off contigs: from the contig's start to the first good alignment's end (5'), or from the last one's start to its end (3').

    contigs: seq_id, seq_length; arrays: telomere arrays of the contigs. Regions without an array are left out; long ones are cut
    down to telomere and alignment. Returns label, description, contig, target, repair_end, start, end (1-based), turned, n_arrays."""
    d = T.directed(alignments)
    good = T.good_alignment(d, "5prime").unionByName(T.good_alignment(d, "3prime")).join(contigs.select(F.col("seq_id").alias("ref_contig"), "seq_length"), "ref_contig")
    five = F.col("repair_end") == "5prime"
    r = good.withColumns({"start": F.when(five, F.lit(1)).otherwise(F.col("s1")).cast("bigint"), "end": F.when(five, F.least("e1", "seq_length")).otherwise(F.col("seq_length")), "region_id": F.concat_ws("|", "ref_contig", "query_contig", "repair_end")}).where("end >= start")
    inside = T.in_region(arrays, r.select("region_id", F.col("ref_contig").alias("seq_id"), (F.col("start") - 1).alias("start"), "end"))
    r = T.truncated(r.join(inside, "region_id").where(F.col("n_arrays") >= least_telomeres), most)
    turned = F.col("is_reverse") & ~F.col("mostly_forward")
    kind = F.when(five, "first_alignment_with_preceding").otherwise("last_alignment_with_subsequent")
    label = S.repair_label(F.col("ref_contig"), F.col("query_contig"), F.col("cut_start"), F.col("cut_end"))
    return r.select(label.alias("label"), S.repair_description(F.col("cut_end") - F.col("cut_start") + 1, kind, F.col("query_contig"), F.col("repair_end")).alias("description"), F.col("ref_contig").alias("contig"), F.col("query_contig").alias("target"), "repair_end", F.col("cut_start").alias("start"), F.col("cut_end").alias("end"), turned.alias("turned"), "n_arrays")


def recover_telomeres(repairs: DataFrame, hits: DataFrame, status: DataFrame, strategy: str = "minimal_extension", both_ends: bool = False) -> dict[str, DataFrame]:
    """The chosen repair of each chromosome that lacks telomere repeats (of each end with both_ends), as edits, with the rebuilt segments.

    repairs: as extract_repairs gives them; hits: PAF rows of the repairs on the chromosomes, named by label and repair_end (column
    repair_end); status: telomere_status of all chromosomes. Repairs are tried from the longest on; strategy is one of T.STRATEGIES."""
    ranked = T.repair_groups(repairs.select(F.concat_ws("|", "label", "repair_end").alias("repair_id"), "target", (F.col("end") - F.col("start") + 1).alias("length")))
    own = repairs.withColumn("repair_id", F.concat_ws("|", "label", "repair_end")).join(ranked.select("repair_id", F.col("place").alias("attempt")), "repair_id")
    named = hits.withColumn("qryid", F.concat_ws("|", "qryid", "repair_end")).join(own.select(F.col("repair_id").alias("qryid"), "attempt"), "qryid")
    lacking = status.where("needs_repair").select(F.col("seq_id").alias("refid"), "has_5prime", "has_3prime")
    named = named.join(lacking, "refid").where("(repair_end = '5prime' and not has_5prime) or (repair_end = '3prime' and not has_3prime)")
    group = F.concat_ws("|", "refid", "repair_end") if both_ends else F.col("refid")
    tried = kept(T.merge_plan(T.validated(T.best_telomere_match(named)).withColumn("target", group)))
    chosen = kept(T.select_repair(tried.where("reason is null"), strategy, ("attempt", "hit_id")))
    # hits name their chromosomes, so each group has one of its own
    groups = tried.groupBy("target").agg(F.min("attempt").alias("group_ord"), F.first("target").alias("chromosome"))
    src = own.select(F.col("repair_id").alias("qryid"), "contig", "start", F.col("end").alias("stop"), "turned")
    # offsets within the repair sequence, turned back into the contig's
    minus = (F.col("strand") == "-") != F.col("turned")
    c = chosen.join(src, "qryid")
    lo = F.when(minus, F.col("stop") - F.col("src_end")).otherwise(F.col("start") - 1 + F.col("src_start"))
    hi = F.when(minus, F.col("stop") - F.col("src_start")).otherwise(F.col("start") - 1 + F.col("src_end"))
    edits = kept(c.select(F.col("refid").alias("seq_id"), "del_start", "del_end", F.lit("contig").alias("src_kind"), F.col("contig").alias("src_id"), lo.alias("src_start"), hi.alias("src_end"), F.when(minus, "-").otherwise("+").alias("strand"), F.lit(0).alias("priority")))
    lens = status.select("seq_id", "seq_length")
    return {"tried": tried, "chosen": chosen, "edits": E.resolve(edits), "segments": E.apply_edits(E.resolve(edits), lens), "outcomes": T.outcomes(tried, T.first_repairs(chosen, groups), groups), "stats": T.run_stats(chosen, tried)}


def chosen_contigs(sources: DataFrame) -> DataFrame:
    """sources (stage, priority, source, seq_id): for each stage the contigs of its first source that has any."""
    first = sources.groupBy("stage").agg(F.min("priority").alias("priority"))
    return sources.join(first, ["stage", "priority"])


def fragment_edits(frags: DataFrame, lens: DataFrame, joint: int = 100) -> DataFrame:
    """Edits that leave of each sequence its kept fragments (frags: with status), `joint` Ns between them; nothing of one without any.

    Sequences that lose no fragment are left as they are, and so are gaps of `joint` between two fragments that stay."""
    cut = frags.join(frags.where("status <> 'kept'").select("seq_id").distinct(), "seq_id", "left_semi")
    w = Window.partitionBy("seq_id").orderBy("start")
    good = cut.where("status = 'kept'")
    before = good.select("seq_id", F.coalesce(F.lag("end").over(w), F.lit(0)).cast("bigint").alias("del_start"), F.col("start").alias("del_end"), F.lag("end").over(w).isNotNull().alias("inner"), (F.col("piece") - F.lag("piece").over(w) == 1).alias("next"))
    before = before.where(~(F.col("inner") & F.col("next") & (F.col("del_end") - F.col("del_start") == joint))).drop("next")
    last = good.groupBy("seq_id").agg(F.max("end").alias("last"))
    tail = lens.join(cut.select("seq_id").distinct(), "seq_id", "left_semi").join(last, "seq_id", "left")
    tail = tail.select("seq_id", F.coalesce("last", F.lit(0)).cast("bigint").alias("del_start"), F.col("seq_length").alias("del_end"), F.lit(False).alias("inner"))
    size = F.when(F.col("inner"), F.lit(joint)).otherwise(F.lit(0)).cast("bigint").alias("src_end")
    return before.unionByName(tail).where("del_end > del_start").select("seq_id", "del_start", "del_end", F.lit("N").alias("src_kind"), F.lit(None).cast("string").alias("src_id"), F.lit(0).cast("bigint").alias("src_start"), size, F.lit("+").alias("strand"), F.lit(0).alias("priority"))


def lifted_status(status: DataFrame, segments: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Telomere status after edits: an end keeps its repeats if it is still the old sequence's end, and counts as without any if not."""
    s = segments.where("kind = 'seq'").join(before.select("seq_id", F.col("seq_length").alias("was")), "seq_id").join(after.select("seq_id", F.col("seq_length").alias("now")), "seq_id")
    ends = s.groupBy("seq_id").agg(F.max(F.expr("src_start = 0 and out_start = 0")).alias("head"), F.max(F.expr("src_end = was and out_start + src_end - src_start = now")).alias("tail"))
    old = status.select("seq_id", "left_repeats", "right_repeats").join(after.select("seq_id", "seq_length"), "seq_id").join(ends, "seq_id", "left")
    n = lambda c, end: F.when(F.col(end), F.col(c)).otherwise(F.lit(0)).cast("bigint").alias(c)
    return T.telomere_status(old.select("seq_id", "seq_length", n("left_repeats", "head"), n("right_repeats", "tail")))


#: The rounds of edits, with their stages and what later rounds read besides lengths, gaps and status.
ROUNDS = (("fill", "fill"), ("fill", "filter"), ("fill", "fill again"), ("patch", "patch"), ("correct", "correct"), ("correct", "refill"), ("telomere", "telomere"))
_READ = {"patch": ("alignments", "matches"), "correct": ("alignments",), "telomere": ("end_hits",)}


def repair_genome(lens: DataFrame, gaps: DataFrame, alignments: DataFrame, ref_lengths: DataFrame, matches: DataFrame, fill_hits: DataFrame, repairs: DataFrame, end_hits: DataFrame, status: DataFrame, fill_again: DataFrame | None = None, refill_hits: DataFrame | None = None, stages: tuple = ("fill", "patch", "correct", "telomere"), least_fragment: int = 100_000, size: int = 100, mode: str = "conservative") -> dict[str, DataFrame]:
    """The four stages one after another, each on the genome that the one before left; a stage that is left out passes its input on.

    fill: gaps from flank hits, then small fragments dropped where gaps are left, then the joints from fill_again; patch; correct: masks, then
    these from refill_hits; telomere. All inputs have the original coordinates: after each round of edits alignments, flank
    matches, end hits, gaps and telomere status are cut and moved to the new sequences. Fill hits of each round name the gaps as they are
    numbered then (contigs aren't edited). gaps: gap_key, query_contig, gap_pos, gap_id, each of `size` Ns; lens: seq_id, seq_ord, seq_length.
    Returns steps (a row a round: edits, sequences changed, bases and gaps after it), segments (the final genome in terms of the original
    sequences and the sources), and lens, gaps and status of the final genome. Tables of earlier rounds are deleted."""
    runs = D.islands(gaps.select(F.col("query_contig").alias("seq_id"), F.col("gap_pos").cast("bigint").alias("start"), (F.col("gap_pos") + size).cast("bigint").alias("end"), F.struct(F.col("gap_pos").alias("p"), "gap_key", "gap_id").alias("who")), ["seq_id"])
    runs = runs.groupBy("seq_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("who").alias("who")).select("seq_id", "start", "end", (F.col("end") - F.col("start")).alias("length"), "who.gap_key", "who.gap_id")
    counts = T.telomere_status(status.select("seq_id", "seq_length", "left_repeats", "right_repeats"))
    state = {"lens": kept(lens), "gaps": kept(runs), "segments": kept(M.whole(lens)), "status": kept(counts), "alignments": alignments, "matches": matches, "end_hits": end_hits}
    own = {state[t].kept_at for t in ("lens", "gaps", "segments", "status")}  # tables that later rounds may delete
    none = fill_hits.limit(0)

    def edits_of(name: str) -> DataFrame:
        lens, gaps = state["lens"], state["gaps"]
        asked = gaps.select("gap_key", F.col("seq_id").alias("query_contig"), F.col("start").alias("gap_pos"), "gap_id")
        if name == "filter":
            left = lens.join(gaps.select("seq_id").distinct(), "seq_id", "left_semi")
            return fragment_edits(D.fragment_status(D.fragments(gaps, left), least_fragment), left, size)
        if name == "patch":
            return patch_gaps(state["alignments"], asked, ref_lengths, state["matches"], lens)["edits"]
        if name == "correct":
            return correct_gaps(state["alignments"], asked, lens, mode, size, size)["edits"]
        if name == "telomere":
            return recover_telomeres(repairs, state["end_hits"], state["status"])["edits"]
        hits = {"fill": fill_hits, "fill again": fill_again, "refill": refill_hits}[name]
        return fill_gaps(lens, gaps.select("seq_id", "start", "end", "length"), none if hits is None else hits)["edits"]

    rows = []
    for place, (stage, name) in enumerate(ROUNDS):
        ran = stage in stages
        later = {t for s, _ in ROUNDS[place + 1 :] if s in stages for t in _READ.get(s, ())}
        with only() as held:
            done = lens.limit(0).agg(F.count("*").alias("n_edits"), F.count("*").alias("n_changed"))
            if ran:
                edits = kept(edits_of(name))
                segments = kept(E.apply_edits(edits, state["lens"]))
                after = kept(new_lengths(state["lens"], edits).where("seq_length > 0"))
                new = {"lens": after, "gaps": kept(M.lift_gaps(state["gaps"], segments, name)), "segments": kept(M.compose(state["segments"], segments)), "status": kept(lifted_status(state["status"], segments, state["lens"], after))}
                lifts = {"alignments": lambda t: M.lift_alignments(t, segments), "matches": lambda t: M.lift_hits(t, segments, after), "end_hits": lambda t: M.lift_hits(t, segments, after)}  # noqa: B023
                new |= {t: kept(lifts[t](state[t])) for t in later}
                done = edits.agg(F.count("*").alias("n_edits"), F.count_distinct("seq_id").alias("n_changed"))
                dropped(*(state[t] for t in new if state[t].__dict__.get("kept_at") in own))
                own |= {df.kept_at for df in new.values()}
                state |= new
            row = done.crossJoin(state["lens"].agg(F.coalesce(F.sum("seq_length"), F.lit(0)).cast("bigint").alias("bases"))).crossJoin(state["gaps"].agg(F.count("*").alias("n_gaps")))
            rows.append(kept(row.select(F.lit(place + 1).alias("place"), F.lit(stage).alias("stage"), F.lit(name).alias("round"), F.lit(ran).alias("ran"), "n_edits", "n_changed", "bases", "n_gaps")))
            held += [rows[-1], *state.values()]
    steps = rows[0]
    for row in rows[1:]:
        steps = steps.unionByName(row)
    return {"steps": steps, **{t: state[t] for t in ("segments", "lens", "gaps", "status")}}


def batch_counts(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """Batch runs carry a sample column through every operator; here, the samples that gave rows and those that gave none."""
    ok = rows.select("sample").distinct().withColumn("ok", F.lit(True))
    return samples.select("sample").distinct().join(ok, "sample", "left").agg(F.count("ok").alias("n_ok"), F.count(F.when(F.col("ok").isNull(), 1)).alias("n_failed"))
