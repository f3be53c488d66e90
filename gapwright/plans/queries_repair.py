"""Queries of the composites: fill, patch, correct, recover, and the whole repair.

Inputs are derived tables. A gap of `gap_positions` and a flank hit of `flank_paf` belong together by the order they come from; the 20
chromosomes count 6,000,000 bases each, the 8 reference contigs 300,000."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as S
from ..operators import gaps as D
from ..operators import telomere as T
from ..sources.scratch import kept
from . import pipelines as N
from .fixtures import fixture
from .queries_align import AL, HITS, INSIDE, MERGED, NEAR, WIN, cuts_sql
from .queries_gaps import gaps_sql
from .queries_telomere import ARRAYS, DIR, STATUS
from .registry import query

CHROMOSOMES, BASES, CONTIG = 20, 6_000_000, 300_000


def _al(s, d):
    return fixture(s, d, "alignments")


def _gaps(s, d):
    at = F.expr("gap_key div 20").cast("string")
    return fixture(s, d, "gap_positions").withColumn("gap_id", F.concat(F.lit("chr"), (F.col("gap_key") % 20).cast("string"), F.lit("."), at))


def _lens(s, d):
    return _gaps(s, d).select(F.col("query_contig").alias("seq_id")).distinct().select("seq_id", F.substring("seq_id", 4, 9).cast("bigint").alias("seq_ord"), F.lit(BASES).cast("bigint").alias("seq_length"))


def _refs(s, d):
    return _al(s, d).select("ref_contig").distinct().withColumn("ref_length", F.lit(CONTIG).cast("bigint"))


def _paf(s, d):
    return fixture(s, d, "flank_paf")


def _matches(s, d):
    """Flanks of patches, matched near their gaps."""
    return fixture(s, d, "patch_paf")


def _patched(s, d):
    return N.patch_gaps(_al(s, d), _gaps(s, d), _refs(s, d), _matches(s, d), _lens(s, d))


def _status(s, d):
    """Of the chromosomes: telomere repeats as counted in the derived sequences of the same names."""
    return T.telomere_status(T.end_repeat_counts(fixture(s, d, "telo_seqs"))).join(_lens(s, d).select("seq_id", F.lit(BASES).cast("bigint").alias("n")), "seq_id").withColumn("seq_length", F.col("n")).drop("n")


@query("N1_analyze_genome", STATUS + gaps_sql("", 10).replace("WITH runs", ", runs", 1).replace("FROM seqs", "FROM (SELECT seq_id, seq_ord, upper(bases) AS bases FROM telo_seqs) u") + """SELECT st.seq_id, st.seq_length, CASE WHEN has_5prime AND has_3prime THEN 'complete' WHEN has_5prime THEN 'missing_3prime' WHEN has_3prime THEN 'missing_5prime' ELSE 'missing_both' END AS status, coalesce(g.n, 0) AS n_gaps, coalesce(g.t, 0) AS gap_bases FROM st LEFT JOIN (SELECT seq_id, count(*) AS n, cast(sum(length) AS bigint) AS t FROM gaps GROUP BY seq_id) g USING (seq_id)""", "telo_seqs")
def n1(s, d):
    return N.analyze_genome(fixture(s, d, "telo_seqs"), least_gap=10, internal_flank=2_000)["sequences"].select("seq_id", "seq_length", "status", "n_gaps", "gap_bases")


@query("N1b_structure")
def n1b(s, d):
    """Fragments and the structure track of each sequence, as the analysis gives them."""
    return N.analyze_genome(fixture(s, d, "telo_seqs"), least_gap=10, internal_flank=2_000)["sequences"].select("seq_id", "n_fragments", "track")


FILL = gaps_sql("", 10) + HITS.replace("WITH hits", ", hits", 1).replace("FROM flank_paf", "FROM fill_paf") + """,
ng AS (SELECT *, seq_id || '.' || row_number() OVER (PARTITION BY seq_id ORDER BY start) AS gap_id FROM gaps),
done AS (SELECT n.*, b.refid, b.strand, b.fill_start, b.fill_end FROM ng n JOIN best b USING (gap_id)) """


def _filled(s, d):
    q = fixture(s, d, "seqs")
    return N.fill_gaps(D.lengths(q), D.find_gaps(D.chunk_sequences(q), 10), fixture(s, d, "fill_paf"))


@query("N2_fill_gaps", FILL + """SELECT l.seq_id, cast(count(n.gap_id) AS bigint) AS n_gaps, cast(count(f.gap_id) AS bigint) AS n_filled, cast(any_value(seq_length) + coalesce(sum(f.fill_end - f.fill_start - f.length), 0) AS bigint) AS new_length
 FROM lens l LEFT JOIN ng n USING (seq_id) LEFT JOIN done f USING (gap_id) GROUP BY l.seq_id""", "seqs", "fill_paf")
def n2(s, d):
    f = _filled(s, d)
    new = f["segments"].groupBy("seq_id").agg(F.max(F.expr("out_start + src_end - src_start")).alias("new_length"))
    n = N.numbered_gaps(D.find_gaps(D.chunk_sequences(fixture(s, d, "seqs")), 10)).join(f["detail"], "gap_id").groupBy("seq_id").agg(F.count("*").alias("n_gaps"), F.count("source").alias("n_filled"))
    return D.lengths(fixture(s, d, "seqs")).select("seq_id").join(n, "seq_id", "left").join(new, "seq_id", "left").fillna(0)


@query("N2b_fill_edits", FILL + """SELECT seq_id, start AS del_start, "end" AS del_end, refid AS src_id, fill_start AS src_start, fill_end AS src_end, strand FROM done""", "seqs", "fill_paf")
def n2b(s, d):
    return _filled(s, d)["edits"].select("seq_id", "del_start", "del_end", "src_id", "src_start", "src_end", "strand")


@query("N2c_fill_closure", FILL + """SELECT (SELECT count(*) FROM ng) AS before, (SELECT count(*) FROM ng) - (SELECT count(*) FROM done) AS after, (SELECT count(*) FROM done) AS closed, round(100 * (SELECT count(*) FROM done) / (SELECT count(*) FROM ng), 6) AS rate""", "seqs", "fill_paf")
def n2c(s, d):
    return _filled(s, d)["closure"].withColumn("rate", F.round("rate", 6))


def _again(sql: str) -> str:
    """The best fills of a second table of hits, beside the first's."""
    return sql.replace("hits", "hits2").replace("pairs", "pairs2").replace("best", "best2")


TWICE = gaps_sql("", 10) + HITS.replace("WITH hits", ", hits", 1).replace("FROM flank_paf", "FROM (SELECT * FROM fill_paf WHERE mapq >= 30) f") + _again(HITS.replace("WITH hits", ", hits", 1)).replace("FROM flank_paf", "FROM (SELECT * FROM fill_paf WHERE mapq < 30) f") + """,
ng AS (SELECT *, seq_id || '.' || row_number() OVER (PARTITION BY seq_id ORDER BY start) AS gap_id FROM gaps),
done AS (SELECT n.*, b.fill_end - b.fill_start - n.length AS d FROM ng n JOIN best b USING (gap_id)),
shifted AS (SELECT n.seq_id, n.length, n.start + coalesce((SELECT sum(d) FROM done x WHERE x.seq_id = n.seq_id AND x.start < n.start), 0) AS s FROM ng n WHERE n.gap_id NOT IN (SELECT gap_id FROM done)),
len1 AS (SELECT l.seq_id, l.seq_length + coalesce(sum(d), 0) AS n FROM lens l LEFT JOIN done USING (seq_id) GROUP BY l.seq_id, l.seq_length),
fr AS (SELECT seq_id, s - coalesce(lag(s + length) OVER (PARTITION BY seq_id ORDER BY s), 0) AS size FROM shifted UNION ALL SELECT seq_id, n - coalesce((SELECT max(s + length) FROM shifted x WHERE x.seq_id = len1.seq_id), 0) FROM len1),
jt AS (SELECT seq_id, seq_id || '.' || unnest(range(1, k)) AS gap_id FROM (SELECT seq_id, count(*) AS k FROM fr WHERE size >= 500 GROUP BY seq_id) t) """


@query("E20_two_round_fill", TWICE + """SELECT 1 AS round, (SELECT count(*) FROM ng) AS gaps_before, (SELECT count(*) FROM shifted) AS gaps_after UNION ALL SELECT 2, (SELECT count(*) FROM jt), (SELECT count(*) FROM jt WHERE gap_id NOT IN (SELECT gap_id FROM best2))""", "seqs", "fill_paf")
def e20(s, d):
    """The hits of high mapq serve the first round, the others the second."""
    q, hits = fixture(s, d, "seqs"), fixture(s, d, "fill_paf")
    return N.two_round_fill(D.lengths(q), D.find_gaps(D.chunk_sequences(q), 10), hits.where("mapq >= 30"), hits.where("mapq < 30"), 500, 100)


PATCH = NEAR + INSIDE + cuts_sql("""SELECT g.*, p.*, CASE WHEN 20000 <= pl THEN 10000 WHEN pl // 4 >= 20 THEN pl // 4 ELSE least(100, pl // 2) END AS lf, CASE WHEN 20000 <= pl THEN 10000 WHEN pl // 4 >= 20 THEN pl // 4 ELSE least(100, pl // 2) END AS rf, 6000000 AS sl
 FROM gate g JOIN (SELECT 'chr' || (gap_key % 20) || '.' || (gap_key // 20) AS gid, q.gap_pos AS gs, q.query_contig, r.*, patch_end - patch_start + 1 AS pl, row_number() OVER (PARTITION BY gap_key ORDER BY r.ref_contig) AS no FROM reg r JOIN gap_positions q USING (gap_key)) p ON p.gid = g.gap_id AND p.no = 1""").replace("WITH sc", ", sc", 1).replace("FROM flank_paf", "FROM inside") + """,
offered AS (SELECT gap_key, query_contig AS seq_id, left_cut AS del_start, greatest(left_cut, right_cut) AS del_end, ref_contig AS src_id, (direction < 0) <> (ls = '-' AND rs = '-') AS turned, patch_start, patch_end, ins_start, ins_end FROM cuts WHERE abs(ins_end - ins_start - removed) > 100) """


@query("N3_patch_gaps", PATCH + """SELECT gap_key, seq_id, cast(del_start AS bigint) AS del_start, cast(del_end AS bigint) AS del_end, src_id, cast(CASE WHEN turned THEN patch_end - ins_end ELSE patch_start - 1 + ins_start END AS bigint) AS src_start, cast(CASE WHEN turned THEN patch_end - ins_start ELSE patch_start - 1 + ins_end END AS bigint) AS src_end, CASE WHEN turned THEN '-' ELSE '+' END AS strand FROM offered""", "alignments", "gap_positions", "patch_paf")
def n3(s, d):
    return _patched(s, d)["offered"].select("gap_key", "seq_id", "del_start", "del_end", "src_id", "src_start", "src_end", "strand")


@query("N3b_patched_genome")
def n3b(s, d):
    """Edits that stay after overlaps are resolved, as the rebuilt genome's lengths."""
    return _patched(s, d)["genome"].select("seq_id", "seq_length", "origin")


@query("N4_correct_gaps", WIN + "SELECT gap_key, error_type, confidence, replace_start, replace_end, in_error_region, large_distance, conservative, aggressive FROM dec", "alignments", "gap_positions")
def n4(s, d):
    """The SQL leaves the fallback on synteny out: no gap of the derived table needs it (tests have such gaps)."""
    return N.correct_gaps(_al(s, d), _gaps(s, d), _lens(s, d))["decided"].select("gap_key", "error_type", "confidence", "replace_start", "replace_end", "in_error_region", "large_distance", "conservative", "aggressive")


@query("N4b_improvement", MERGED + """SELECT n AS gaps_before, m AS gaps_after, round(100 * (n - m) / greatest(n, 1), 6) AS gaps_percent, 100 * n AS length_before, 100 * m AS length_after, round(100 * (100 * n - 100 * m) / greatest(100 * n, 1), 6) AS length_percent, round(100 * 100 * n / b, 6) AS coverage_before, round(100 * 100 * m / (b + d), 6) AS coverage_after
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE (query_contig, gap_pos) NOT IN (SELECT (p.query_contig, p.gap_pos) FROM dec JOIN gap_positions p USING (gap_key) WHERE conservative)) + (SELECT count(*) FROM mg) AS m, 6000000 * count(DISTINCT query_contig) AS b FROM gap_positions) g, (SELECT cast(sum(100 - ("end" - start + 1)) AS bigint) AS d FROM mg) k""", "alignments", "gap_positions")
def n4b(s, d):
    out = N.correct_gaps(_al(s, d), _gaps(s, d), _lens(s, d))["improvement"]
    return out.withColumns({c: F.round(c, 6) for c in ("gaps_percent", "length_percent", "coverage_before", "coverage_after")})


FIVE = PATCH + WIN.replace(AL, "", 1) + """,
cnt AS (SELECT g.query_contig AS seq_id, count(DISTINCT g.gap_key) AS n_gaps, count(DISTINCT r.gap_key) AS n_extracted FROM gap_positions g LEFT JOIN reg r USING (gap_key) GROUP BY 1),
st AS (SELECT *, CASE WHEN n_gaps = 0 THEN 'no_gaps' WHEN n_extracted = 0 THEN 'no_patch_fixer' WHEN seq_id NOT IN (SELECT seq_id FROM offered WHERE cast(seq_id[4:] AS int) % 3 <> 0) THEN 'full_fixer_reuse_patches' ELSE 'partial_success_no_fixer' END AS strategy FROM cnt) """


#: Derived tables on chromosomes of twenty times the length, where alignments lie apart and few gaps are crossed.
WIDE = lambda text: text.replace("FROM alignments", "FROM wide_alignments").replace("gap_positions", "wide_gaps").replace("patch_paf", "wide_paf").replace("6000000", "120000000")


def _wide(s, d):
    """Alignments, gaps, patch matches and lengths there."""
    gaps = _gaps(s, d).withColumn("gap_pos", 20 * F.col("gap_pos"))
    return fixture(s, d, "wide_alignments"), gaps, fixture(s, d, "wide_paf"), _lens(s, d).withColumn("seq_length", F.lit(20 * BASES).cast("bigint"))


def _five(s, d):
    """Flanks of every third chromosome's patches match only in the second try."""
    al, gaps, hits, lens = _wide(s, d)
    first = hits.where(F.substring("refid", 4, 9).cast("int") % 3 != 0)
    return N.patch_then_correct(al, gaps, _refs(s, d), first, lens, second=hits)


@query("N5_patch_then_correct", WIDE(FIVE) + WIDE("""SELECT seq_id, n_gaps, n_extracted, strategy, CASE WHEN strategy IN ('no_patch_fixer', 'full_fixer_reuse_patches') THEN (SELECT count(*) FROM dec JOIN gap_positions g USING (gap_key) WHERE g.query_contig = st.seq_id AND conservative) ELSE 0 END AS n_corrected FROM st"""), "wide_alignments", "wide_gaps", "wide_paf")
def n5(s, d):
    return _five(s, d)["strategy"].select("seq_id", "n_gaps", "n_extracted", "strategy", "n_corrected")


@query("N5d_patches_after_correction")
def n5d(s, d):
    """The patches that the second try places between the masks."""
    return _five(s, d)["again"]


@query("N5e_final_genome")
def n5e(s, d):
    return _five(s, d)["genome"].select("seq_id", "seq_length", "origin")


@query("N5c_correct_then_refill", MERGED + HITS.replace("WITH hits", ", hits", 1) + """SELECT k.gap_id, CASE WHEN b.refid IS NULL THEN 'Not_closed' ELSE 'Closed' END AS status, b.refid AS source, b.fill_start, b.fill_end, b.fill_end - b.fill_start AS fill_length, b.strand, round(b.score, 6) AS identity
 FROM (SELECT seq_id || '.' || row_number() OVER (PARTITION BY seq_id ORDER BY start) AS gap_id FROM mg) k LEFT JOIN best b USING (gap_id)""", "alignments", "gap_positions", "flank_paf")
def n5c(s, d):
    return N.correct_then_refill(_al(s, d), _gaps(s, d), _lens(s, d), _paf(s, d))["fill"]["detail"].withColumn("identity", F.round("identity", 6))


def _repairs(s, d):
    """Written once: labels, regions and hits all start from it."""
    return kept(_extracted(s, d))


def _extracted(s, d):
    contigs = _refs(s, d).select(F.col("ref_contig").alias("seq_id"), F.col("ref_length").alias("seq_length"))
    q = fixture(s, d, "telo_seqs").withColumn("seq_id", F.concat(F.lit("ctg"), (F.col("seq_ord") % 8).cast("string")))
    # the contigs' arrays: those of all derived sequences dealt to them
    arrays = T.telomere_arrays(D.chunk_sequences(q.withColumn("seq_id", F.concat_ws("/", "seq_id", F.col("seq_ord").cast("string")))), 5, 30)
    arrays = arrays.withColumn("seq_id", F.split_part("seq_id", F.lit("/"), F.lit(1)))
    return N.extract_repairs(_al(s, d), contigs, arrays)


def _end_hits(s, d, repairs):
    """Hits of the repair sequences: flank hits of the same contig, chromosome and end."""
    p = _paf(s, d).withColumns({"refid0": F.col("refid"), "target": F.split_part("qryid", F.lit("."), F.lit(1)), "repair_end": F.when(F.col("qryid").endswith("L"), "5prime").otherwise("3prime")})
    return p.join(repairs.select(F.col("contig").alias("refid0"), "target", "repair_end", "label", (F.col("end") - F.col("start") + 1).alias("size")), ["refid0", "target", "repair_end"]).select(F.col("label").alias("qryid"), "repair_end", F.greatest("size", "qryend").alias("qrylen"), "qrystart", "qryend", "strand", F.col("target").alias("refid"), F.lit(BASES).cast("bigint").alias("reflen"), "refstart", "refend", "matches", "alnlen", "mapq", "hit_id")


REPAIRS = DIR.rstrip() + ", " + ARRAYS.replace("{r}", "5").replace("{b}", "30").rstrip() + """,
carried AS (SELECT 'ctg' || (seq_ord % 8) AS contig, start AS a0, "end" AS a1 FROM arrays JOIN telo_seqs USING (seq_id)),
side AS (""" + " UNION ALL ".join(f"""SELECT g.ref_contig, g.query_contig, '{k}prime' AS repair_end, fr >= 0.5 AS ahead, CASE WHEN fr >= 0.5 AND g.is_reverse THEN f.s1 ELSE g.s1 END AS s1, CASE WHEN fr >= 0.5 AND g.is_reverse THEN f.e1 ELSE g.e1 END AS e1, g.is_reverse AND fr < 0.5 AS turned
 FROM good g JOIN ratio USING (ref_contig, query_contig) LEFT JOIN (SELECT * FROM good WHERE NOT is_reverse AND d{k} = 1) f USING (ref_contig, query_contig) WHERE g.r{k} = 1 AND NOT (fr >= 0.5 AND g.is_reverse AND f.aln_id IS NULL)""" for k in (5, 3)) + """),
span AS (SELECT *, CASE WHEN repair_end = '5prime' THEN 1 ELSE s1 END AS a, CASE WHEN repair_end = '5prime' THEN least(e1, 300000) ELSE 300000 END AS b FROM side),
rep AS (SELECT ref_contig || '_' || split_part(query_contig, '_', 1) || '_' || a || '_' || b AS label, ref_contig AS contig, query_contig AS target, repair_end, cast(a AS bigint) AS start, cast(b AS bigint) AS "end", turned, n_arrays
 FROM (SELECT s.*, (SELECT count(*) FROM carried c WHERE c.contig = s.ref_contig AND a0 >= a - 1 AND a1 <= b) AS n_arrays FROM span s WHERE b >= a) t WHERE n_arrays >= 1)
"""


@query("G13b_repair_sequences", REPAIRS + """SELECT label, 'length:' || ("end" - start + 1) || ' region_type:' || CASE WHEN repair_end = '5prime' THEN 'first_alignment_with_preceding' ELSE 'last_alignment_with_subsequent' END || ' aligned_to:' || target || '_' || repair_end AS description, contig, target, repair_end, start, "end", turned, n_arrays FROM rep""", "alignments", "telo_seqs")
def g13b(s, d):
    """Labels, fields, slices and turns of all repair sequences, both ends. (No region is long enough to be cut; G11 has such.)"""
    return _repairs(s, d)


def _recover_sql(group: str, score: str, body: str) -> str:
    """Recovery with one repair for each value of group."""
    return REPAIRS.rstrip() + ", " + STATUS.replace("WITH cnt", "cnt", 1).rstrip() + f""",
lack AS (SELECT st.seq_id, has_5prime, has_3prime FROM st WHERE NOT (has_5prime AND has_3prime) AND seq_id IN (SELECT query_contig FROM gap_positions)),
tri AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY "end" - start DESC, label || '|' || repair_end) AS attempt FROM rep),
hit AS (SELECT r.*, h.qrystart, h.qryend, h.strand, h.refend, h.mapq, h.alnlen, h.hit_id, greatest(r."end" - r.start + 1, h.qryend) AS qlen, h.matches / h.alnlen AS idn
 FROM flank_paf h JOIN tri r ON r.contig = h.refid AND r.target = split_part(h.qryid, '.', 1) AND r.repair_end = CASE WHEN right(h.qryid, 1) = 'L' THEN '5prime' ELSE '3prime' END
 JOIN lack l ON l.seq_id = r.target WHERE r.repair_end = '5prime' AND NOT has_5prime OR r.repair_end = '3prime' AND NOT has_3prime),
scored AS (SELECT *, idn * (0.5e0 + 0.5e0 * least(1e0, alnlen / 5000e0)) * (0.7e0 + 0.3e0 * least(1e0, mapq / 60e0)) AS score, 0.4e0 * idn + 0.3e0 * least(1e0, alnlen / 10000e0) + 0.2e0 * least(1e0, mapq / 60e0) + 0.1e0 * ((qryend - qrystart) / qlen) AS quality FROM hit),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label, repair_end ORDER BY score DESC, hit_id) AS rn FROM scored) t WHERE rn = 1),
cut AS (SELECT *, CASE WHEN repair_end = '5prime' THEN 0 ELSE refend END AS del_start, CASE WHEN repair_end = '5prime' THEN refend ELSE 6000000 END AS del_end, CASE WHEN repair_end = '5prime' THEN 0 ELSE q END AS q0, CASE WHEN repair_end = '5prime' THEN q ELSE qlen END AS q1
 FROM (SELECT *, CASE WHEN strand = '-' THEN qlen - qrystart ELSE qryend END AS q FROM top WHERE idn >= 0.7e0 AND alnlen >= 100 AND mapq >= 20 AND quality >= 0.5e0) t),
won AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY selection DESC, attempt, hit_id) AS place FROM (SELECT *, round({score}, 9) AS selection FROM (SELECT *, greatest(0e0, 1e0 - least(1e0, abs(q1 - q0 - (del_end - del_start)) / 100000e0)) AS norm FROM cut) v) u) t WHERE place = 1),
edit AS (SELECT target AS seq_id, cast(del_start AS bigint) AS del_start, cast(del_end AS bigint) AS del_end, contig AS src_id, cast(CASE WHEN (strand = '-') <> turned THEN "end" - q1 ELSE start - 1 + q0 END AS bigint) AS src_start, cast(CASE WHEN (strand = '-') <> turned THEN "end" - q0 ELSE start - 1 + q1 END AS bigint) AS src_end, CASE WHEN (strand = '-') <> turned THEN '-' ELSE '+' END AS strand FROM won)
""" + body


LEAST_CHANGE = "0.6e0 * norm + 0.3e0 * quality + 0.1e0 * idn"
OWN_EDITS = ["seq_id", "del_start", "del_end", "src_id", "src_start", "src_end", "strand"]


@query("N6_recover_telomeres", _recover_sql("target", LEAST_CHANGE, "SELECT * FROM edit"), "alignments", "gap_positions", "flank_paf", "telo_seqs")
def n6(s, d):
    """One repair for each chromosome."""
    r = _repairs(s, d)
    return N.recover_telomeres(r, _end_hits(s, d, r), _status(s, d))["edits"].select(OWN_EDITS)


@query("N6b_recover_both_ends", _recover_sql("target, repair_end", "0.4e0 * norm + 0.3e0 * quality + 0.2e0 * idn + 0.1e0 * least(1e0, mapq / 60e0)", "SELECT * FROM edit e WHERE NOT EXISTS (SELECT 1 FROM edit o WHERE o.seq_id = e.seq_id AND o.del_start > e.del_start AND o.del_start < e.del_end)"), "alignments", "gap_positions", "flank_paf", "telo_seqs")
def n6b(s, d):
    """One for each end, by the balanced score; of two that overlap the 3' one stays."""
    r = _repairs(s, d)
    return N.recover_telomeres(r, _end_hits(s, d, r), _status(s, d), "balanced", both_ends=True)["edits"].select(OWN_EDITS)


def _genome(s, d, stages=("fill", "patch", "correct", "telomere")):
    """Each round has hits of its own: flank hits dealt by mapq, patch matches near their gaps, end hits of the repair sequences."""
    (al, gaps, matches, lens), hits = _wide(s, d), _paf(s, d)
    r, status = _repairs(s, d), _status(s, d).withColumn("seq_length", F.lit(20 * BASES).cast("bigint"))
    ends = _end_hits(s, d, r).withColumn("reflen", F.lit(20 * BASES).cast("bigint"))
    return N.repair_genome(lens, gaps, al, _refs(s, d), matches, hits.where("mapq >= 40"), r, ends, status, hits.where("mapq >= 20 and mapq < 40"), hits.where("mapq < 20"), stages, least_fragment=60_000)


@query("N7_repair_genome")
def n7(s, d):
    """A row a round, as the genome goes through all four stages."""
    return _genome(s, d)["steps"]


def _best_of(where: str, n: str) -> str:
    text = HITS.replace("WITH hits", ", hits", 1).replace("FROM flank_paf", f"FROM (SELECT * FROM flank_paf WHERE {where}) f")
    return text.replace("hits", "hits" + n).replace("pairs", "pairs" + n).replace("best", "best" + n)


STAGE1 = """WITH raw AS (SELECT DISTINCT query_contig AS seq_id, gap_pos AS s, gap_pos + 100 AS e FROM gap_positions),
isle AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY seq_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, max(e) OVER (PARTITION BY seq_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM raw) t),
run AS (SELECT *, seq_id || '.' || row_number() OVER (PARTITION BY seq_id ORDER BY s) AS gap_id FROM (SELECT seq_id, min(s) AS s, max(e) AS e FROM isle GROUP BY seq_id, k) t)""" + _best_of("mapq >= 40", "1") + _best_of("mapq >= 20 AND mapq < 40", "2") + """,
f1 AS (SELECT r.*, b.fill_end - b.fill_start - (r.e - r.s) AS d FROM run r JOIN best1 b USING (gap_id)),
len1 AS (SELECT q.seq_id, 6000000 + coalesce((SELECT sum(d) FROM f1 WHERE f1.seq_id = q.seq_id), 0) AS n FROM (SELECT DISTINCT seq_id FROM raw) q),
open1 AS (SELECT seq_id, s + coalesce(before, 0) AS s, e + coalesce(before, 0) AS e FROM (SELECT r.*, f1.gap_id AS done, sum(f1.d) OVER (PARTITION BY r.seq_id ORDER BY r.s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM run r LEFT JOIN f1 USING (gap_id)) t WHERE done IS NULL),
fr AS (SELECT * FROM (SELECT seq_id, coalesce(lag(e) OVER (PARTITION BY seq_id ORDER BY s), 0) AS a, s AS b FROM open1 UNION ALL SELECT seq_id, max(e), any_value(n) FROM open1 JOIN len1 USING (seq_id) GROUP BY seq_id) t WHERE b > a),
lossy AS (SELECT DISTINCT seq_id FROM fr WHERE b - a < 60000),
good AS (SELECT *, lag(b) OVER (PARTITION BY seq_id ORDER BY a) AS pb FROM fr WHERE b - a >= 60000 AND seq_id IN (SELECT seq_id FROM lossy)),
cut AS (SELECT seq_id, coalesce(pb, 0) AS c0, a AS c1, pb IS NOT NULL AS inner_ FROM good WHERE a > coalesce(pb, 0) AND NOT (pb IS NOT NULL AND a - pb = 100) UNION ALL SELECT l.seq_id, coalesce(m.last, 0), n, false FROM lossy l JOIN len1 USING (seq_id) LEFT JOIN (SELECT seq_id, max(b) AS last FROM good GROUP BY 1) m USING (seq_id) WHERE n > coalesce(m.last, 0)),
len2 AS (SELECT seq_id, n - coalesce((SELECT sum(c1 - c0 - CASE WHEN inner_ THEN 100 ELSE 0 END) FROM cut WHERE cut.seq_id = len1.seq_id), 0) AS n FROM len1),
left2 AS (SELECT seq_id, c0 AS s FROM cut WHERE inner_ UNION ALL SELECT seq_id, s FROM open1 o WHERE seq_id NOT IN (SELECT seq_id FROM lossy) OR EXISTS (SELECT 1 FROM good g WHERE g.seq_id = o.seq_id AND g.pb = o.s AND g.a = o.e AND g.a - g.pb = 100)),
run2 AS (SELECT seq_id, seq_id || '.' || row_number() OVER (PARTITION BY seq_id ORDER BY s) AS gap_id FROM left2),
f2 AS (SELECT r.seq_id, b.fill_end - b.fill_start - 100 AS d FROM run2 r JOIN best2 b USING (gap_id))
SELECT 1 AS place, 'fill' AS round, (SELECT count(*) FROM f1) AS n_edits, (SELECT count(DISTINCT seq_id) FROM f1) AS n_changed, (SELECT cast(sum(n) AS bigint) FROM len1) AS bases, (SELECT count(*) FROM open1) AS n_gaps
UNION ALL SELECT 2, 'filter', (SELECT count(*) FROM cut), (SELECT count(DISTINCT seq_id) FROM cut), (SELECT cast(sum(n) AS bigint) FROM len2), (SELECT count(*) FROM left2)
UNION ALL SELECT 3, 'fill again', (SELECT count(*) FROM f2), (SELECT count(DISTINCT seq_id) FROM f2), (SELECT cast(sum(n) AS bigint) FROM len2) + (SELECT cast(coalesce(sum(d), 0) AS bigint) FROM f2), (SELECT count(*) FROM run2) - (SELECT count(*) FROM f2)"""


@query("N7c_fill_stage", WIDE(STAGE1), "wide_gaps", "flank_paf")
def n7c(s, d):
    """The three rounds of the first stage."""
    return _genome(s, d, ("fill",))["steps"].where("ran").select("place", "round", "n_edits", "n_changed", "bases", "n_gaps")


@query("N8_choose_contigs", "WITH src AS (SELECT seq_ord % 3 AS stage, CASE WHEN seq_ord % 3 = 0 THEN seq_ord % 2 ELSE 1 + seq_ord % 2 END AS priority, seq_id FROM seqs) SELECT stage, priority, seq_id FROM src WHERE priority = (SELECT min(priority) FROM src m WHERE m.stage = src.stage)", "seqs")
def n8(s, d):
    stage, odd = F.col("seq_ord") % 3, F.col("seq_ord") % 2
    src = fixture(s, d, "seqs").select(stage.alias("stage"), F.when(stage == 0, odd).otherwise(1 + odd).alias("priority"), "seq_id")
    return N.chosen_contigs(src).select("stage", "priority", "seq_id")


@query("N9_batch_counts", "SELECT cast(count(*) FILTER (WHERE n > 0) AS bigint) AS n_ok, cast(count(*) FILTER (WHERE n = 0) AS bigint) AS n_failed FROM (SELECT q.query_contig, count(a.query_contig) AS n FROM (SELECT DISTINCT 'chr' || (o_orderkey % 25) AS query_contig FROM orders) q LEFT JOIN (SELECT DISTINCT query_contig FROM alignments) a USING (query_contig) GROUP BY 1) t", "alignments")
def n9(s, d):
    """A batch of 25 samples, of which those without alignments fail."""
    asked = s.read.parquet(f"{d}/orders.parquet").select(F.concat(F.lit("chr"), (F.col("o_orderkey") % 25).cast("string")).alias("sample")).distinct()
    return N.batch_counts(_al(s, d).select(F.col("query_contig").alias("sample")), asked)


@query("C1b_reverse_complement_flavours", "SELECT seq_id, reverse(translate(b, 'ACGT', 'TGCA')) AS four, reverse(translate(b, 'ACGTN', 'TGCAN')) AS five, reverse(translate(b, 'ACGTNacgtn', 'TGCANtgcan')) AS both FROM (SELECT seq_id, CASE WHEN seq_ord % 2 = 0 THEN lower(bases) ELSE bases END AS b FROM seqs) t", "seqs")
def c1b(s, d):
    b = F.when(F.col("seq_ord") % 2 == 0, F.lower("bases")).otherwise(F.col("bases"))
    return fixture(s, d, "seqs").select("seq_id", S.reverse_complement_as(b, "ACGT").alias("four"), S.reverse_complement_as(b, "ACGTN").alias("five"), S.reverse_complement_as(b, "ACGTNacgtn").alias("both"))


@query("C12b_repair_description", "SELECT hit_id, 'length:' || alnlen || ' region_type:' || CASE WHEN qryid LIKE '%L' THEN 'first_alignment_with_preceding' ELSE 'last_alignment_with_subsequent' END || ' aligned_to:' || split_part(qryid, '.', 1) || '_' || CASE WHEN qryid LIKE '%L' THEN '5prime' ELSE '3prime' END AS description FROM flank_paf", "flank_paf")
def c12b(s, d):
    left = F.col("qryid").endswith("L")
    kind = F.when(left, "first_alignment_with_preceding").otherwise("last_alignment_with_subsequent")
    return _paf(s, d).select("hit_id", S.repair_description(F.col("alnlen"), kind, F.split_part("qryid", F.lit("."), F.lit(1)), F.when(left, "5prime").otherwise("3prime")).alias("description"))
