"""Queries over telomeres, and the user-level composites."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as S
from ..operators import edits as E
from ..operators import fill as L
from ..operators import gaps as D
from ..operators import synteny as Y
from ..operators import telomere as T
from ..sources import sinks
from ..sources.scratch import kept
from . import pipelines as N
from .fixtures import fixture
from .queries_gaps import gaps_sql
from .registry import query

END = "((length(p) - length(replace(p, 'TTTAGGG', ''))) // 7 + (length(p) - length(replace(p, 'CCCTAAA', ''))) // 7)"
STATUS = f"""WITH cnt AS (SELECT seq_id, length(bases) AS seq_length, {END.replace('p,', 'substr(bases, 1, 2000),').replace('(p)', '(substr(bases, 1, 2000))')} AS left_repeats, {END.replace('p,', 'right(bases, 2000),').replace('(p)', '(right(bases, 2000))')} AS right_repeats FROM telo_seqs),
st AS (SELECT *, left_repeats >= 5 AS has_5prime, right_repeats >= 5 AS has_3prime FROM cnt)
"""
UNIT = """SELECT seq_id, '{u}' AS pattern, {n} AS unit, cast(o AS bigint) AS pos FROM (SELECT seq_id, sum(length(part)) OVER (PARTITION BY seq_id ORDER BY k) + (k - 1) * {n} AS o, k, m FROM (SELECT seq_id, unnest(string_split(bases, '{u}')) AS part, generate_subscripts(string_split(bases, '{u}'), 1) AS k, len(string_split(bases, '{u}')) AS m FROM telo_seqs) a) b WHERE k < m"""
ARRAYS = """occ AS (""" + " UNION ALL ".join(UNIT.replace("{u}", u).replace("{n}", str(len(u))) for u in T.UNITS) + """),
arr AS (SELECT seq_id, pattern, unit, min(pos) AS start, count(*) AS repeats FROM (SELECT *, pos - unit * row_number() OVER (PARTITION BY seq_id, pattern ORDER BY pos) AS chain FROM occ) t GROUP BY seq_id, pattern, unit, chain),
arrays AS (SELECT seq_id, pattern, start, start + unit * repeats AS "end", unit * repeats AS length, repeats FROM arr WHERE repeats >= {r} AND unit * repeats >= {b})
"""


def arrays_sql(body: str, r: int, b: int) -> str:
    return "WITH " + ARRAYS.replace("{r}", str(r)).replace("{b}", str(b)) + body


def _telo(s, d):
    return fixture(s, d, "telo_seqs")


def _status(s, d):
    return T.telomere_status(T.end_repeat_counts(_telo(s, d)))


def _arrays(s, d, r=10, b=70):
    return T.telomere_arrays(D.chunk_sequences(_telo(s, d)), r, b)


@query("G1_end_repeat_counts", STATUS + "SELECT seq_id, seq_length, left_repeats, right_repeats FROM cnt", "telo_seqs")
def g1(s, d):
    return T.end_repeat_counts(_telo(s, d))


@query("G2_telomere_status", STATUS + "SELECT seq_id, has_5prime, has_3prime, CASE WHEN has_5prime AND has_3prime THEN 'complete' WHEN has_5prime THEN 'missing_3prime' WHEN has_3prime THEN 'missing_5prime' ELSE 'missing_both' END AS status, NOT (has_5prime AND has_3prime) AS needs_repair FROM st", "telo_seqs")
def g2(s, d):
    return _status(s, d).select("seq_id", "has_5prime", "has_3prime", "status", "needs_repair")


@query("B7_telomere_table", STATUS + "SELECT seq_id, seq_length, left_repeats, right_repeats, has_5prime AND has_3prime AS complete FROM st", "telo_seqs")
def b7(s, d):
    return _status(s, d).select("seq_id", "seq_length", "left_repeats", "right_repeats", (F.col("has_5prime") & F.col("has_3prime")).alias("complete"))


@query("B8_fragment_rows", gaps_sql("""SELECT seq_id, 'gap_' || row_number() OVER (PARTITION BY seq_id ORDER BY start) AS name, start, "end", cast(length AS bigint) AS length FROM gaps""", 10), "seqs")
def b8(s, d):
    """The file of numbered gaps; B8b is that of the fragments."""
    return sinks.gap_rows(D.find_gaps(D.chunk_sequences(fixture(s, d, "seqs")), 10)).select("seq_id", "name", "start", "end", (F.col("end") - F.col("start")).alias("length"))


@query("G3_telomere_arrays", arrays_sql('SELECT seq_id, pattern, start, "end", length, repeats FROM arrays', 10, 70), "telo_seqs")
def g3(s, d):
    return _arrays(s, d)


INNER = """, inn AS (SELECT a.*, max("end") OVER (PARTITION BY seq_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM arrays a JOIN (SELECT seq_id, length(bases) AS seq_length FROM telo_seqs) l USING (seq_id) WHERE start >= 2000 AND "end" <= seq_length - 2000),
mrg AS (SELECT seq_id, min(start) AS start, max("end") AS "end", arg_min(pattern, (start, "end", pattern)) AS pattern, count(*) AS n FROM (SELECT *, sum(CASE WHEN pe IS NULL OR start > pe + 1000 THEN 1 ELSE 0 END) OVER (PARTITION BY seq_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS k FROM inn) t GROUP BY seq_id, k)
"""


@query("G4_internal_telomeres", arrays_sql(INNER + 'SELECT seq_id, start, "end", pattern, n FROM mrg', 10, 60), "telo_seqs")
def g4(s, d):
    return T.internal_telomeres(_arrays(s, d, 10, 60), D.lengths(_telo(s, d)), 2_000)


@query("G5_telomere_contigs", arrays_sql("""SELECT seq_id, any_value(length(bases)) AS seq_length, count(*) AS n_arrays, string_agg(pattern || ':' || start || '-' || "end", ';' ORDER BY start, "end", pattern) AS arrays FROM arrays JOIN telo_seqs USING (seq_id) GROUP BY seq_id""", 20, 120), "telo_seqs")
def g5(s, d):
    return T.telomere_contigs(D.lengths(_telo(s, d)), _arrays(s, d, 20, 120))


@query("G6_chromosome_ends", STATUS + """SELECT seq_id || '_5prime' AS end_id, seq_id, 0 AS start, least(seq_length, 3000) AS "end" FROM st WHERE NOT has_5prime UNION ALL SELECT seq_id || '_3prime', seq_id, greatest(0, seq_length - 3000), seq_length FROM st WHERE NOT has_3prime""", "telo_seqs")
def g6(s, d):
    return T.chromosome_ends(_status(s, d), 3_000)


DIR = """WITH dr AS (SELECT aln_id, ref_contig, query_contig, identity, least(ref_start, ref_end) AS s1, greatest(ref_start, ref_end) AS e1, abs(ref_end - ref_start) + 1 AS len1, query_start > query_end AS is_reverse FROM alignments),
ratio AS (SELECT ref_contig, query_contig, avg(CASE WHEN is_reverse THEN 0 ELSE 1 END) AS fr, count(*) AS n FROM dr GROUP BY ALL),
good AS (SELECT *, row_number() OVER (PARTITION BY ref_contig, query_contig ORDER BY s1, aln_id) AS r5, row_number() OVER (PARTITION BY ref_contig, query_contig ORDER BY e1 DESC, aln_id) AS r3,
  row_number() OVER (PARTITION BY ref_contig, query_contig, is_reverse ORDER BY s1, aln_id) AS d5, row_number() OVER (PARTITION BY ref_contig, query_contig, is_reverse ORDER BY e1 DESC, aln_id) AS d3 FROM dr WHERE identity >= 95 AND len1 >= 100)
"""


def good_sql(k: str) -> str:
    return DIR + f"""SELECT g.ref_contig, g.query_contig, CASE WHEN fr >= 0.5 AND g.is_reverse THEN f.aln_id ELSE g.aln_id END AS aln_id, fr >= 0.5 AND g.is_reverse AS substituted
FROM good g JOIN ratio USING (ref_contig, query_contig) LEFT JOIN (SELECT * FROM good WHERE NOT is_reverse AND d{k} = 1) f USING (ref_contig, query_contig) WHERE g.r{k} = 1 AND NOT (fr >= 0.5 AND g.is_reverse AND f.aln_id IS NULL)"""


def _directed(s, d):
    return T.directed(fixture(s, d, "alignments"))


@query("G7_alignment_direction", DIR + "SELECT ref_contig, query_contig, round(fr, 6) AS forward_ratio, n, fr >= 0.5 AS mostly_forward FROM ratio", "alignments")
def g7(s, d):
    return T.alignment_direction(_directed(s, d)).withColumn("forward_ratio", F.round("forward_ratio", 6))


@query("G8_first_good_alignment", good_sql("5"), "alignments")
def g8(s, d):
    return T.good_alignment(_directed(s, d), "5prime").select("ref_contig", "query_contig", "aln_id", "substituted")


@query("G9_forward_substitute", good_sql("3"), "alignments")
def g9(s, d):
    return T.good_alignment(_directed(s, d), "3prime").select("ref_contig", "query_contig", "aln_id", "substituted")


@query("G10_telomeres_in_region", arrays_sql("""SELECT seq_id AS region_id, count(*) AS n_arrays, min(start) AS tel_start, max("end") AS tel_end FROM arrays WHERE start >= 0 AND "end" <= 3500 GROUP BY seq_id""", 10, 60), "telo_seqs")
def g10(s, d):
    regions = D.lengths(_telo(s, d)).select(F.col("seq_id").alias("region_id"), "seq_id", F.lit(0).cast("bigint").alias("start"), F.lit(3500).cast("bigint").alias("end"))
    return T.in_region(_arrays(s, d, 10, 60), regions)


@query("G11_truncate_region", """WITH r AS (SELECT aln_id, 1 AS s, greatest(ref_start, ref_end) AS e, least(ref_start, ref_end) AS s1, greatest(ref_start, ref_end) AS e1, CASE WHEN aln_id % 2 = 0 THEN '5prime' ELSE '3prime' END AS side FROM alignments)
SELECT aln_id, CASE WHEN e - s + 1 > 50000 AND side = '3prime' THEN greatest(e - 49999, least(e, e1 - least(10000, e1 - s1 + 1) + 1)) ELSE s END AS cut_start, CASE WHEN e - s + 1 > 50000 AND side = '5prime' THEN least(s + 49999, greatest(s, s1 + least(10000, e1 - s1 + 1) - 1)) ELSE e END AS cut_end FROM r""", "alignments")
def g11(s, d):
    r = _directed(s, d).select("aln_id", F.lit(1).cast("bigint").alias("start"), F.col("e1").alias("end"), "s1", "e1", F.lit(None).cast("bigint").alias("tel_start"), F.lit(None).cast("bigint").alias("tel_end"), F.when(F.col("aln_id") % 2 == 0, "5prime").otherwise("3prime").alias("repair_end"))
    return T.truncated(r, 50_000).select("aln_id", "cut_start", "cut_end")


@query("G12_validate_extracted_end", arrays_sql("""SELECT seq_id, bool_or(start < 0.1 * seq_length) AS ok_5prime, bool_or("end" > 0.9 * seq_length) AS ok_3prime FROM arrays JOIN (SELECT seq_id, length(bases) AS seq_length FROM telo_seqs) l USING (seq_id) GROUP BY seq_id""", 10, 60), "telo_seqs")
def g12(s, d):
    return T.validated_ends(_arrays(s, d, 10, 60), D.lengths(_telo(s, d)))


@query("G13_extract_repair_sequences", good_sql("5").replace("SELECT g.ref_contig", "SELECT ref_contig || '_' || split_part(query_contig, '_', 1) || '_1_' || (SELECT e1 FROM dr WHERE dr.aln_id = z.aln_id) AS label, ref_contig, query_contig FROM (SELECT g.ref_contig") + ") z", "alignments")
def g13(s, d):
    """Ids of the repair sequences: from a contig's start to its chosen alignment's end."""
    t = T.good_alignment(_directed(s, d), "5prime")
    return t.select(S.repair_label(F.col("ref_contig"), F.col("query_contig"), F.lit(1), F.col("e1")).alias("label"), "ref_contig", "query_contig")


@query("C12_repair_label", "SELECT hit_id, refid || '_' || split_part(qryid, '.', 1) || '_' || refstart || '_' || refend AS label FROM flank_paf", "flank_paf")
def c12(s, d):
    p = fixture(s, d, "flank_paf")
    return p.select("hit_id", S.repair_label(F.col("refid"), F.split_part("qryid", F.lit("."), F.lit(1)), F.col("refstart"), F.col("refend")).alias("label"))


@query("G14_repair_groups", "SELECT hit_id AS repair_id, refid AS target, alnlen AS length, row_number() OVER (PARTITION BY refid ORDER BY alnlen DESC, hit_id) AS place FROM flank_paf", "flank_paf")
def g14(s, d):
    return T.repair_groups(fixture(s, d, "flank_paf").select(F.col("hit_id").alias("repair_id"), F.col("refid").alias("target"), F.col("alnlen").alias("length")))


MATCH = """WITH sc AS (SELECT *, idn * (0.5e0 + 0.5e0 * least(1e0, alnlen / 5000e0)) * (0.7e0 + 0.3e0 * least(1e0, mapq / 60e0)) AS score, 0.4e0 * idn + 0.3e0 * least(1e0, alnlen / 10000e0) + 0.2e0 * least(1e0, mapq / 60e0) + 0.1e0 * ((qryend - qrystart) / 12000e0) AS quality
  FROM (SELECT * EXCLUDE (qrylen), 12000 AS qrylen, matches / alnlen AS idn, CASE WHEN right(qryid, 1) = 'L' THEN '5prime' ELSE '3prime' END AS repair_end, split_part(qryid, '.', 1) AS target FROM flank_paf) a),
bst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qryid ORDER BY score DESC, hit_id) AS rn FROM sc) t WHERE rn = 1),
val AS (SELECT *, CASE WHEN idn < 0.7e0 THEN 'low_identity' WHEN alnlen < 100 THEN 'too_short' WHEN mapq < 20 THEN 'low_mapq' WHEN quality < 0.5e0 THEN 'low_quality' END AS reason FROM bst),
pl AS (SELECT *, CASE WHEN strand = '-' THEN qrylen - qrystart ELSE qryend END AS q_end FROM val),
plan AS (SELECT *, CASE WHEN repair_end = '5prime' THEN 0 ELSE refend END AS del_start, CASE WHEN repair_end = '5prime' THEN refend ELSE reflen END AS del_end, CASE WHEN repair_end = '5prime' THEN 0 ELSE q_end END AS src_start, CASE WHEN repair_end = '5prime' THEN q_end ELSE qrylen END AS src_end FROM pl),
ext AS (SELECT *, src_end - src_start - (del_end - del_start) AS extension FROM plan),
sel AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY selection DESC, hit_id) AS place FROM (SELECT *, round(0.6e0 * greatest(0e0, 1e0 - least(1e0, abs(extension) / 100000e0)) + 0.3e0 * quality + 0.1e0 * idn, 9) AS selection FROM ext WHERE reason IS NULL) t)
"""


def _matches(s, d):
    p = fixture(s, d, "flank_paf").withColumn("qrylen", F.lit(12_000).cast("bigint"))
    m = T.validated(T.best_telomere_match(p))
    return m.withColumns({"repair_end": F.when(F.col("qryid").endswith("L"), "5prime").otherwise("3prime"), "target": F.split_part("qryid", F.lit("."), F.lit(1))})


def _chosen(s, d):
    plans = T.merge_plan(_matches(s, d))
    return plans, T.select_repair(plans.where("reason is null"))


@query("G15_best_telomere_match", MATCH + "SELECT qryid, hit_id, round(score, 9) AS score FROM bst", "flank_paf")
def g15(s, d):
    return _matches(s, d).select("qryid", "hit_id", F.round("score", 9).alias("score"))


@query("G16_match_quality", MATCH + "SELECT qryid, round(quality, 9) AS quality FROM bst", "flank_paf")
def g16(s, d):
    return _matches(s, d).select("qryid", F.round("quality", 9).alias("quality"))


@query("G17_match_validation", MATCH + "SELECT qryid, reason FROM val", "flank_paf")
def g17(s, d):
    return _matches(s, d).select("qryid", "reason")


@query("G18_telomere_merge_plan", MATCH + "SELECT qryid, target, repair_end, del_start, del_end, src_start, src_end, extension FROM ext", "flank_paf")
def g18(s, d):
    return T.merge_plan(_matches(s, d)).select("qryid", "target", "repair_end", "del_start", "del_end", "src_start", "src_end", "extension")


@query("G19_select_repair", MATCH + "SELECT target, max(CASE WHEN place = 1 THEN qryid END) AS qryid, coalesce(string_agg(qryid, ',' ORDER BY place) FILTER (WHERE place > 1), '') AS alternatives FROM sel GROUP BY target", "flank_paf")
def g19(s, d):
    return _chosen(s, d)[1].select("target", "qryid", "alternatives")


#: The other strategies: repairs are tried from the longest match on; the first that works, or a balanced score.
TRIED = MATCH + """, att AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY alnlen DESC, hit_id) AS attempt FROM ext),
bal AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY selection DESC, attempt) AS place FROM (SELECT * , round(0.4e0 * greatest(0e0, 1e0 - least(1e0, abs(extension) / 100000e0)) + 0.3e0 * quality + 0.2e0 * idn + 0.1e0 * least(1e0, mapq / 60e0), 9) AS selection FROM att WHERE reason IS NULL) t)
"""


def _tried(s, d):
    from pyspark.sql import Window

    plans = T.merge_plan(_matches(s, d))
    return plans.withColumn("attempt", F.row_number().over(Window.partitionBy("target").orderBy(F.desc("alnlen"), "hit_id")))


@query("G19b_first_success", TRIED + "SELECT target, qryid, attempt, 1 AS n_successful, '' AS alternatives FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY attempt) AS nth FROM att WHERE reason IS NULL) t WHERE nth = 1", "flank_paf")
def g19b(s, d):
    return T.select_repair(_tried(s, d).where("reason is null"), "first_success", ("attempt",)).select("target", "qryid", "attempt", "n_successful", "alternatives")


@query("G19c_balanced", TRIED + "SELECT target, max(CASE WHEN place = 1 THEN qryid END) AS qryid, count(*) AS n_successful, coalesce(round(max(CASE WHEN place = 1 THEN selection END) - max(CASE WHEN place = 2 THEN selection END), 9) < 0.1e0, false) AS is_close FROM bal GROUP BY target", "flank_paf")
def g19c(s, d):
    return T.select_repair(_tried(s, d).where("reason is null"), "balanced", ("attempt",)).select("target", "qryid", "n_successful", "is_close")


@query("G19d_alternatives", TRIED + "SELECT target, place, qryid, selection, extension, round(idn, 9) AS identity, round(quality, 9) AS quality FROM bal", "flank_paf")
def g19d(s, d):
    """All plans that a choice was made from, with their scores, as rows."""
    ranked = T.ranked_repairs(_tried(s, d).where("reason is null"), "balanced", ("attempt",))
    return ranked.select("target", "place", "qryid", "selection", "extension", F.round("identity", 9).alias("identity"), F.round("quality", 9).alias("quality"))


#: Groups named in two ways, so that two of them may mean one chromosome; the genome lacks every fifth. (Numbers
#: of three digits, as a name within another would do for a match.)
GROUPED = MATCH + """, own AS (SELECT *, CASE WHEN cast(split_part(qryid, '.', 2) AS bigint) % 3 = 0 THEN 'CHR' ELSE 'chr' END || (100 + n) AS g, 'chr' || (100 + n) AS chrom FROM (SELECT *, cast(target[4:] AS int) AS n FROM ext) t),
tri AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY selection DESC, hit_id) AS place FROM (SELECT *, round(0.6e0 * greatest(0e0, 1e0 - least(1e0, abs(extension) / 100000e0)) + 0.3e0 * quality + 0.1e0 * idn, 9) AS selection FROM own WHERE reason IS NULL) t),
grp AS (SELECT g, CASE WHEN n % 5 <> 0 THEN chrom END AS chrom, min(hit_id) AS since FROM own GROUP BY ALL),
made AS (SELECT g.chrom, arg_min(t.g, (since, t.g)) AS g, arg_min(t.qryid, (since, t.g)) AS qryid, min(since) AS since FROM tri t JOIN grp g USING (g) WHERE place = 1 AND g.chrom IS NOT NULL GROUP BY 1)
"""


@query("G20_telomere_outcomes", GROUPED + """SELECT o.qryid, o.g AS target, o.reason AS detail,
 CASE WHEN r.chrom IS NULL THEN 'skipped' WHEN m.g = o.g AND m.qryid = o.qryid THEN 'success' WHEN m.g = o.g OR m.since < r.since THEN 'skipped' ELSE 'failed' END AS outcome,
 CASE WHEN r.chrom IS NULL THEN 'chromosome_not_found' WHEN m.g = o.g AND m.qryid = o.qryid THEN '' WHEN m.g = o.g THEN 'not_used_alternative' WHEN m.since < r.since THEN 'chromosome_already_repaired' ELSE 'repair_attempt_failed' END AS why
FROM own o JOIN grp r USING (g) LEFT JOIN made m ON m.chrom = r.chrom""", "flank_paf")
def g20(s, d):
    n = (100 + F.substring("target", 4, 9).cast("int")).cast("string")
    head = F.when(F.split_part("qryid", F.lit("."), F.lit(2)).cast("bigint") % 3 == 0, "CHR").otherwise("chr")
    plans = T.merge_plan(_matches(s, d)).withColumns({"n": n, "target": F.concat(head, n)})
    # matched once; groups and chosen repairs are few, so they are written before they meet all plans
    plans = kept(plans.select("qryid", "target", "n", "hit_id", "extension", "quality", "identity", "reason"))
    genome = kept(plans.where("n % 5 <> 0").select(F.concat(F.lit("chr"), "n").alias("name"), F.col("n").cast("int").alias("seq_ord")).distinct())
    groups = kept(T.repair_targets(plans.select("target", F.col("hit_id").alias("ord")), genome))
    made = kept(T.first_repairs(T.ranked_repairs(plans.where("reason is null")).where("place = 1"), groups))
    return T.outcomes(plans, made, groups)


@query("G21_telomere_run_stats", MATCH + "SELECT count(*) AS repaired, cast(sum(extension) AS bigint) AS extension, round(avg(extension), 6) AS mean_extension, (SELECT count(*) FROM ext) AS tried, round(count(*) / (SELECT count(*) FROM ext), 6) AS efficiency FROM sel WHERE place = 1", "flank_paf")
def g21(s, d):
    plans, chosen = _chosen(s, d)
    return T.run_stats(chosen, plans).withColumns({"mean_extension": F.round("mean_extension", 6), "efficiency": F.round("efficiency", 6)})


@query("G22_genome_telomere_summary", STATUS + ", " + ARRAYS.replace("{r}", "10").replace("{b}", "60") + INNER + "SELECT count(*) AS n, count(*) FILTER (WHERE has_5prime OR has_3prime) AS any_end, count(*) FILTER (WHERE has_5prime AND has_3prime) AS both_ends, count(m.seq_id) AS with_internal FROM st LEFT JOIN (SELECT DISTINCT seq_id FROM mrg) m USING (seq_id)", "telo_seqs")
def g22(s, d):
    return T.genome_summary(_status(s, d), T.internal_telomeres(_arrays(s, d, 10, 60), D.lengths(_telo(s, d)), 2_000))


@query("G23_end_match_summary", MATCH + "SELECT target, count(*) FILTER (WHERE repair_end = '5prime') AS n_5prime, count(*) FILTER (WHERE repair_end = '3prime') AS n_3prime, count(*) AS n FROM val GROUP BY target", "flank_paf")
def g23(s, d):
    return T.end_matches(_matches(s, d))


# --- N: composites --------------------------------------------------------------

