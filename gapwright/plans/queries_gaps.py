"""Queries over sequences and gaps: sources, scalars, gap analytics, edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as S
from ..operators import edits as E
from ..operators import fill as L
from ..operators import gaps as D
from ..operators import kmer as K
from ..operators import patch as P
from ..sources import formats, sinks
from .fixtures import fixture
from .registry import query

RUNS = """runs AS (SELECT seq_id, r, length(r) AS len, cast(sum(length(r)) OVER (PARTITION BY seq_id ORDER BY k) AS bigint) AS stop
  FROM (SELECT seq_id, unnest(regexp_extract_all({b}, 'N+|[^N]+')) AS r, generate_subscripts(regexp_extract_all({b}, 'N+|[^N]+'), 1) AS k FROM seqs) q)"""
GAPS = "WITH " + RUNS.replace("{b}", "bases") + """,
gaps AS (SELECT seq_id, stop - len AS start, stop AS "end", len AS length FROM runs WHERE r LIKE 'N%' AND len >= {n}),
lens AS (SELECT seq_id, seq_ord, length(bases) AS seq_length FROM seqs)
"""


def gaps_sql(body: str, n: int = 3) -> str:
    return GAPS.replace("{n}", str(n)) + body


def chunked(text: str, what: str = "substr(t, i * 4000 + 1, 4000) AS bases") -> str:
    """SQL of the 4,000-base chunks of a sequence expression."""
    return f"SELECT seq_id, cast(i AS int) AS chunk_ix, {what} FROM (SELECT seq_id, t, unnest(range(0, (length(t) + 3999) // 4000)) AS i FROM (SELECT seq_id, {text} AS t FROM seqs) q) p"


def _seqs(s, d):
    return fixture(s, d, "seqs")


def _gaps(s, d, n=3):
    return D.find_gaps(D.chunk_sequences(_seqs(s, d)), n)


def _lens(s, d):
    return D.lengths(_seqs(s, d))


# --- A: sources over text views ---------------------------------------------

@query("A2_chunk_sequences", "SELECT seq_id, cast(i AS int) AS chunk_ix, i * 4000 AS start, substr(bases, i * 4000 + 1, 4000) AS bases FROM (SELECT seq_id, bases, unnest(range(0, (length(bases) + 3999) // 4000)) AS i FROM seqs) t", "seqs")
def a2(s, d):
    return D.chunk_sequences(_seqs(s, d)).drop("more")


def _coords_lines(s, d, bar=" | "):
    a = fixture(s, d, "alignments")
    text = lambda c: F.col(c).cast("string")
    size = (F.col("ref_end") - F.col("ref_start") + 1).cast("string")
    line = F.concat_ws(" ", text("ref_start"), text("ref_end"), F.lit(bar.strip()), text("query_start"), text("query_end"), F.lit(bar.strip()), size, size, F.lit(bar.strip()), F.format_string("%.2f", "identity"), F.lit(bar.strip()), "ref_contig", "query_contig")
    heads = s.createDataFrame([("NUCMER",), ("[S1] [E1]",), ("=====",), ("/a/b.fa /c/d.fa",), ("",), ("1 2 x",)], "value string")
    return a.select(line.alias("value")).unionByName(heads)


COORDS = "SELECT ref_contig, query_contig, ref_start, ref_end, query_start, query_end, identity FROM alignments"


@query("A4_read_coords", COORDS, "alignments")
def a4(s, d):
    return formats.parse_coords(_coords_lines(s, d)).select("ref_contig", "query_contig", "ref_start", "ref_end", "query_start", "query_end", "identity")


@query("A5_read_coords_te", "SELECT ref_contig, query_contig, least(ref_start, ref_end) AS s1, greatest(ref_start, ref_end) AS e1, query_start > query_end AS is_reverse FROM alignments", "alignments")
def a5(s, d):
    from ..operators.telomere import directed
    rows = formats.parse_coords(_coords_lines(s, d)).withColumn("aln_id", F.lit(0))
    return directed(rows).select("ref_contig", "query_contig", "s1", "e1", "is_reverse")


@query("A6_validate_coords", "SELECT count(*) AS n FROM alignments", "alignments")
def a6(s, d):
    return formats.validate_coords(formats.parse_coords(_coords_lines(s, d))).agg(F.count("*").alias("n"))


@query("A7_union_coords", f"SELECT * FROM ({COORDS} WHERE ref_contig <= 'ctg3') UNION ALL SELECT * FROM ({COORDS} WHERE ref_contig > 'ctg3')", "alignments")
def a7(s, d):
    lines = _coords_lines(s, d)
    part = lambda c: formats.parse_coords(lines).where(c)
    return part("ref_contig <= 'ctg3'").unionByName(part("ref_contig > 'ctg3'")).select("ref_contig", "query_contig", "ref_start", "ref_end", "query_start", "query_end", "identity")


@query("A8_read_paf", "SELECT qryid, qrylen, qrystart, qryend, strand, refid, reflen, refstart, refend, matches, alnlen, mapq, round(matches / alnlen, 6) AS identity, alnlen || 'M' AS cigar FROM flank_paf", "flank_paf")
def a8(s, d):
    p = fixture(s, d, "flank_paf")
    cols = ["qryid", "qrylen", "qrystart", "qryend", "strand", "refid", "reflen", "refstart", "refend", "matches", "alnlen", "mapq"]
    lines = p.select(F.concat_ws("\t", *(F.col(c).cast("string") for c in cols), F.lit("NM:i:0"), F.concat(F.lit("cg:Z:"), F.col("alnlen").cast("string"), F.lit("M"))).alias("value"))
    return formats.parse_paf(lines).select(*cols, F.round("identity", 6).alias("identity"), "cigar")


@query("A10_parse_patch_header", "SELECT gap_key, gap_pos, 'gap' || gap_pos || '_patch1_contig' || query_contig AS header, gap_pos AS parsed, query_contig AS chrom FROM gap_positions", "gap_positions")
def a10(s, d):
    from ..operators.patch import parse_patch_header
    g = fixture(s, d, "gap_positions").withColumn("header", F.concat(F.lit("gap"), F.col("gap_pos").cast("string"), F.lit("_patch1_contig"), "query_contig"))
    return g.withColumn("p", parse_patch_header(F.col("header"))).select("gap_key", "gap_pos", "header", F.col("p.gap_pos").alias("parsed"), F.col("p.chrom").alias("chrom"))


@query("A11_parse_repair_header", "SELECT hit_id, CASE WHEN qryid LIKE '%L' THEN '5prime' ELSE '3prime' END AS repair_end, split_part(qryid, '.', 1) AS target FROM flank_paf", "flank_paf")
def a11(s, d):
    side = F.when(F.col("qryid").endswith("L"), "_5prime").otherwise("_3prime")
    text = F.concat(F.lit("length:9 region_type:first_alignment_with_preceding aligned_to:"), F.split_part("qryid", F.lit("."), F.lit(1)), side)
    return fixture(s, d, "flank_paf").select("hit_id", formats.repair_header(text, F.col("refid")).alias("h")).select("hit_id", "h.repair_end", "h.target")


# --- B: rows that the sinks write --------------------------------------------

@query("B2_bed_rows", gaps_sql("""SELECT seq_id AS chrom, start, "end", 'gap_' || seq_id || ':' || start || '-' || "end" AS name, length AS score, '.' AS strand FROM gaps"""), "seqs")
def b2(s, d):
    return sinks.bed_rows(_gaps(s, d))


@query("B3_gap_csv_rows", gaps_sql("""SELECT seq_id AS chromosome, start AS start_0based, "end" AS end_0based, start + 1 AS start_1based, "end" AS end_1based, length FROM gaps"""), "seqs")
def b3(s, d):
    return sinks.gap_csv_rows(_gaps(s, d))


# --- C: scalars --------------------------------------------------------------

@query("C1_reverse_complement", "SELECT seq_id, reverse(translate(bases, 'ACGTacgt', 'TGCAtgca')) AS rc FROM seqs", "seqs")
def c1(s, d):
    return _seqs(s, d).select("seq_id", S.reverse_complement(F.col("bases")).alias("rc"))


@query("C2_slice_bases", "SELECT seq_id AS key, substr(bases, 101, 5000) AS bases FROM seqs WHERE length(bases) > 100", "seqs")
def c2(s, d):
    q = _seqs(s, d)
    regions = q.where(F.length("bases") > 100).select(F.col("seq_id").alias("key"), "seq_id", F.lit(101).cast("bigint").alias("start"), F.lit(5100).cast("bigint").alias("end"))
    return E.slice_bases(regions, D.chunk_sequences(q))


@query("C3_clean_chrom_name", "SELECT CASE seq_ord % 3 WHEN 0 THEN seq_id || '.fasta len=9' WHEN 1 THEN ' ' || seq_id || '.fa' ELSE seq_id || '.x' END AS raw, CASE WHEN seq_ord % 3 < 2 THEN seq_id ELSE seq_id || '.x' END AS name FROM seqs", "seqs")
def c3(s, d):
    raw = F.when(F.col("seq_ord") % 3 == 0, F.concat("seq_id", F.lit(".fasta len=9"))).when(F.col("seq_ord") % 3 == 1, F.concat(F.lit(" "), "seq_id", F.lit(".fa"))).otherwise(F.concat("seq_id", F.lit(".x")))
    return _seqs(s, d).select(raw.alias("raw"), S.clean_chrom_name(raw).alias("name"))


@query("C4_match_chrom_name", """SELECT target, name, rank FROM (SELECT t.target, n.name, n.rank, row_number() OVER (PARTITION BY t.target ORDER BY n.rank, n.ord) AS r FROM
 (SELECT DISTINCT split_part(query_contig, 'chr', 2) AS target FROM alignments) t,
 LATERAL (SELECT 'chr' || i AS name, i AS ord, CASE WHEN cast(i AS varchar) = t.target THEN 1 WHEN contains(t.target, cast(i AS varchar)) OR contains(cast(i AS varchar), t.target) THEN 2 END AS rank FROM range(0, 12) x(i)) n WHERE n.rank IS NOT NULL) WHERE r = 1""", "alignments")
def c4(s, d):
    names = s.range(12).select(F.concat(F.lit("chr"), F.col("id").cast("string")).alias("name"), F.col("id").alias("seq_ord"))
    targets = fixture(s, d, "alignments").select(F.split_part("query_contig", F.lit("chr"), F.lit(2)).alias("target")).distinct()
    return L.match_names(names, targets)


@query("C5_is_junk_sequence", "SELECT seq_id, regexp_full_match(bases, '[*Nn]*') AS junk FROM seqs", "seqs")
def c5(s, d):
    return _seqs(s, d).select("seq_id", S.is_junk(F.col("bases")).alias("junk"))


@query("C6_cigar_anchor_count", "SELECT hit_id, cast(greatest(1, (CASE WHEN alnlen >= 15 THEN 1 ELSE 0 END) + (CASE WHEN mapq >= 15 THEN 1 ELSE 0 END)) AS bigint) AS anchors FROM flank_paf", "flank_paf")
def c6(s, d):
    cigar = F.concat(F.col("alnlen").cast("string"), F.lit("M3I"), F.col("mapq").cast("string"), F.lit("M"))
    return fixture(s, d, "flank_paf").select("hit_id", S.cigar_anchors(cigar).alias("anchors"))


@query("C7_format_genome_size", "SELECT o_orderkey, CASE WHEN n >= 1000000000 THEN cast(round(n / 1000000000.0, 1) AS varchar) || 'g' WHEN n >= 1000000 THEN cast(cast(floor(n / 1000000) AS bigint) AS varchar) || 'm' ELSE cast(cast(floor(n / 1000) AS bigint) AS varchar) || 'k' END AS size FROM (SELECT o_orderkey, cast(o_orderkey AS bigint) * 100000 AS n FROM orders) t")
def c7(s, d):
    return s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", S.format_genome_size(F.col("o_orderkey").cast("bigint") * 100000).alias("size"))


@query("C8_parse_genome_size", "SELECT o_orderkey, cast(o_orderkey * 1000000.0 AS double) AS bp, CASE WHEN o_orderkey * 1000000.0 >= 1e9 THEN 2000 WHEN o_orderkey * 1000000.0 >= 1e8 THEN 1000 ELSE 500 END AS cutoff FROM orders")
def c8(s, d):
    bp = S.parse_genome_size(F.concat(F.col("o_orderkey").cast("string"), F.lit("m")))
    return s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", bp.alias("bp"), S.read_cutoff(bp).alias("cutoff"))


@query("C9_gc_content", "SELECT seq_id, round((length(bases) - length(replace(replace(bases, 'G', ''), 'C', ''))) / length(bases), 6) AS gc FROM seqs WHERE length(bases) > 0", "seqs")
def c9(s, d):
    c = D.chunk_sequences(_seqs(s, d)).groupBy("seq_id").agg((F.sum(S.gc_count(F.col("bases"))) / F.sum(F.length("bases"))).alias("gc"))
    return c.select("seq_id", F.round("gc", 6).alias("gc"))


@query("C10_human_interval", gaps_sql("""SELECT seq_id, start, (start + 1) || '-' || "end" AS human FROM gaps"""), "seqs")
def c10(s, d):
    return _gaps(s, d).select("seq_id", "start", S.human_interval(F.col("start"), F.col("end")).alias("human"))


# --- D: gaps and fragments ----------------------------------------------------

@query("D1_find_gaps", gaps_sql('SELECT seq_id, start, "end", cast(length AS bigint) AS length FROM gaps'), "seqs")
def d1(s, d):
    return _gaps(s, d)


@query("D2_find_gaps_ci", gaps_sql('SELECT seq_id, start, "end", cast(length AS bigint) AS length, start + length // 2 AS mid FROM gaps', 10), "seqs")
def d2(s, d):
    lower = _seqs(s, d).withColumn("bases", F.lower("bases"))
    return D.find_gaps(D.chunk_sequences(lower), 10, any_case=True).withColumn("mid", F.expr("start + length div 2"))


@query("D3_gap_stats_by_chrom", gaps_sql("SELECT seq_id, count(*) AS n_gaps, cast(sum(length) AS bigint) AS total, max(length) AS longest, min(length) AS shortest, round(avg(length), 6) AS mean FROM gaps GROUP BY seq_id"), "seqs")
def d3(s, d):
    return D.gap_stats_by_chrom(_gaps(s, d)).withColumn("mean", F.round("mean", 6))


@query("D4_gap_stats_global", gaps_sql("""SELECT n_gaps, total, mean, round(100 * total / bases, 6) AS coverage, b.seq_id AS largest_seq, b.start AS largest_start, b.length AS largest, l.seq_id AS smallest_seq, l.start AS smallest_start, l.length AS smallest
FROM (SELECT count(*) AS n_gaps, cast(sum(length) AS bigint) AS total, round(avg(length), 6) AS mean FROM gaps) g, (SELECT sum(seq_length) AS bases FROM lens) s,
(SELECT * FROM gaps ORDER BY length DESC, seq_id, start LIMIT 1) b, (SELECT * FROM gaps ORDER BY length, seq_id, start LIMIT 1) l"""), "seqs")
def d4(s, d):
    return D.gap_stats_global(_gaps(s, d), _lens(s, d)).withColumns({"mean": F.round("mean", 6), "coverage": F.round("coverage", 6)})


@query("D5_gap_length_histogram", gaps_sql("""SELECT b.bin, count(g.length) AS n FROM (VALUES ('1-10', 1, 10), ('11-50', 11, 50), ('51-100', 51, 100), ('101-500', 101, 500), ('501-1000', 501, 1000), ('1001-5000', 1001, 5000), ('5001-10000', 5001, 10000), ('>10000', 10001, 1000000000)) b(bin, lo, hi)
LEFT JOIN gaps g ON g.length BETWEEN b.lo AND b.hi GROUP BY b.bin"""), "seqs")
def d5(s, d):
    return D.gap_length_histogram(_gaps(s, d))


@query("D6_gap_detail_stats", gaps_sql("""SELECT n_gaps, total, mean, longest, shortest, (SELECT length FROM (SELECT length, row_number() OVER (ORDER BY length) AS r FROM gaps) WHERE r = n_gaps // 2 + 1) AS median, round(n_gaps / (SELECT sum(seq_length) FROM lens) * 1000000, 6) AS per_mb
FROM (SELECT count(*) AS n_gaps, cast(sum(length) AS bigint) AS total, round(avg(length), 6) AS mean, max(length) AS longest, min(length) AS shortest FROM gaps) t"""), "seqs")
def d6(s, d):
    return D.gap_detail_stats(_gaps(s, d), _lens(s, d)).withColumns({"mean": F.round("mean", 6), "per_mb": F.round("per_mb", 6)})


@query("D7_gap_midpoints", gaps_sql('SELECT seq_id, start, "end", cast(length AS bigint) AS length, start + length // 2 AS mid FROM gaps WHERE length BETWEEN 5 AND 60'), "seqs")
def d7(s, d):
    return D.gap_midpoints(_gaps(s, d), 5, 60)


@query("D8_top_chroms_by_gap", gaps_sql("SELECT seq_id, count(*) AS n_gaps, cast(sum(length) AS bigint) AS total FROM gaps GROUP BY seq_id ORDER BY n_gaps DESC, seq_id LIMIT 10"), "seqs")
def d8(s, d):
    return D.top_chroms_by_gap(_gaps(s, d))


FRAGS = """, frags AS (SELECT seq_id, s AS start, e AS "end", e - s AS length, piece FROM (
 SELECT seq_id, coalesce(lag("end") OVER w, 0) AS s, start AS e, row_number() OVER w AS piece FROM gaps WINDOW w AS (PARTITION BY seq_id ORDER BY start)
 UNION ALL SELECT l.seq_id, coalesce(max(g."end"), 0), any_value(l.seq_length), count(g.start) + 1 FROM lens l LEFT JOIN gaps g USING (seq_id) GROUP BY l.seq_id) t WHERE e - s >= 1)
"""


@query("D9_fragments", gaps_sql(FRAGS + 'SELECT seq_id, cast(start AS bigint) AS start, "end", cast(length AS bigint) AS length, cast(piece AS int) AS piece FROM frags'), "seqs")
def d9(s, d):
    return D.fragments(_gaps(s, d), _lens(s, d))


@query("D10_fragment_status", gaps_sql(FRAGS + """SELECT seq_id, count(*) AS n, count(*) FILTER (WHERE length >= 200) AS n_kept, cast(sum(length) AS bigint) AS total, cast(coalesce(sum(length) FILTER (WHERE length >= 200), 0) AS bigint) AS kept,
 round(100 * coalesce(sum(length) FILTER (WHERE length >= 200), 0) / sum(length), 6) AS kept_percent FROM frags GROUP BY seq_id"""), "seqs")
def d10(s, d):
    return D.fragment_summary(D.fragment_status(D.fragments(_gaps(s, d), _lens(s, d)), 200)).withColumn("kept_percent", F.round("kept_percent", 6))


@query("D11_filter_fragments", gaps_sql(FRAGS + """SELECT seq_id, n, start, "end", cast(coalesce(sum(length) OVER (PARTITION BY seq_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 100 * (n - 1) AS bigint) AS out_start
 FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY start) AS n FROM frags WHERE length >= 200) t"""), "seqs")
def d11(s, d):
    return D.filtered_segments(D.fragment_status(D.fragments(_gaps(s, d), _lens(s, d)), 200))


@query("D12_partition_by_gap", gaps_sql("SELECT l.seq_id, l.seq_length, count(g.start) > 0 AS has_gap FROM lens l LEFT JOIN gaps g USING (seq_id) GROUP BY l.seq_id, l.seq_length", 10), "seqs")
def d12(s, d):
    return D.partition_by_gap(_lens(s, d), _gaps(s, d, 10)).select("seq_id", "seq_length", "has_gap")


@query("D13_genome_stats", gaps_sql("""SELECT count(*) AS n, cast(sum(seq_length) AS bigint) AS total, max(seq_length) AS longest, min(seq_length) AS shortest, round(avg(seq_length), 6) AS mean,
 (SELECT count(DISTINCT seq_id) FROM gaps) AS with_gaps, (SELECT cast(coalesce(sum(length // 10), 0) AS bigint) FROM gaps) AS n_units FROM lens""", 10), "seqs")
def d13(s, d):
    return D.genome_stats(_lens(s, d), _gaps(s, d, 10)).withColumn("mean", F.round("mean", 6))


@query("D14_fill_stat_table", gaps_sql("""SELECT l.seq_id, l.seq_length, count(g.start) AS n_gaps, coalesce(string_agg((g.start + 1) || '-' || g."end", ',' ORDER BY g.start), '') AS loci FROM lens l LEFT JOIN gaps g USING (seq_id) GROUP BY l.seq_id, l.seq_length""", 10), "seqs")
def d14(s, d):
    return D.fill_stat_table(_lens(s, d), _gaps(s, d), 10)


@query("D15_gap_closure", gaps_sql("SELECT b AS before, a AS after, b - a AS closed, round(coalesce(100 * (b - a) / nullif(b, 0), 0), 6) AS rate FROM (SELECT count(*) AS b, count(*) FILTER (WHERE length >= 20) AS a FROM gaps) t", 10), "seqs")
def d15(s, d):
    g = _gaps(s, d, 10)
    return D.gap_closure(g, g.where("length >= 20"), 10).withColumn("rate", F.round("rate", 6))


@query("D16_fix_improvement", gaps_sql("""SELECT n AS gaps_before, m AS gaps_after, round(100 * (n - m) / greatest(n, 1), 6) AS gaps_percent, t AS length_before, u AS length_after, round(100 * (t - u) / greatest(t, 1), 6) AS length_percent,
 round(100 * t / b, 6) AS coverage_before, round(100 * u / b, 6) AS coverage_after FROM (SELECT count(*) AS n, count(*) FILTER (WHERE length >= 5) AS m, cast(sum(length) AS bigint) AS t, cast(sum(length) FILTER (WHERE length >= 5) AS bigint) AS u FROM gaps) g, (SELECT sum(seq_length) AS b FROM lens) l"""), "seqs")
def d16(s, d):
    g, n = _gaps(s, d), _lens(s, d)
    out = D.fix_improvement(g, g.where("length >= 5"), n, n)
    return out.withColumns({c: F.round(c, 6) for c in ("gaps_percent", "length_percent", "coverage_before", "coverage_after")})


@query("D17_structure_track", gaps_sql("""SELECT l.seq_id, string_agg(CASE WHEN m.seq_id IS NULL THEN '-' ELSE 'N' END, '' ORDER BY b) AS track FROM (SELECT seq_id, unnest(range(0, 50)) AS b FROM lens) l
 LEFT JOIN (SELECT DISTINCT seq_id, unnest(range(least(49, start * 50 // seq_length), greatest(least(49, start * 50 // seq_length), least(49, ("end" - 1) * 50 // seq_length)) + 1)) AS b FROM gaps JOIN lens USING (seq_id)) m USING (seq_id, b) GROUP BY l.seq_id""", 10), "seqs")
def d17(s, d):
    return D.structure_track(_lens(s, d), _gaps(s, d, 10).select("seq_id", F.lit("gap").alias("kind"), "start", "end"))


@query("D18_split_at_gaps", gaps_sql(FRAGS + """SELECT seq_id || '_tig' || piece AS name, seq_id, cast(start AS bigint) AS start, "end", cast(length AS bigint) AS length FROM frags""", 10), "seqs")
def d18(s, d):
    return D.split_at_gaps(_gaps(s, d), _lens(s, d), 10)


@query("D19_normalize_gaps", chunked("regexp_replace(bases, 'N+', repeat('N', 100), 'g')"), "seqs")
def d19(s, d):
    return D.normalize_chunks(D.chunk_sequences(_seqs(s, d)))


@query("D20_total_length", "SELECT count(*) AS n, cast(sum(length(bases)) AS bigint) AS total FROM seqs", "seqs")
def d20(s, d):
    return _lens(s, d).agg(F.count("*").alias("n"), F.sum("seq_length").alias("total"))


@query("D21_valid_patch", "SELECT seq_id, length(bases) >= 10 AND length(bases) + length(seq_id) + 2 >= 100 AS valid FROM seqs", "seqs")
def d21(s, d):
    return _seqs(s, d).select("seq_id", P.valid_patch(F.col("bases"), F.col("seq_id")).alias("valid"))


# --- E: flanks, edits, rebuilding --------------------------------------------

@query("E1_gap_flanks", gaps_sql("""SELECT seq_id, gap_no, start, "end", left_start, left_end, right_start, right_end FROM (SELECT seq_id, row_number() OVER w AS gap_no, start, "end", greatest(0, start - 500) AS left_start, start AS left_end, "end" AS right_start, least(seq_length, "end" + 500) AS right_end,
 lag(start) OVER w AS ps, lag("end") OVER w AS pe, lead(start) OVER w AS ns, lead("end") OVER w AS ne FROM gaps JOIN lens USING (seq_id) WINDOW w AS (PARTITION BY seq_id ORDER BY start)) t
 WHERE coalesce(pe - greatest(ps, left_start), 0) < 10 AND coalesce(least(ne, right_end) - ns, 0) < 10""", 10), "seqs")
def e1(s, d):
    return L.gap_flanks(_gaps(s, d, 10), _lens(s, d), 500, 10)


def _toy_edits(s, d):
    g = _gaps(s, d, 10)
    return D.normalize_edits(g.where("length >= 10"), 7)


SEGS = """, ed AS (SELECT seq_id, start AS a, "end" AS b FROM gaps),
seg AS (SELECT seq_id, kind, s0, s1, row_number() OVER (PARTITION BY seq_id ORDER BY p0, o) AS n FROM (
 SELECT seq_id, 'seq' AS kind, coalesce(lag(b) OVER (PARTITION BY seq_id ORDER BY a), 0) AS s0, a AS s1, a AS p0, 0 AS o FROM ed
 UNION ALL SELECT seq_id, 'N', 0, 7, a, 1 FROM ed
 UNION ALL SELECT l.seq_id, 'seq', coalesce(max(b), 0), any_value(seq_length), any_value(seq_length), 2 FROM lens l LEFT JOIN ed USING (seq_id) GROUP BY l.seq_id) t WHERE s1 > s0),
placed AS (SELECT *, cast(coalesce(sum(s1 - s0) OVER (PARTITION BY seq_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS out_start FROM seg)
"""


@query("E10_apply_edits", gaps_sql(SEGS + "SELECT seq_id, cast(n AS int) AS n, kind, cast(s0 AS bigint) AS src_start, cast(s1 AS bigint) AS src_end, out_start FROM placed", 10), "seqs")
def e10(s, d):
    return E.apply_edits(E.resolve(_toy_edits(s, d)), _lens(s, d)).select("seq_id", "n", "kind", "src_start", "src_end", "out_start")


@query("E11_materialize", chunked("regexp_replace(bases, 'N{10,}', repeat('N', 7), 'g')", "md5(substr(t, i * 4000 + 1, 4000)) AS digest"), "seqs")
def e11(s, d):
    q = _seqs(s, d)
    out = E.materialize(E.apply_edits(_toy_edits(s, d), D.lengths(q)), D.chunk_sequences(q).withColumn("kind", F.lit("seq")))
    return out.select("seq_id", "chunk_ix", F.md5("bases").alias("digest"))


@query("E12_agp_rows", gaps_sql(SEGS + """SELECT seq_id AS object, out_start + 1 AS beg, out_start + s1 - s0 AS "end", cast(n AS int) AS part, CASE WHEN kind = 'N' THEN 'N' ELSE 'W' END AS type, CASE WHEN kind = 'N' THEN cast(s1 - s0 AS varchar) ELSE seq_id END AS component FROM placed""", 10), "seqs")
def e12(s, d):
    return E.agp_rows(E.apply_edits(_toy_edits(s, d), _lens(s, d))).select("object", "beg", "end", "part", "type", "component")


@query("E13_lift_positions", gaps_sql("""SELECT cast(row_number() OVER (PARTITION BY seq_id ORDER BY start) AS bigint) AS key, seq_id, "end" AS pos, "end" + cast(sum(7 - length) OVER (PARTITION BY seq_id ORDER BY start) AS bigint) AS lifted FROM gaps""", 10), "seqs")
def e13(s, d):
    g = _gaps(s, d, 10)
    from pyspark.sql import Window
    at = g.select(F.row_number().over(Window.partitionBy("seq_id").orderBy("start")).alias("key"), "seq_id", F.col("end").alias("pos"))
    return E.lift_by_edits(at, _toy_edits(s, d))


@query("E13c_lift_by_rank", gaps_sql('SELECT seq_id, start AS old_start, start + 3 AS new_start FROM gaps', 10), "seqs")
def e13c(s, d):
    g = _gaps(s, d, 10)
    return E.lift_by_rank(g, g.withColumn("start", F.col("start") + 3), 10)


@query("E15_merge_fasta_unique", "SELECT seq_id, f AS file_ord, CASE WHEN f = 0 THEN seq_id ELSE seq_id || '_1' END AS new_id FROM seqs, (VALUES (0), (1)) v(f)", "seqs")
def e15(s, d):
    q = _seqs(s, d).select("seq_id", "seq_ord")
    both = q.withColumn("file_ord", F.lit(0)).unionByName(q.withColumn("file_ord", F.lit(1)))
    return L.merge_unique(both).select("seq_id", "file_ord", "new_id")


@query("E16_overlay_genome", "SELECT seq_id, CASE WHEN seq_ord % 3 = 0 THEN 'repaired' ELSE 'original' END AS origin FROM seqs", "seqs")
def e16(s, d):
    q = _seqs(s, d).select("seq_id", "seq_ord")
    return L.overlay(q.where("seq_ord % 3 = 0"), q).select("seq_id", "origin")


@query("E17_final_genome_labels", gaps_sql("SELECT l.seq_id, CASE WHEN g.seq_id IS NULL THEN '' WHEN seq_ord % 2 = 0 THEN 'filled_' ELSE 'unfilled_' END || l.seq_id AS label FROM lens l LEFT JOIN (SELECT DISTINCT seq_id FROM gaps) g USING (seq_id)", 10), "seqs")
def e17(s, d):
    n = _lens(s, d)
    return L.final_labels(n, n.where("seq_ord % 2 = 0"), _gaps(s, d, 10))


@query("E18_select_sequences", "SELECT seq_id AS name, seq_id, 1 AS rank FROM seqs UNION ALL SELECT 'HR' || a.seq_ord, arg_min(b.seq_id, b.seq_ord), 2 FROM seqs a JOIN seqs b ON contains(b.seq_id, 'hr' || a.seq_ord) GROUP BY a.seq_ord", "seqs")
def e18(s, d):
    q = _seqs(s, d).select("seq_id", "seq_ord")
    names = q.select(F.col("seq_id").alias("name")).unionByName(q.select(F.concat(F.lit("HR"), F.col("seq_ord").cast("string")).alias("name")))
    return L.select_sequences(q, names)


@query("E18b_select_patched", "SELECT seq_id AS name, seq_id || '_patched' AS seq_id, 2 AS rank FROM seqs WHERE seq_ord % 2 = 0 UNION ALL SELECT seq_id, 'x_' || seq_id, 3 FROM seqs WHERE seq_ord % 2 = 1", "seqs")
def e18b(s, d):
    q = _seqs(s, d).select(F.when(F.col("seq_ord") % 2 == 0, F.concat("seq_id", F.lit("_patched"))).otherwise(F.concat(F.lit("x_"), "seq_id")).alias("seq_id"), "seq_ord")
    return L.select_patched(q, _seqs(s, d).select(F.col("seq_id").alias("name")))


@query("E18c_rename_sequences", "SELECT seq_id || '.fa chromosome ' || seq_ord AS seq_id, seq_id AS name, '' AS description FROM seqs", "seqs")
def e18c(s, d):
    return L.rename_sequences(_seqs(s, d).select(F.concat("seq_id", F.lit(".fa chromosome "), F.col("seq_ord").cast("string")).alias("seq_id")))


# --- H: k-mers ----------------------------------------------------------------

KM = """WITH w AS (SELECT seq_id, i - 1 AS pos, substr(bases, i, 11) AS w FROM (SELECT seq_id, bases, unnest(range(1, length(bases) - 9)) AS i FROM seqs) t),
km AS (SELECT seq_id, pos, least(w, reverse(translate(w, 'ACGT', 'TGCA'))) AS kmer FROM w WHERE NOT contains(w, 'N')),
h AS (SELECT times, count(*) AS n_kmers FROM (SELECT kmer, count(*) AS times FROM km GROUP BY kmer) t GROUP BY times) """



@query("H1_kmer_histogram", KM + "SELECT * FROM h", "seqs")
def h1(s, d):
    return K.kmer_histogram(K.kmer_counts(K.super_kmers(_seqs(s, d), 11), 11))


@query("H2_genome_size_kmer", KM + "SELECT n, depth, cast(floor(n / depth + 10) AS bigint) AS genome_size FROM (SELECT cast(sum(times * n_kmers) AS bigint) AS n, (SELECT times FROM h ORDER BY n_kmers DESC, times LIMIT 1) AS depth FROM h) t", "seqs")
def h2(s, d):
    return K.genome_size_kmer(K.kmer_histogram(K.kmer_counts(K.super_kmers(_seqs(s, d), 11), 11)), 11)
