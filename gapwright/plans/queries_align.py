"""Queries over alignments and flank hits: filling, patching, synteny."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as S
from ..operators import fill as L
from ..operators import patch as P
from ..operators import synteny as Y
from ..sources.scratch import kept
from .fixtures import fixture
from .registry import query


def _al(s, d):
    return fixture(s, d, "alignments")


def _gp(s, d):
    return fixture(s, d, "gap_positions")


def _paf(s, d):
    return fixture(s, d, "flank_paf")


HITS = """WITH hits AS (SELECT *, matches / alnlen AS identity, regexp_extract(qryid, '^(.*)\\.[LR]$', 1) AS gap_id, right(qryid, 1) AS side FROM flank_paf WHERE alnlen >= 1000 AND matches / alnlen >= 0.4),
pairs AS (SELECT gap_id, refid, strand, l_id, r_id, fs AS fill_start, fe AS fill_end, score FROM (SELECT l.gap_id, l.refid, l.strand, l.hit_id AS l_id, r.hit_id AS r_id,
  CASE WHEN l.strand = '-' THEN r.refend ELSE l.refend END AS fs, CASE WHEN l.strand = '-' THEN l.refstart ELSE r.refstart END AS fe, (l.identity + r.identity) / 2 AS score
  FROM hits l JOIN hits r ON l.gap_id = r.gap_id AND l.refid = r.refid AND l.strand = r.strand AND l.side = 'L' AND r.side = 'R') t WHERE fe - fs BETWEEN 1 AND 1000000),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gap_id ORDER BY score DESC, l_id, r_id) AS r FROM pairs) t WHERE r = 1)
"""


@query("E2_flank_hits", HITS + "SELECT hit_id, gap_id, side, round(identity, 6) AS identity FROM hits", "flank_paf")
def e2(s, d):
    return L.flank_hits(_paf(s, d)).select("hit_id", "gap_id", "side", F.round("identity", 6).alias("identity"))


@query("E3_anchor_pairs", HITS + "SELECT gap_id, refid, strand, l_id, r_id, fill_start, fill_end, round(score, 6) AS score FROM pairs", "flank_paf")
def e3(s, d):
    return L.anchor_pairs(L.flank_hits(_paf(s, d))).withColumn("score", F.round("score", 6))


@query("E4_best_fill", HITS + "SELECT gap_id, refid, strand, l_id, r_id, fill_start, fill_end, round(score, 6) AS score FROM best", "flank_paf")
def e4(s, d):
    return L.best_fill(L.flank_hits(_paf(s, d))).withColumn("score", F.round("score", 6))


@query("E5_fill_edits", HITS + "SELECT split_part(gap_id, '.', 1) AS seq_id, cast(split_part(gap_id, '.', 2) AS bigint) * 1000 AS del_start, cast(split_part(gap_id, '.', 2) AS bigint) * 1000 + 100 AS del_end, refid AS src_id, fill_start AS src_start, fill_end AS src_end, strand FROM best", "flank_paf")
def e5(s, d):
    fills = L.best_fill(L.flank_hits(_paf(s, d)))
    at = F.split_part("gap_id", F.lit("."), F.lit(2)).cast("bigint") * 1000
    gaps = fills.select("gap_id", F.split_part("gap_id", F.lit("."), F.lit(1)).alias("seq_id"), at.alias("start"), (at + 100).alias("end"))
    return L.fill_edits(fills, gaps).select("seq_id", "del_start", "del_end", "src_id", "src_start", "src_end", "strand")


@query("B5_write_fill_detail", HITS + "SELECT g.gap_id, CASE WHEN b.refid IS NULL THEN 'Not_closed' ELSE 'Closed' END AS status, b.refid AS source, b.fill_start, b.fill_end, b.fill_end - b.fill_start AS fill_length, b.strand, round(b.score, 6) AS identity FROM (SELECT DISTINCT gap_id FROM hits) g LEFT JOIN best b USING (gap_id)", "flank_paf")
def b5(s, d):
    hits = L.flank_hits(_paf(s, d))
    return L.fill_detail(hits.select("gap_id").distinct(), L.best_fill(hits)).withColumn("identity", F.round("identity", 6))


AL = """WITH al AS (SELECT *, least(ref_start, ref_end) AS r_min, greatest(ref_start, ref_end) AS r_max, least(query_start, query_end) AS q_min, greatest(query_start, query_end) AS q_max,
  CASE WHEN (ref_end >= ref_start) = (query_end >= query_start) THEN 1 ELSE -1 END AS direction FROM alignments)"""
NEAR = AL + """,
two AS (SELECT query_contig, ref_contig FROM al GROUP BY ALL HAVING count(*) >= 2),
asks AS (SELECT g.gap_key, g.gap_pos, g.query_contig, t.ref_contig FROM gap_positions g JOIN two t USING (query_contig)),
ends AS (SELECT query_contig, ref_contig, q_max AS at, arg_min(al, aln_id) AS l FROM al GROUP BY ALL),
begins AS (SELECT query_contig, ref_contig, q_min AS at, arg_min(al, aln_id) AS r FROM al GROUP BY ALL),
lft AS (SELECT k.gap_key, k.ref_contig, l['aln_id'] AS aln_id, l['r_min'] AS r_min, l['r_max'] AS r_max, l['q_min'] AS q_min, l['q_max'] AS q_max, l['direction'] AS direction FROM asks k ASOF JOIN ends e ON e.query_contig = k.query_contig AND e.ref_contig = k.ref_contig AND k.gap_pos >= e.at),
rgt AS (SELECT k.gap_key, k.ref_contig, r['aln_id'] AS aln_id, r['r_min'] AS r_min, r['r_max'] AS r_max, r['q_min'] AS q_min, r['q_max'] AS q_max, r['direction'] AS direction FROM asks k ASOF JOIN begins e ON e.query_contig = k.query_contig AND e.ref_contig = k.ref_contig AND k.gap_pos < e.at),
anch AS (SELECT k.gap_key, k.ref_contig, l.aln_id AS l_id, r.aln_id AS r_id, l.q_max AS lq, r.q_min AS rq, l.r_min AS l0, l.r_max AS l1, r.r_min AS r0, r.r_max AS r1 FROM asks k LEFT JOIN lft l USING (gap_key, ref_contig) LEFT JOIN rgt r USING (gap_key, ref_contig)),
valid AS (SELECT * FROM anch WHERE rq - lq BETWEEN 1000 AND 1000000),
reg AS (SELECT gap_key, ref_contig, dir AS direction, dist AS distance, greatest(1, lo - 9999) AS patch_start, least(hi + 9999, 300000) AS patch_end FROM (SELECT *, rq - lq AS dist, CASE WHEN l1 < r0 THEN 1 WHEN r1 < l0 THEN -1 END AS dir, CASE WHEN l1 < r0 THEN l1 ELSE r1 END AS lo, CASE WHEN l1 < r0 THEN r0 ELSE l0 END AS hi FROM valid) t WHERE dir IS NOT NULL)
"""


@query("E6_nearest_anchors", NEAR + "SELECT gap_key, ref_contig, l_id, r_id FROM anch", "alignments", "gap_positions")
def e6(s, d):
    return P.nearest_anchors(_al(s, d), _gp(s, d)).select("gap_key", "ref_contig", F.col("left.aln_id").alias("l_id"), F.col("right.aln_id").alias("r_id"))


@query("E7_valid_anchor_pairs", NEAR + "SELECT gap_key, ref_contig, rq - lq AS distance FROM valid", "alignments", "gap_positions")
def e7(s, d):
    return P.valid_pairs(P.nearest_anchors(_al(s, d), _gp(s, d))).select("gap_key", "ref_contig", "distance")


def _regions(s, d):
    lens = _al(s, d).select("ref_contig").distinct().withColumn("ref_length", F.lit(300_000).cast("bigint"))
    return P.patch_regions(P.valid_pairs(P.nearest_anchors(_al(s, d), _gp(s, d))), lens)


@query("E8_patch_region", NEAR + "SELECT gap_key, ref_contig, direction, distance, cast(patch_start AS bigint) AS patch_start, cast(patch_end AS bigint) AS patch_end FROM reg", "alignments", "gap_positions")
def e8(s, d):
    return _regions(s, d)


@query("E9_extract_patches", NEAR + "SELECT gap_key, ref_contig, 'gap' || gap_key || '_patch' || row_number() OVER (PARTITION BY gap_key ORDER BY ref_contig) || '_contig' || ref_contig || '_' || patch_start || '_' || patch_end || CASE WHEN direction < 0 THEN '_revcomp' ELSE '' END || '_flank10000' AS label FROM reg", "alignments", "gap_positions")
def e9(s, d):
    p = P.numbered_patches(_regions(s, d))
    label = S.patch_label(F.col("gap_key"), F.col("patch_no"), F.col("ref_contig"), F.col("patch_start"), F.col("patch_end"), F.col("direction"), F.lit(10_000))
    return p.select("gap_key", "ref_contig", label.alias("label"))


@query("C11_patch_label", NEAR + "SELECT gap_key, ref_contig, 'gap' || gap_key || '_patch1_contig' || ref_contig || '_' || patch_start || '_' || patch_end || CASE WHEN direction < 0 THEN '_revcomp' ELSE '' END || '_flank9' AS label FROM reg", "alignments", "gap_positions")
def c11(s, d):
    label = S.patch_label(F.col("gap_key"), F.lit(1), F.col("ref_contig"), F.col("patch_start"), F.col("patch_end"), F.col("direction"), F.lit(9))
    return _regions(s, d).select("gap_key", "ref_contig", label.alias("label"))


@query("E9_patch_histogram", NEAR + "SELECT n_patches, count(*) AS n_gaps FROM (SELECT gap_key, count(*) AS n_patches FROM reg GROUP BY gap_key) t GROUP BY n_patches", "alignments", "gap_positions")
def e9h(s, d):
    return P.patch_histogram(_regions(s, d))


@query("E9b_first_patch_for_gap", NEAR + "SELECT gap_key, gap_pos, ref_contig FROM (SELECT g.gap_key, g.gap_pos, r.ref_contig, row_number() OVER (PARTITION BY g.gap_key ORDER BY r.ref_contig) AS rn FROM gap_positions g JOIN gap_positions h ON g.gap_pos = h.gap_pos JOIN reg r ON r.gap_key = h.gap_key) t WHERE rn = 1", "alignments", "gap_positions")
def e9b(s, d):
    gaps = _gp(s, d).select("gap_key", "gap_pos")
    p = _regions(s, d).join(gaps.withColumnRenamed("gap_pos", "gp"), "gap_key").select("ref_contig", F.concat(F.lit("gap"), F.col("gp").cast("string"), F.lit("_x")).alias("header"), F.substring("ref_contig", 4, 9).cast("int").alias("file_ord"))
    return P.first_patch(p, gaps).select("gap_key", "gap_pos", "ref_contig")


@query("E9c_patch_flanks", "SELECT l_orderkey, l_linenumber, CASE WHEN f >= 20 THEN cast(f AS bigint) END AS flank FROM (SELECT l_orderkey, l_linenumber, CASE WHEN 20000 <= n THEN 10000 WHEN n // 4 >= 20 THEN n // 4 ELSE least(100, n // 2) END AS f FROM (SELECT l_orderkey, l_linenumber, cast(floor(l_extendedprice) AS bigint) AS n FROM lineitem) a) t")
def e9c(s, d):
    li = s.read.parquet(f"{d}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", P.patch_flanks(F.floor("l_extendedprice")).alias("flank"))


BEST = """WITH sc AS (SELECT *, matches / alnlen * (0.7e0 + 0.3e0 * least(1e0, alnlen / 1000e0)) AS score FROM flank_paf WHERE mapq >= 20),
bst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qryid ORDER BY score DESC, hit_id) AS rn FROM sc) t WHERE rn = 1 AND score >= 0.7 AND alnlen >= 100),
gate AS (SELECT regexp_extract(l.qryid, '^(.*)\\.[LR]$', 1) AS gap_id, l.hit_id AS l_hit, r.hit_id AS r_hit, l.score AS l_score, r.score AS r_score, l.refstart AS lrs, l.refend AS lre, r.refstart AS rrs, r.refend AS rre, l.qrystart AS lqs, l.qryend AS lqe, r.qrystart AS rqs, r.qryend AS rqe, l.strand AS ls, r.strand AS rs
  FROM bst l JOIN bst r ON right(l.qryid, 1) = 'L' AND right(r.qryid, 1) = 'R' AND left(l.qryid, length(l.qryid) - 1) = left(r.qryid, length(r.qryid) - 1))
"""


@query("E9d_best_flank_match", BEST + "SELECT qryid, hit_id, round(score, 9) AS score FROM bst", "flank_paf")
def e9d(s, d):
    return P.best_matches(_paf(s, d)).select("qryid", "hit_id", F.round("score", 9).alias("score"))


@query("E9e_match_gate", BEST + "SELECT gap_id, l_hit AS l_hit_id, r_hit AS r_hit_id FROM gate", "flank_paf")
def e9e(s, d):
    return P.match_gate(P.best_matches(_paf(s, d))).select("gap_id", "l_hit_id", "r_hit_id")


INSIDE = """, inside AS (SELECT h.* FROM patch_paf h JOIN (SELECT *, 'chr' || (gap_key % 20) || '.' || (gap_key // 20) AS gap_id, greatest(0, gap_pos - 500000) AS w0, least(6000000, gap_pos + 500000) AS w1 FROM gap_positions) g
 ON regexp_extract(h.qryid, '^(.*)\\.[LR]$', 1) = g.gap_id AND h.refid = g.query_contig, LATERAL (SELECT least(200000, (w1 - w0) // 2) AS rad) r WHERE refstart >= greatest(w0, gap_pos - rad) AND refend <= least(w1, gap_pos + rad))
"""


@query("E9f_search_window", INSIDE.replace(", inside", "WITH inside", 1) + "SELECT hit_id, hit_id IN (SELECT hit_id FROM inside) AS inside FROM patch_paf", "patch_paf", "gap_positions")
def e9f(s, d):
    hits = fixture(s, d, "patch_paf")
    gaps = _gp(s, d).select(F.concat(F.lit("chr"), (F.col("gap_key") % 20).cast("string"), F.lit("."), F.expr("gap_key div 20").cast("string")).alias("gap_id"), "query_contig", "gap_pos", F.lit(6_000_000).cast("bigint").alias("seq_length"))
    found = P.matches_in_window(hits, gaps).select("hit_id", F.lit(True).alias("_in"))
    return hits.select("hit_id").join(found, "hit_id", "left").select("hit_id", F.coalesce("_in", F.lit(False)).alias("inside"))


def cuts_sql(source: str) -> str:
    """Cut points of gate rows that have gs (gap start), sl (sequence length), pl (patch length), lf and rf (flanks)."""
    return BEST + f""", c0 AS (SELECT *, CASE WHEN lre > rrs THEN least(lre, gs) ELSE lre END AS lc0, CASE WHEN lre > rrs THEN greatest(rrs, gs + 100) ELSE rrs END AS rc0 FROM ({source}) g),
c1 AS (SELECT *, greatest(0, least(lc0, gs + 500000)) AS left_cut, greatest(gs - 500000, least(rc0, sl)) AS right_cut, CASE WHEN ls = '-' AND rs = '-' THEN pl - (pl - rf + rqe) ELSE lqs END AS a0, CASE WHEN ls = '-' AND rs = '-' THEN pl - (pl - rf + rqs) ELSE lqe END AS a1,
  CASE WHEN ls = '-' AND rs = '-' THEN pl - lqe ELSE pl - rf + rqs END AS b0, CASE WHEN ls = '-' AND rs = '-' THEN pl - lqs ELSE pl - rf + rqe END AS b1 FROM c0),
c2 AS (SELECT *, greatest(0, least(pl, CASE WHEN a1 > b0 THEN least(a0, b0) ELSE a1 END)) AS x, greatest(0, least(pl, CASE WHEN a1 > b0 THEN greatest(a1, b1) ELSE b0 END)) AS y FROM c1),
cuts AS (SELECT *, CASE WHEN x >= y THEN lf ELSE x END AS ins_start, CASE WHEN x >= y THEN greatest(lf, pl - rf) ELSE y END AS ins_end, greatest(0, right_cut - left_cut) AS removed FROM c2)
"""


CUTS = cuts_sql("SELECT *, least(lre, rrs) + 50 AS gs, 2000000 AS sl, 12000 AS pl, 5000 AS lf, 5000 AS rf FROM gate")


def _cuts(s, d):
    m = P.match_gate(P.best_matches(_paf(s, d)))
    m = m.withColumns({"gap_start": F.least("l_refend", "r_refstart") + 50, "seq_length": F.lit(2_000_000).cast("bigint"), "patch_length": F.lit(12_000).cast("bigint"), "left_flank": F.lit(5_000).cast("bigint"), "right_flank": F.lit(5_000).cast("bigint"), "has_cigar": F.lit(False)})
    return P.cut_points(m)


@query("E9g_patch_cut_points", CUTS + "SELECT gap_id, left_cut, right_cut, ins_start, ins_end, ins_end - ins_start - removed AS net FROM cuts", "flank_paf")
def e9g(s, d):
    return _cuts(s, d).select("gap_id", "left_cut", "right_cut", "ins_start", "ins_end", "net")


@query("E9h_accept_patch", CUTS + "SELECT gap_id, ins_end - ins_start - removed AS net FROM cuts WHERE abs(ins_end - ins_start - removed) > 2000", "flank_paf")
def e9hh(s, d):
    return P.accepted(_cuts(s, d), 2_000).select("gap_id", "net")


@query("E21_patch_summary", CUTS + "SELECT count(*) AS n, cast(sum(ins_end - ins_start) AS bigint) AS inserted, cast(sum(removed) AS bigint) AS removed, cast(sum(ins_end - ins_start - removed) AS bigint) AS net, round(avg((l_score + r_score) / 2), 6) AS mean_score FROM cuts", "flank_paf")
def e21(s, d):
    return P.patch_summary(_cuts(s, d)).withColumn("mean_score", F.round("mean_score", 6))


@query("E13b_reapply_patches", CUTS + "SELECT gap_id, left_cut + 1000 AS del_start, greatest(left_cut, right_cut) + 1000 AS del_end FROM cuts WHERE abs(ins_end - ins_start - removed) > 100", "flank_paf")
def e13b(s, d):
    """Accepted patches at positions that an insertion of 1,000 bases at the start has moved."""
    from ..operators.edits import lift_by_edits
    c = P.accepted(_cuts(s, d)).withColumn("del_end", F.greatest("left_cut", "right_cut"))
    edit = s.createDataFrame([("all", 0, 0, 0, 1000)], "seq_id string, del_start long, del_end long, src_start long, src_end long")
    num = c.withColumn("key", F.xxhash64("gap_id"))
    lift = lambda p: lift_by_edits(num.select("key", F.lit("all").alias("seq_id"), F.col(p).cast("bigint").alias("pos")), edit).select("key", F.col("lifted").alias(f"new_{p}"))
    out = num.join(lift("left_cut"), "key").join(lift("del_end"), "key")
    return out.select("gap_id", F.col("new_left_cut").alias("del_start"), F.col("new_del_end").alias("del_end"))


@query("E14_reheader_patches", "SELECT gap_key, 'gap' || (gap_pos + 1000) || '_patch1' AS header FROM gap_positions", "gap_positions")
def e14(s, d):
    old = F.concat(F.lit("gap"), F.col("gap_pos").cast("string"), F.lit("_patch1"))
    return _gp(s, d).select("gap_key", P.reheader(old, F.col("gap_pos") + 1000).alias("header"))


@query("E19_syntenic_contigs", "SELECT query_contig, ref_contig, cast(sum(abs(ref_end - ref_start) + 1) AS bigint) AS aligned, count(*) AS n FROM alignments WHERE abs(ref_end - ref_start) + 1 >= 10000 AND identity >= 95 GROUP BY ALL", "alignments")
def e19(s, d):
    return L.syntenic_contigs(_al(s, d))


# --- F: synteny ----------------------------------------------------------------

BLOCKS = AL.replace("WITH al", "WITH RECURSIVE al") + """,
num AS (SELECT *, row_number() OVER (PARTITION BY ref_contig ORDER BY r_min, aln_id) AS k FROM al),
walk AS (SELECT ref_contig, k, 0 AS block, r_min AS bs, r_max AS be, direction AS dir, 1 AS n FROM num WHERE k = 1
  UNION ALL SELECT m.ref_contig, m.k, CASE WHEN go THEN w.block ELSE w.block + 1 END, CASE WHEN go THEN w.bs ELSE m.r_min END, CASE WHEN go THEN greatest(w.be, m.r_max) ELSE m.r_max END, m.direction, CASE WHEN go THEN w.n + 1 ELSE 1 END
  FROM walk w JOIN num m ON m.ref_contig = w.ref_contig AND m.k = w.k + 1, LATERAL (SELECT m.direction = w.dir AND m.r_min - w.be > -10000 AND m.r_min - w.be < 100000 AS go) g),
blocks AS (SELECT ref_contig, block, min(bs) AS start, max(be) AS "end", any_value(dir) AS direction, max(n) AS n FROM walk GROUP BY ref_contig, block)
"""


@query("F1_synteny_blocks", BLOCKS + 'SELECT ref_contig, block, start, "end", direction, n FROM blocks', "alignments")
def f1(s, d):
    return Y.synteny_blocks(_al(s, d)).select("ref_contig", "block", "start", "end", "direction", "n")


@query("F2b_block_properties", BLOCKS + """, parts AS (SELECT m.*, w.block FROM num m JOIN walk w ON m.ref_contig = w.ref_contig AND m.k = w.k)
SELECT p.ref_contig, p.block, any_value(b."end" - b.start + 1) AS length, cast(count(DISTINCT query_contig) AS int) AS n_query, string_agg(DISTINCT query_contig, ',' ORDER BY query_contig) AS query_contigs, round(avg(identity), 6) AS identity FROM parts p JOIN blocks b USING (ref_contig, block) GROUP BY p.ref_contig, p.block""", "alignments")
def f2b(s, d):
    return Y.block_properties(Y.synteny_blocks(_al(s, d))).withColumn("identity", F.round("identity", 6))


@query("F2_block_summary", BLOCKS + 'SELECT ref_contig, direction, count(*) AS n_blocks, cast(sum("end" - start + 1) AS bigint) AS total, max("end" - start + 1) AS longest, cast(sum(n) AS bigint) AS n_alignments FROM blocks GROUP BY ref_contig, direction', "alignments")
def f2(s, d):
    return Y.block_summary(Y.synteny_blocks(_al(s, d)))


WIN = AL + """,
dist AS (SELECT g.gap_key, g.gap_pos, a.* EXCLUDE (query_contig), greatest(g.gap_pos - a.q_max, a.q_min - g.gap_pos, 0) AS far FROM gap_positions g JOIN al a USING (query_contig)),
side AS (SELECT gap_key, bool_or(far = 0) AS cross_, min(far) FILTER (WHERE q_max < gap_pos) AS dl, min(far) FILTER (WHERE q_min > gap_pos) AS dr FROM dist GROUP BY gap_key),
size AS (SELECT gap_key, CASE WHEN cross_ THEN 100000 WHEN dl IS NOT NULL AND dr IS NOT NULL AND greatest(dl, dr) <= 500000 THEN cast(ceil(greatest(dl, dr) / 100000.0) * 100000 AS bigint) END AS win FROM side),
near AS (SELECT d.*, z.win, far = 0 AS crossing FROM dist d JOIN size z USING (gap_key) WHERE far <= win),
supp AS (SELECT * FROM (SELECT gap_key, gap_pos, ref_contig, bool_or(crossing) AS crossing,
   arg_max(aln_id, (q_max, -aln_id)) FILTER (WHERE q_max < gap_pos OR crossing) AS l_id, arg_min(aln_id, (q_min, aln_id)) FILTER (WHERE q_min > gap_pos OR crossing) AS r_id FROM near GROUP BY ALL) t WHERE l_id IS NOT NULL AND r_id IS NOT NULL),
typ AS (SELECT s.*, l.direction AS ld, r.direction AS rd, l.q_min AS lq0, l.q_max AS lq1, r.q_min AS rq0, r.q_max AS rq1,
   CASE WHEN l.direction <> r.direction THEN 'type2' WHEN lap > 0 AND lap / (least(l.q_max - l.q_min, r.q_max - r.q_min) + 1) > 0.1 THEN 'type4' ELSE 'type1' END AS pair_type, lap > 0 AND lap / (least(l.q_max - l.q_min, r.q_max - r.q_min) + 1) > 0.1 AS lapped
   FROM supp s JOIN al l ON l.aln_id = s.l_id JOIN al r ON r.aln_id = s.r_id, LATERAL (SELECT least(l.r_max, r.r_max) - greatest(l.r_min, r.r_min) + 1 AS lap) o),
crossed AS (SELECT DISTINCT gap_key FROM near WHERE crossing),
votes AS (SELECT *, sum(n) OVER (PARTITION BY gap_key) AS n_refs, row_number() OVER (PARTITION BY gap_key ORDER BY n DESC, seen) AS rn FROM (SELECT gap_key, pair_type, count(*) AS n, min(ref_contig) AS seen FROM typ GROUP BY ALL) t),
etype AS (SELECT coalesce(v.gap_key, c.gap_key) AS gap_key, CASE WHEN c.gap_key IS NOT NULL THEN 'type1' ELSE v.pair_type END AS error_type,
   CASE WHEN c.gap_key IS NOT NULL THEN 'high' WHEN n_refs >= 3 AND n >= 2 THEN 'high' WHEN n_refs >= 2 THEN 'medium' ELSE 'low' END AS confidence, cast(coalesce(n_refs, 0) AS bigint) AS n_refs, c.gap_key IS NOT NULL AS crossing FROM (SELECT * FROM votes WHERE rn = 1) v FULL JOIN crossed c USING (gap_key)),
sided AS (SELECT t.*, e.error_type, CASE WHEN e.error_type = 'type2' AND pair_type = 'type2' THEN CASE WHEN ld = -1 THEN 'l' ELSE 'r' END WHEN e.error_type = 'type4' AND lapped THEN CASE WHEN lq1 - lq0 < rq1 - rq0 THEN 'l' ELSE 'r' END END AS sd,
   CASE WHEN e.error_type = 'type2' AND pair_type = 'type2' THEN gap_pos BETWEEN lq1 AND rq0 WHEN e.error_type = 'type4' AND lapped THEN gap_pos BETWEEN lq0 AND lq1 OR gap_pos BETWEEN rq0 AND rq1 END AS hit FROM typ t JOIN etype e USING (gap_key)),
agg AS (SELECT gap_key, min(lq1) FILTER (WHERE lq1 < gap_pos) AS l0, max(rq0) FILTER (WHERE rq0 > gap_pos) AS r1, min(CASE sd WHEN 'l' THEN lq0 WHEN 'r' THEN rq0 END) AS lo, max(CASE sd WHEN 'l' THEN lq1 WHEN 'r' THEN rq1 END) AS hi,
   arg_min(hit, ref_contig) FILTER (WHERE hit IS NOT NULL) AS hit, bool_or(least(gap_pos - lq1, rq0 - gap_pos) > 500000) AS large_distance, cast(sum(lq1 - lq0 + rq1 - rq0 + 2) AS bigint) AS anchor_length FROM sided GROUP BY gap_key),
ana AS (SELECT e.gap_key, p.gap_pos, e.error_type, e.confidence, e.n_refs, e.crossing, least(p.gap_pos, CASE WHEN x0 IS NOT NULL THEN x0 WHEN e.error_type = 'type1' AND l0 IS NOT NULL AND r1 IS NOT NULL THEN l0 + 1 ELSE coalesce(lo, p.gap_pos) END) AS replace_start,
   greatest(p.gap_pos, CASE WHEN x1 IS NOT NULL THEN x1 WHEN e.error_type = 'type1' AND l0 IS NOT NULL AND r1 IS NOT NULL THEN r1 - 1 ELSE coalesce(hi, p.gap_pos) END) AS replace_end,
   CASE WHEN e.crossing THEN true WHEN n_refs = 0 THEN false WHEN e.error_type = 'type1' THEN true ELSE coalesce(hit, false) END AS in_error_region, coalesce(large_distance, false) AS large_distance, coalesce(anchor_length, 0) AS anchor_length
   FROM etype e JOIN (SELECT DISTINCT gap_key, gap_pos FROM near) p USING (gap_key) LEFT JOIN agg USING (gap_key) LEFT JOIN (SELECT gap_key, min(q_min) AS x0, max(q_max) AS x1 FROM near WHERE crossing GROUP BY gap_key) x USING (gap_key)),
dec AS (SELECT *, in_error_region AND NOT large_distance AND confidence <> 'low' AS conservative, (in_error_region AND NOT large_distance AND confidence <> 'low') OR (in_error_region AND n_refs > 0 AND replace_end - replace_start + 1 > 0 AND anchor_length > replace_end - replace_start + 1) AS aggressive FROM ana)
"""


def _near(s, d):
    return Y.alignments_near_gap(_al(s, d), _gp(s, d))


def _evidence(s, d):
    return Y.gap_evidence(_al(s, d), _gp(s, d))


def _types(s, d):
    return Y.error_types(Y.with_pair_type(_evidence(s, d))).select("gap_key", "error_type", "confidence", "n_refs", "crossing")


def _analyses(s, d):
    return Y.analyses(_evidence(s, d))


@query("F3_alignments_near_gap", WIN + "SELECT gap_key, aln_id, win AS window, crossing FROM near", "alignments", "gap_positions")
def f3(s, d):
    return _near(s, d).select("gap_key", "aln_id", "window", "crossing")


@query("F4_gap_support", WIN + "SELECT gap_key, ref_contig, l_id, r_id, crossing FROM supp", "alignments", "gap_positions")
def f4(s, d):
    return Y.support_rows(_evidence(s, d)).select("gap_key", "ref_contig", F.col("left.aln_id").alias("l_id"), F.col("right.aln_id").alias("r_id"), "crossing")


PROJ = AL + """, proj AS (SELECT gap_key, ref_contig, avg(floor(CASE WHEN direction = 1 THEN r_min + off ELSE r_max - off END)) AS ref_pos, count(*) AS n FROM (SELECT g.gap_key, a.*, (g.gap_pos - q_min) * (r_max - r_min) / (q_max - q_min) AS off FROM gap_positions g JOIN al a ON g.query_contig = a.query_contig AND g.gap_pos BETWEEN q_min AND q_max AND q_max > q_min) t GROUP BY ALL)
"""


@query("F5_project_gap_to_ref", PROJ + "SELECT gap_key, ref_contig, round(ref_pos, 6) AS ref_pos, n FROM proj", "alignments", "gap_positions")
def f5(s, d):
    return Y.project_gap(_al(s, d), _gp(s, d)).withColumn("ref_pos", F.round("ref_pos", 6))


ASSESS = BLOCKS + PROJ.replace(AL, "", 1).lstrip(", ").join([", ", ""]) + """,
ask1 AS (SELECT g.gap_key, g.gap_pos, g.query_contig, t.ref_contig FROM gap_positions g JOIN (SELECT DISTINCT query_contig, ref_contig FROM al) t USING (query_contig)),
ends AS (SELECT query_contig, ref_contig, q_max AS at, arg_min(al, aln_id) AS l FROM al GROUP BY ALL),
begins AS (SELECT query_contig, ref_contig, q_min AS at, arg_min(al, aln_id) AS r FROM al GROUP BY ALL),
lf1 AS (SELECT k.gap_key, k.ref_contig, l['aln_id'] AS aln_id, l['r_min'] AS r_min, l['r_max'] AS r_max, l['q_min'] AS q_min, l['q_max'] AS q_max, l['direction'] AS direction FROM ask1 k ASOF JOIN ends e ON e.query_contig = k.query_contig AND e.ref_contig = k.ref_contig AND k.gap_pos > e.at),
rg1 AS (SELECT k.gap_key, k.ref_contig, r['aln_id'] AS aln_id, r['r_min'] AS r_min, r['r_max'] AS r_max, r['q_min'] AS q_min, r['q_max'] AS q_max, r['direction'] AS direction FROM ask1 k ASOF JOIN begins e ON e.query_contig = k.query_contig AND e.ref_contig = k.ref_contig AND k.gap_pos < e.at),
sd AS (SELECT k.*, l.aln_id AS lid, r.aln_id AS rid, l.r_min AS l0, r.r_min AS r0, l.direction AS ld, r.direction AS rd, least(k.gap_pos - l.q_max, r.q_min - k.gap_pos) AS gap FROM ask1 k LEFT JOIN lf1 l USING (gap_key, ref_contig) LEFT JOIN rg1 r USING (gap_key, ref_contig)),
cov AS (SELECT DISTINCT p.gap_key, p.ref_contig, true AS covered FROM proj p JOIN blocks b ON b.ref_contig = p.ref_contig AND p.ref_pos BETWEEN b.start AND b."end"),
sam AS (SELECT DISTINCT gap_key, s.ref_contig, true AS same FROM sd s JOIN blocks b ON b.ref_contig = s.ref_contig AND l0 BETWEEN b.start AND b."end" AND r0 BETWEEN b.start AND b."end" AND ld = b.direction AND rd = b.direction),
assess AS (SELECT gap_key, ref_contig, CASE WHEN covered THEN 'gap_in_synteny_block' WHEN p.ref_pos IS NOT NULL THEN 'gap_outside_synteny_blocks' WHEN lid IS NULL OR rid IS NULL THEN 'insufficient_anchors' WHEN same AND gap > 500000 THEN 'large_distance_with_synteny' WHEN same THEN 'synteny_present' ELSE 'no_synteny_between_anchors' END AS assessment, CASE WHEN lid IS NOT NULL AND rid IS NOT NULL THEN gap END AS anchor_distance
  FROM sd LEFT JOIN proj p USING (gap_key, ref_contig) LEFT JOIN cov USING (gap_key, ref_contig) LEFT JOIN sam USING (gap_key, ref_contig))
"""


@query("F17b_assessment_stats", ASSESS + "SELECT assessment, count(*) AS n FROM assess GROUP BY assessment", "alignments", "gap_positions")
def f17b(s, d):
    return Y.assessment_stats(Y.synteny_assessment(_al(s, d), _gp(s, d)))


@query("F6_synteny_assessment", ASSESS + "SELECT gap_key, ref_contig, assessment, anchor_distance FROM assess", "alignments", "gap_positions")
def f6(s, d):
    return Y.synteny_assessment(_al(s, d), _gp(s, d))


ALL_PAIRS = ASSESS + """, every AS (SELECT * FROM (SELECT DISTINCT query_contig FROM gap_positions) q, (SELECT 'ctg' || i AS ref_contig FROM range(10) t(i)) r)
"""


@query("F6b_assessment_of_pairs", ALL_PAIRS.replace("gap_positions", "(SELECT o_orderkey AS gap_key, 'chr' || (o_orderkey % 25) AS query_contig, (o_orderkey * 15485863) % 5000000 AS gap_pos FROM orders)") + """SELECT g.gap_key, e.ref_contig, coalesce(a.assessment, CASE WHEN e.ref_contig IN (SELECT ref_contig FROM blocks) THEN 'no_alignment_for_query' ELSE 'no_synteny_blocks' END) AS assessment
 FROM (SELECT o_orderkey AS gap_key, 'chr' || (o_orderkey % 25) AS query_contig FROM orders) g JOIN every e USING (query_contig) LEFT JOIN assess a ON a.gap_key = g.gap_key AND a.ref_contig = e.ref_contig""", "alignments")
def f6b(s, d):
    """Every gap against ten reference contigs, of which two have no alignment; a fifth of the gaps' contigs has none either."""
    gaps = s.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("gap_key"), F.concat(F.lit("chr"), (F.col("o_orderkey") % 25).cast("string")).alias("query_contig"), ((F.col("o_orderkey") * 15485863) % 5000000).alias("gap_pos"))
    pairs = gaps.select("query_contig").distinct().withColumn("ref_contig", F.explode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.concat(F.lit("ctg"), i.cast("string")))))
    return Y.synteny_assessment(_al(s, d), gaps, pairs).select("gap_key", "ref_contig", "assessment")


FAR = lambda text: text.replace("FROM alignments", "FROM far_alignments").replace("gap_positions", "far_gaps")


@query("F7_synteny_fallback_support", FAR(ASSESS + WIN.replace(AL, "", 1)) + """SELECT gap_key, ref_contig, lid AS l_id, rid AS r_id FROM sd JOIN assess USING (gap_key, ref_contig) WHERE lid IS NOT NULL AND rid IS NOT NULL
 AND assessment IN ('synteny_present', 'gap_in_synteny_block', 'large_distance_with_synteny') AND gap_key NOT IN (SELECT gap_key FROM near)""", "far_alignments", "far_gaps")
def f7(s, d):
    """Support of gaps that no window serves: contigs have a hole of 3 Mb there, and gaps lie in it."""
    al, gaps = fixture(s, d, "far_alignments"), fixture(s, d, "far_gaps")
    return Y.support_rows(Y.fallback_support(al, gaps, kept(Y.gap_evidence(al, gaps).select("gap_key")))).select("gap_key", "ref_contig", F.col("left.aln_id").alias("l_id"), F.col("right.aln_id").alias("r_id"))


@query("F8_error_type", WIN + "SELECT gap_key, error_type, confidence, n_refs, crossing FROM etype", "alignments", "gap_positions")
def f8(s, d):
    return _types(s, d)


@query("F9_confidence", WIN + "SELECT confidence, error_type, count(*) AS n FROM etype GROUP BY ALL", "alignments", "gap_positions")
def f9(s, d):
    return _types(s, d).groupBy("confidence", "error_type").agg(F.count("*").alias("n"))


@query("F10_ref_overlap", WIN + "SELECT gap_key, ref_contig, lapped, pair_type FROM typ", "alignments", "gap_positions")
def f10(s, d):
    return Y.support_rows(Y.with_pair_type(_evidence(s, d))).select("gap_key", "ref_contig", "lapped", "pair_type")


@query("F11_in_error_region", WIN + "SELECT gap_key, in_error_region FROM ana", "alignments", "gap_positions")
def f11(s, d):
    return _analyses(s, d).select("gap_key", "in_error_region")


@query("F12_replace_region", WIN + "SELECT gap_key, gap_pos, replace_start, replace_end FROM ana", "alignments", "gap_positions")
def f12(s, d):
    return _analyses(s, d).select("gap_key", "gap_pos", "replace_start", "replace_end")


@query("F13_large_distance", WIN + "SELECT gap_key, large_distance, anchor_length FROM ana", "alignments", "gap_positions")
def f13(s, d):
    return _analyses(s, d).select("gap_key", "large_distance", "anchor_length")


@query("F14_repair_decision", WIN + "SELECT gap_key, conservative, aggressive, CASE WHEN conservative THEN 'Conservative mode conditions met' WHEN aggressive THEN 'Aggressive mode sufficient anchors' ELSE 'Aggressive mode insufficient anchors' END AS reason FROM dec", "alignments", "gap_positions")
def f14(s, d):
    return Y.repair_decision(_analyses(s, d)).select("gap_key", "conservative", "aggressive", "reason")


MERGED = WIN + """, rg AS (SELECT g.query_contig AS seq_id, greatest(1, replace_start) AS s, replace_end AS e, error_type, confidence, anchor_length FROM dec JOIN gap_positions g USING (gap_key) WHERE conservative),
isl AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY seq_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, max(e) OVER (PARTITION BY seq_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM rg) t),
mg AS (SELECT seq_id, min(s) AS start, max(e) AS "end", string_agg(error_type, '+' ORDER BY s, e, error_type) AS error_type, min(CASE confidence WHEN 'low' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END) AS lv, cast(sum(anchor_length) AS bigint) AS anchor_length, count(*) AS n FROM isl GROUP BY seq_id, k)
"""


def _merged(s, d):
    r = Y.repair_decision(_analyses(s, d)).where("conservative")
    return Y.merge_regions(r.select(F.col("query_contig").alias("seq_id"), F.greatest(F.lit(1), "replace_start").cast("bigint").alias("start"), F.col("replace_end").alias("end"), "error_type", "confidence", "anchor_length"))


@query("F15_merge_replace_regions", MERGED + """SELECT seq_id, start, "end", error_type, CASE lv WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS confidence, anchor_length, n FROM mg""", "alignments", "gap_positions")
def f15(s, d):
    return _merged(s, d)


@query("F16_mask_regions", MERGED + 'SELECT seq_id, start - 1 AS del_start, "end" AS del_end, 100 AS src_end FROM mg', "alignments", "gap_positions")
def f16(s, d):
    return Y.mask_edits(_merged(s, d)).select("seq_id", "del_start", "del_end", "src_end")


@query("F17_repair_stats", WIN + "SELECT error_type, count(*) AS n, count(*) FILTER (WHERE in_error_region) AS n_inside, count(*) FILTER (WHERE conservative) AS n_conservative, count(*) FILTER (WHERE aggressive AND NOT conservative) AS n_extra, count(*) FILTER (WHERE NOT aggressive) AS n_skipped FROM dec GROUP BY error_type", "alignments", "gap_positions")
def f17(s, d):
    return Y.repair_stats(Y.repair_decision(_analyses(s, d)))


STRAT = """WITH r AS (SELECT query_contig AS seq_id, count(*) AS n_gaps, count(*) FILTER (WHERE gap_key % 3 = 0) AS n_extracted, count(*) FILTER (WHERE gap_key % 6 = 0) AS n_applied FROM gap_positions GROUP BY 1),
st AS (SELECT *, CASE WHEN n_gaps = 0 THEN 'no_gaps' WHEN n_extracted = 0 THEN 'no_patch_fixer' WHEN n_applied = 0 THEN 'full_fixer_reuse_patches' ELSE 'partial_success_no_fixer' END AS strategy FROM r) """


def _strategy(s, d):
    n = lambda c, a: F.count(F.when(c, 1)).alias(a)
    r = _gp(s, d).groupBy(F.col("query_contig").alias("seq_id")).agg(F.count("*").alias("n_gaps"), n(F.col("gap_key") % 3 == 0, "n_extracted"), n(F.col("gap_key") % 6 == 0, "n_applied"))
    return Y.chrom_strategy(r)


@query("F18_chrom_strategy", STRAT + "SELECT seq_id, n_gaps, n_extracted, n_applied, strategy, round(100 * n_applied / n_gaps, 6) AS success_rate FROM st", "gap_positions")
def f18(s, d):
    return _strategy(s, d).withColumn("success_rate", F.round("success_rate", 6))


@query("F19_strategy_counts", STRAT + "SELECT strategy, count(*) AS n FROM st GROUP BY strategy", "gap_positions")
def f19(s, d):
    return _strategy(s, d).groupBy("strategy").agg(F.count("*").alias("n"))


@query("N5b_strategies_only", STRAT + "SELECT seq_id, strategy FROM st WHERE seq_id = 'chr3'", "gap_positions")
def n5b(s, d):
    return _strategy(s, d).where("seq_id = 'chr3'").select("seq_id", "strategy")
