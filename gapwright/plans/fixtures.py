"""Tables of genome-repair shapes derived from the given star-schema tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL = {
    "seqs": """SELECT 'chr' || cast(doc_id AS string) AS seq_id, doc_id AS seq_ord,
       regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGT'), '[^ACGT]', 'N'{G}) AS bases
FROM documents""",
    "telo_seqs": """SELECT seq_id, seq_ord,
       repeat('TTTAGGG', cast(seq_ord % 40 AS int)) || substr(bases, 1, 3000) ||
       repeat('CCCTAAA', cast(seq_ord % 31 AS int)) || substr(bases, 3001) ||
       repeat('TTAGGG', cast(seq_ord % 23 AS int)) AS bases
FROM seqs""",
    "alignments": """SELECT aln_id, ref_contig, query_contig, identity,
       r0 AS ref_start, r0 + len AS ref_end,
       CASE WHEN rev = 1 THEN q0 + len ELSE q0 END AS query_start,
       CASE WHEN rev = 1 THEN q0 ELSE q0 + len END AS query_end
FROM (SELECT (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100
               + cast(floor(l_quantity) AS bigint) AS aln_id,
             'ctg' || cast(l_suppkey % 8 AS string) AS ref_contig,
             'chr' || cast(l_partkey % 20 AS string) AS query_contig,
             100.0 - round(l_discount * 100) AS identity,
             (l_orderkey * 7919 + l_linenumber * 104729) % 5000000 + 1 AS q0,
             (l_orderkey * 7919 + l_linenumber * 104729) % 100000 + 1
               + cast(floor(l_extendedprice) AS bigint) % 200000 AS r0,
             10000 + cast(floor(l_quantity) AS bigint) * 400 AS len,
             CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS rev
      FROM lineitem) t""",
    "gap_positions": """SELECT o_orderkey AS gap_key, 'chr' || cast(o_orderkey % 20 AS string) AS query_contig,
       (o_orderkey * 15485863) % 5000000 AS gap_pos
FROM orders""",
    "flank_paf": """SELECT (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100
         + cast(floor(l_quantity) AS bigint) AS hit_id,
       'chr' || cast(l_orderkey % 20 AS string) || '.' || cast(floor(l_orderkey / 20) AS bigint) || '.' ||
         CASE WHEN l_linenumber % 2 = 1 THEN 'L' ELSE 'R' END AS qryid,
       cast(5000 AS bigint) AS qrylen, cast(0 AS bigint) AS qrystart,
       800 + cast(floor(l_quantity) AS bigint) * 80 AS qryend,
       CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE '+' END AS strand,
       'ctg' || cast(l_orderkey % 8 AS string) AS refid, cast(2000000 AS bigint) AS reflen,
       (l_partkey * 7919) % 900000 AS refstart,
       (l_partkey * 7919) % 900000 + 800 + cast(floor(l_quantity) AS bigint) * 80 AS refend,
       cast(floor((800 + floor(l_quantity) * 80) * (100 - round(l_discount * 700)) / 100) AS bigint) AS matches,
       800 + cast(floor(l_quantity) AS bigint) * 80 AS alnlen,
       l_suppkey * 7 % 61 AS mapq
FROM lineitem""",
    "far_alignments": """SELECT aln_id, ref_contig, query_contig, identity, ref_start, ref_end,
       query_start + CASE WHEN least(query_start, query_end) > 2500000 THEN 3000000 ELSE 0 END AS query_start,
       query_end + CASE WHEN least(query_start, query_end) > 2500000 THEN 3000000 ELSE 0 END AS query_end
FROM alignments""",
    "far_gaps": """SELECT gap_key, query_contig, gap_pos + CASE WHEN gap_pos > 2500000 THEN 1500000 ELSE 0 END AS gap_pos
FROM gap_positions""",
    "patch_paf": """SELECT hit_id, 'chr' || cast(gap_key % 20 AS string) || '.' || cast(floor(gap_key / 20) AS bigint) || '.' || side AS qryid,
       cast(10000 AS bigint) AS qrylen, cast(0 AS bigint) AS qrystart, size AS qryend, '+' AS strand, query_contig AS refid, cast(6000000 AS bigint) AS reflen,
       CASE WHEN side = 'L' THEN greatest(0, gap_pos - size - away) ELSE gap_pos + 100 + away END AS refstart,
       CASE WHEN side = 'L' THEN greatest(0, gap_pos - size - away) + size ELSE gap_pos + 100 + away + size END AS refend,
       cast(floor(size * (100 - round(l_discount * 400)) / 100) AS bigint) AS matches, size AS alnlen, l_suppkey * 7 % 61 AS mapq
FROM (SELECT (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100
               + cast(floor(l_quantity) AS bigint) AS hit_id, l_orderkey, l_suppkey, l_discount,
             CASE WHEN l_linenumber % 2 = 1 THEN 'L' ELSE 'R' END AS side,
             800 + cast(floor(l_quantity) AS bigint) * 80 AS size, l_partkey * 7919 % 260000 AS away
      FROM lineitem) h JOIN gap_positions g ON h.l_orderkey = g.gap_key""",
    "wide_alignments": """SELECT aln_id, ref_contig, query_contig, identity, ref_start, ref_end,
       query_start + 19 * least(query_start, query_end) AS query_start, query_end + 19 * least(query_start, query_end) AS query_end
FROM alignments""",
    "wide_gaps": """SELECT gap_key, query_contig, 20 * gap_pos AS gap_pos
FROM gap_positions""",
    "wide_paf": """SELECT hit_id, qryid, qrylen, qrystart, qryend, strand, refid, cast(120000000 AS bigint) AS reflen,
       refstart + 19 * g.gap_pos AS refstart, refend + 19 * g.gap_pos AS refend, matches, alnlen, mapq
FROM patch_paf h JOIN gap_positions g ON g.gap_key = cast(floor(h.hit_id / 1000000000000) AS bigint)""",
    "fill_paf": """SELECT hit_id, 'chr' || cast(ord % 1000 AS string) || '.' || cast(1 + floor(ord / 1000) % 2 AS bigint) || '.' || right(qryid, 1) AS qryid,
       qrylen, qrystart, qryend, strand, refid, reflen, refstart, refend, matches, alnlen, mapq
FROM (SELECT *, cast(floor(hit_id / 1000000000000) AS bigint) AS ord FROM flank_paf) t""",
    "dense_seqs": """SELECT 'chr' || cast(doc_id AS string) AS seq_id, doc_id AS seq_ord,
       translate(regexp_replace(text, '[^a-zA-Z]', ''{G}), 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGT') AS bases
FROM documents""",
}
_FROM = {"far_alignments": ("alignments",), "far_gaps": ("gap_positions",), "patch_paf": ("lineitem", "gap_positions"), "dense_seqs": ("documents",), "fill_paf": ("flank_paf",), "wide_alignments": ("alignments",), "wide_gaps": ("gap_positions",), "wide_paf": ("patch_paf", "gap_positions"), "seqs": ("documents",), "telo_seqs": ("seqs",), "alignments": ("lineitem",), "gap_positions": ("orders",), "flank_paf": ("lineitem",)}


#: How ids begin, and how they do where a long doesn't hold them.
_LONG, _WIDE = "(((l_orderkey * 10", "(((cast(l_orderkey AS decimal(19, 0)) * 10"


_told: dict[tuple[str, str], bool] = {}


def _beyond(spark: SparkSession, path: str) -> bool:
    """Whether ids that the SQL makes of lineitem's keys may be beyond a long (from some 9.2 million orders on)."""
    where = (spark.sparkContext.applicationId, path)
    if where not in _told:
        keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        order, line, part, supplier = spark.read.parquet(path).agg(*(F.coalesce(F.max(c), F.lit(0)).cast("bigint") for c in keys)).first()
        _told[where] = (((order * 10 + line) * 100_000 + part) * 10_000 + supplier) * 100 + 100 >= 1 << 63
    return _told[where]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame (its sources are passed to spark.sql, so no view is left behind)."""
    sources = {t: fixture(spark, sf_dir, t) if t in SQL else spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _FROM[name]}
    text = SQL[name].replace("{G}", "")
    if _LONG in text and _beyond(spark, f"{sf_dir}/lineitem.parquet"):
        text = text.replace(_LONG, _WIDE)  # the same ids, as decimals
    for t in sources:
        text = re.sub(rf"(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **sources)


def oracle(body: str, *names: str) -> str:
    """DuckDB text: the derived tables as common table expressions before body (which may begin with its own)."""
    wanted = set(names)
    for n in reversed(SQL):  # a table stands after those it reads
        wanted |= {t for t in _FROM[n] if t in SQL} if n in wanted else set()
    need = [n for n in SQL if n in wanted]
    parts = [f"{n} AS ({SQL[n].replace('{G}', ", 'g'")})" for n in need]
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join([*parts, body[15:].lstrip()])
    if body.upper().startswith("WITH "):
        parts.append(body[5:].lstrip())
        return "WITH " + ",\n".join(parts)
    return f"WITH {', '.join(parts)}\n{body}" if parts else body
