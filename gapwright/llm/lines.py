"""Cross-site boilerplate lines, with DataFrame functions only.

A line (without the blanks around it, at least `least_bytes` long) that stands on `least_sites` sites or more is
boilerplate and is taken out of every document. Lines are counted by two hashes (96 bits); those that occur
often enough, on more than one site, get a HyperLogLog sketch of their sites, merged by aggregation; where the
estimate is within three standard errors of the threshold, the distinct sites are counted exactly. By default every
document loses all such lines, whatever their share of it. With `most_share`, a document of which they are more
than that share of the bytes in lines may be a copy of a document rather than a page around its own text: it loses only
the proven lines, those that reach `least_sites` on the documents below that share alone. Text that stands on
many sites only because documents were copied is never proven, and is left to document deduplication.

Nulls: a null text stays null and has no lines; a null site is a site of its own. Repeated rows count as often as
they occur and get the same answer. An empty table gives no rows. Other columns pass through in struct `row`,
whatever their names. A line is split off and hashed within its row, so a very long text is one task's row and no more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANKS, small, staged

LEAST_SITES, LEAST_BYTES, LG_K = 5, 15, 12


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(docs: DataFrame, least_bytes: int, *columns: str) -> DataFrame:
    """Two hashes of each line that is long enough, and its bytes as it stands."""
    cut = docs.select(*columns, F.explode(F.split("text", "\n", -1)).alias("line")).select(*columns, _bare(F.col("line")).alias("line"), F.octet_length("line").alias("size"))
    return cut.where(F.octet_length("line") >= least_bytes).select(*columns, F.xxhash64("line").alias("k1"), F.hash("line").alias("k2"), "size")


def _spread(lines: DataFrame, least_sites: int) -> DataFrame:
    """lines (k1, k2, site) -> k1, k2 of those on at least least_sites sites (a staged table)."""
    # a line on enough sites occurs at least as often
    often = lines.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("site").alias("lo"), F.max("site").alias("hi"))
    often = staged(often.where((F.col("n") >= least_sites) & ((F.col("lo") != F.col("hi")) | F.lit(least_sites <= 1))).select("k1", "k2"))
    pairs = lines.join(small(often), ["k1", "k2"], "left_semi")
    sketched = staged(pairs.groupBy("k1", "k2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("n_sites")))
    margin = 3 * 1.04 / 2 ** (LG_K / 2)
    near = staged(sketched.where(F.col("n_sites").between(least_sites * (1 - margin), least_sites * (1 + margin))).select("k1", "k2"))
    exact = pairs.join(small(near), ["k1", "k2"], "left_semi").groupBy("k1", "k2", "site").agg(F.count("*").alias("n")).groupBy("k1", "k2").agg(F.count("*").alias("n_sites"))
    sure = sketched.where(F.col("n_sites") > least_sites * (1 + margin))
    return staged(sure.select("k1", "k2").unionByName(exact.where(F.col("n_sites") >= least_sites).select("k1", "k2")))


def _sited(site: Column) -> Column:
    return F.xxhash64(F.coalesce(site, F.lit("\0"))).alias("site")


def boilerplate(docs: DataFrame, least_sites: int = LEAST_SITES, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """docs (text, site) -> k1, k2 of the boilerplate lines (a staged table)."""
    return _spread(_lines(docs.select("text", _sited(F.col("site"))), least_bytes, "site"), least_sites)


def stripped(docs: DataFrame, least_sites: int = LEAST_SITES, least_bytes: int = LEAST_BYTES, most_share: float | None = None, text_col: str = "text", site_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """Each row of docs as struct `row`, with text (boilerplate taken out), n_lines and n_removed."""
    text = F.col(text_col).cast("string")
    known = [F.col(id_col).cast("string"), text]
    key = [F.xxhash64(*known).alias("g1"), F.hash(*known).alias("g2")]
    total = F.octet_length(text) - (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))))
    source = docs.select(*key, text.alias("text"), _sited(F.col(site_col).cast("string")), total.alias("total"), F.monotonically_increasing_id().alias("copy"))
    keys = _spread(_lines(source, least_bytes, "site"), least_sites)
    # the boilerplate of each document that has any (rows of equal id and text are one here)
    found = _lines(source, least_bytes, "g1", "g2", "copy", "site", "total").join(small(keys), ["k1", "k2"], "left_semi")
    if most_share is not None:
        found = staged(found.groupBy("g1", "g2", "copy", "total", "site", "k1", "k2").agg(F.sum("size").alias("size")))
        over = found.groupBy("g1", "g2", "copy").agg(F.sum("size").alias("gone"), F.max("total").alias("total")).where(F.col("gone") > most_share * F.col("total")).select("g1", "g2").distinct()
        over = staged(over.withColumn("over", F.lit(True)))
        found = staged(found.join(small(over), ["g1", "g2"], "left"))
        own = found.where("over is null")
        found = own.unionByName(found.where("over").join(small(_spread(own, least_sites)), ["k1", "k2"], "left_semi"))
    marks = staged(found.groupBy("g1", "g2").agg(F.collect_set("k1").alias("marks")))
    is_mark = lambda x: (F.octet_length(_bare(x)) >= least_bytes) & F.array_contains("marks", F.xxhash64(_bare(x)))
    # by shuffle at every size: what is joined grows with the documents
    df = docs.select(F.struct("*").alias("row"), *key).hint("merge").join(marks, ["g1", "g2"], "left").withColumn("text", F.col("row")[text_col].cast("string"))
    df = df.withColumn("cut", F.split("text", "\n", -1)).withColumn("rest", F.when(F.col("marks").isNotNull(), F.filter("cut", lambda x: ~is_mark(x))))
    changed = F.col("rest").isNotNull()
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size("cut"))
    return df.select("row", F.when(changed, F.array_join("rest", "\n")).otherwise(F.col("text")).alias("text"), n.cast("long").alias("n_lines"), F.when(changed, F.size("cut") - F.size("rest")).otherwise(0).cast("long").alias("n_removed"))


def op2_site_spread(spark, sf_dir: str) -> DataFrame:
    """Query: what is left of every document."""
    out = stripped(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


OP2_SQL = r"""
WITH lines AS (SELECT doc_id, source, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
               FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents) t),
marks AS (SELECT line FROM lines WHERE strlen(line) >= 15 GROUP BY line HAVING count(DISTINCT coalesce(source, chr(1))) >= 5),
pieces AS (SELECT doc_id, text, i, l, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) IN (SELECT line FROM marks) AS gone
           FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) t),
sums AS (SELECT doc_id, any_value(text) AS text, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_gone,
                string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS rest
         FROM pieces GROUP BY doc_id)
SELECT doc_id, n_lines, n_gone AS n_removed, sha256(CASE WHEN n_gone > 0 THEN coalesce(rest, '') ELSE text END) AS text_sha256
FROM sums"""
