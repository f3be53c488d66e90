"""Repair edits as a table, resolved once into a segment table and materialised on the output grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import reverse_complement
from ..sources.scratch import dropped, kept
from .gaps import GRID

EDIT = ["seq_id", "del_start", "del_end", "src_kind", "src_id", "src_start", "src_end", "strand", "priority"]


ORDER = ("del_start", "del_end", "_late")


def _first_places(edits: DataFrame) -> DataFrame:
    """Edits of one priority (with chain, id and _late), greedily from the right, without walking a chain: each edit's next is the first in order
    that ends at or before its start (a running maximum), and those on the path from a chain's first are found by
    doubling the step, so a chain of n edits takes about log2(n) rounds of joins by id."""
    who = F.struct(*ORDER, "id")
    empty = F.col("del_start") == F.col("del_end")
    # at one place: edits that end there, then empty ones in reverse order (each sees those after it), then edits that begin there
    ends = edits.select("seq_id", "chain", F.col("del_end").alias("at"), F.when(empty, 1).otherwise(0).alias("o"), "_late", F.when(empty, F.col("id")).alias("id"), who.alias("who"))
    asks = edits.where(~empty).select("seq_id", "chain", F.col("del_start").alias("at"), F.lit(2).alias("o"), "_late", "id", F.lit(None).cast(ends.schema["who"].dataType).alias("who"))
    line = Window.partitionBy("seq_id", "chain").orderBy("at", "o", "_late").rowsBetween(Window.unboundedPreceding, -1)
    jump = kept(ends.unionByName(asks).withColumn("next", F.max("who").over(line)["id"]).where("id is not null").select("id", "next"))
    reached = kept(edits.groupBy("seq_id", "chain").agg(F.max(who)["id"].alias("id")).select("id"))
    while True:
        more = jump.join(reached, "id").where("next is not null").select(F.col("next").alias("id"))
        after = kept(reached.unionByName(more).distinct())
        if after.count() == reached.count():
            break
        far = jump.select(F.col("id").alias("next"), F.col("next").alias("_far"))
        step = kept(jump.join(far, "next").select("id", F.col("_far").alias("next")))
        dropped(jump, reached)
        jump, reached = step, after
    return edits.join(reached, "id", "left_semi")


def _clear_of(edits: DataFrame, taken: DataFrame) -> DataFrame:
    """Edits that overlap none of those taken: none that begins before them ends behind their start, none after begins before their end."""
    none = {c: F.lit(None).cast(edits.schema[c].dataType).alias(c) for c in edits.columns if c not in ("seq_id", "chain")}
    asks = edits.select("*", F.col("del_start").alias("_at"), F.lit(0).alias("_o"), F.lit(None).cast("bigint").alias("_s"), F.lit(None).cast("bigint").alias("_e"))
    have = taken.select("seq_id", "chain", *(none[c] for c in edits.columns if c in none), F.col("del_start").alias("_at"), F.lit(1).alias("_o"), F.col("del_start").alias("_s"), F.col("del_end").alias("_e"))
    up = Window.partitionBy("seq_id", "chain").orderBy("_at", "_o").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("seq_id", "chain").orderBy(F.desc("_at"), F.desc("_o")).rowsBetween(Window.unboundedPreceding, -1)
    both = asks.unionByName(have).withColumn("_before", F.max("_e").over(up)).withColumn("_after", F.min("_s").over(down)).where("_o = 0")
    free = (F.col("_before").isNull() | (F.col("_before") <= F.col("del_start"))) & (F.col("_after").isNull() | (F.col("del_end") <= F.col("_after")))
    return both.where(free).select(edits.columns)


def resolve(edits: DataFrame) -> DataFrame:
    """Edits of a sequence that don't overlap, taken greedily: the lowest priority value first, then the rightmost, each
    unless one taken before overlaps it. (Edits that only touch don't overlap.)

    Of edits that overlap none or one other the better stays at once. Longer chains are taken priority by priority (there are as many
    rounds as priorities in use), each without those that earlier ones overlap; no chain is one group or one task's walk."""
    e = edits.where("del_end >= del_start").withColumn("id", F.xxhash64(*EDIT)).dropDuplicates(EDIT)
    # of edits of one place the smallest id goes first
    e = e.withColumn("_late", -F.col("id"))
    w = Window.partitionBy("seq_id").orderBy("del_start", "del_end", "id")
    before = F.max("del_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    e = e.withColumn("_o", F.when(before.isNull() | (F.col("del_start") >= before), 1).otherwise(0)).withColumn("chain", F.sum("_o").over(w))
    better = Window.partitionBy("seq_id", "chain").orderBy("priority", F.desc("del_start"), F.desc("del_end"), "id")
    e = kept(e.withColumn("_r", F.row_number().over(better)).withColumn("_n", F.count("*").over(Window.partitionBy("seq_id", "chain"))))
    out = e.where("_n <= 2 and _r = 1").select(*EDIT)
    long, taken = e.where("_n > 2").select(*EDIT, "id", "chain", "_late"), None
    for level in long.select("priority").distinct().orderBy("priority").collect():
        own = long.where(F.col("priority").eqNullSafe(F.lit(level.priority)))
        own = kept(own if taken is None else _clear_of(own, taken))
        picked = _first_places(own)
        taken = kept(picked if taken is None else picked.unionByName(taken))
    return out if taken is None else out.unionByName(taken.select(*EDIT))


def apply_edits(edits: DataFrame, seqs: DataFrame) -> DataFrame:
    """Segment table: seq_id, n, kind ('seq' a part of the own sequence, 'N', or a source table), src_id, src_start, src_end, strand, out_start.

    seqs: seq_id, seq_length. Edits must not overlap (see resolve)."""
    w = Window.partitionBy("seq_id").orderBy("del_start", "del_end")
    before = edits.select("seq_id", F.coalesce(F.lag("del_end").over(w), F.lit(0)).cast("bigint").alias("src_start"), F.col("del_start").alias("src_end"), F.col("del_start").alias("at"), F.lit(0).alias("o"), F.lit("seq").alias("kind"), F.col("seq_id").alias("src_id"), F.lit("+").alias("strand"))
    new = edits.select("seq_id", "src_start", "src_end", F.col("del_start").alias("at"), F.lit(1).alias("o"), F.col("src_kind").alias("kind"), "src_id", "strand")
    ends = edits.groupBy("seq_id").agg(F.max("del_end").alias("last"))
    tail = seqs.join(ends, "seq_id", "left").select("seq_id", F.coalesce("last", F.lit(0)).cast("bigint").alias("src_start"), F.col("seq_length").alias("src_end"), F.col("seq_length").alias("at"), F.lit(2).alias("o"), F.lit("seq").alias("kind"), F.col("seq_id").alias("src_id"), F.lit("+").alias("strand"))
    rows = before.unionByName(new).unionByName(tail).where("src_end > src_start")
    order = Window.partitionBy("seq_id").orderBy("at", "o")
    size = F.col("src_end") - F.col("src_start")
    out = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint")
    return rows.select("seq_id", F.row_number().over(order).alias("n"), "kind", "src_id", "src_start", "src_end", "strand", out.alias("out_start"))


def materialize(segments: DataFrame, chunks: DataFrame, grid: int = GRID) -> DataFrame:
    """seq_id, chunk_ix, start, bases on the output grid.

    chunks: kind, seq_id, chunk_ix, start, bases of every source ('seq' and others) on one grid. Segments meet the
    chunks they touch by (kind, id, chunk), never by range alone; at most one output chunk of bases is gathered in a row."""
    real = segments.where("kind <> 'N'").select("*", F.explode(F.expr(f"sequence(src_start div {grid}, (src_end - 1) div {grid})")).alias("chunk_ix"))
    c = chunks.select("kind", F.col("seq_id").alias("src_id"), F.col("chunk_ix").cast("bigint").alias("chunk_ix"), F.col("start").alias("c0"), "bases")
    hit = real.join(c, ["kind", "src_id", "chunk_ix"])
    lo, hi = F.greatest("src_start", "c0"), F.least("src_end", F.col("c0") + F.length("bases"))
    part = F.expr("substring(bases, cast(lo - c0 + 1 as int), cast(hi - lo as int))")
    hit = hit.withColumn("lo", lo).withColumn("hi", hi).withColumn("piece", part)
    at = F.when(F.col("strand") == "-", F.col("out_start") + F.col("src_end") - F.col("hi")).otherwise(F.col("out_start") + F.col("lo") - F.col("src_start"))
    pieces = hit.select("seq_id", at.alias("at"), F.when(F.col("strand") == "-", reverse_complement(F.col("piece"))).otherwise(F.col("piece")).alias("piece"))
    filler = segments.where("kind = 'N'").select("seq_id", "out_start", (F.col("src_end") - F.col("src_start")).alias("size"))
    filler = filler.select("seq_id", "out_start", "size", F.explode(F.expr(f"sequence(0, (size - 1) div {grid})")).alias("k"))
    filler = filler.select("seq_id", (F.col("out_start") + F.col("k") * grid).alias("at"), F.expr(f"repeat('N', cast(least({grid}, size - k * {grid}) as int))").alias("piece"))
    every = pieces.unionByName(filler).where("piece <> ''")
    cut = every.select("*", F.explode(F.expr(f"sequence(at div {grid}, (at + length(piece) - 1) div {grid})")).alias("chunk_ix"))
    lo, hi = F.greatest(F.col("at"), F.col("chunk_ix") * grid), F.least(F.col("at") + F.length("piece"), (F.col("chunk_ix") + 1) * grid)
    cut = cut.withColumn("lo", lo).withColumn("hi", hi).select("seq_id", "chunk_ix", "lo", F.expr("substring(piece, cast(lo - at + 1 as int), cast(hi - lo as int))").alias("piece"))
    whole = cut.groupBy("seq_id", "chunk_ix").agg(F.sort_array(F.collect_list(F.struct("lo", "piece"))).alias("p"))
    return whole.select("seq_id", F.col("chunk_ix").cast("int").alias("chunk_ix"), (F.col("chunk_ix") * grid).alias("start"), F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("bases"))


def slice_bases(regions: DataFrame, chunks: DataFrame, grid: int = GRID) -> DataFrame:
    """regions (key, seq_id, start, end: 1-based, inclusive, clipped) -> key, bases."""
    seg = regions.select(F.col("key").alias("seq_id"), F.lit("seq").alias("kind"), F.col("seq_id").alias("src_id"), (F.greatest("start", F.lit(1)) - 1).alias("src_start"), F.col("end").alias("src_end"))
    size = chunks.groupBy(F.col("seq_id").alias("src_id")).agg(F.max(F.col("start") + F.length("bases")).alias("size"))
    seg = seg.join(size, "src_id").withColumn("src_end", F.least("src_end", "size")).where("src_end > src_start")
    real = seg.select("*", F.explode(F.expr(f"sequence(src_start div {grid}, (src_end - 1) div {grid})")).alias("chunk_ix"))
    hit = real.join(chunks.select(F.col("seq_id").alias("src_id"), F.col("chunk_ix").cast("bigint").alias("chunk_ix"), F.col("start").alias("c0"), "bases"), ["src_id", "chunk_ix"])
    hit = hit.withColumn("lo", F.greatest("src_start", "c0")).withColumn("hi", F.least("src_end", F.col("c0") + F.length("bases")))
    parts = hit.select("seq_id", "lo", F.expr("substring(bases, cast(lo - c0 + 1 as int), cast(hi - lo as int))").alias("piece"))
    whole = parts.groupBy("seq_id").agg(F.sort_array(F.collect_list(F.struct("lo", "piece"))).alias("p"))
    return whole.select(F.col("seq_id").alias("key"), F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("bases"))


def agp_rows(segments: DataFrame) -> DataFrame:
    """object, beg, end (1-based, true offsets), part, type (W or N), component, comp_beg, comp_end, orientation."""
    size = F.col("src_end") - F.col("src_start")
    gap = F.col("kind") == "N"
    return segments.select(F.col("seq_id").alias("object"), (F.col("out_start") + 1).alias("beg"), (F.col("out_start") + size).alias("end"), F.col("n").alias("part"), F.when(gap, "N").otherwise("W").alias("type"), F.when(gap, size.cast("string")).otherwise(F.col("src_id")).alias("component"), F.when(gap, F.lit("scaffold")).otherwise((F.col("src_start") + 1).cast("string")).alias("comp_beg"), F.when(gap, F.lit("yes")).otherwise(F.col("src_end").cast("string")).alias("comp_end"), F.when(gap, F.lit("align_genus")).otherwise(F.col("strand")).alias("orientation"))


def lift_by_edits(positions: DataFrame, edits: DataFrame) -> DataFrame:
    """positions (key, seq_id, pos) -> key, pos, lifted: shifted by all edits that end at or before them; inside a deletion, its start.

    Edits and positions are put on one line and summed, so neither side is paired with the other."""
    delta = F.col("src_end") - F.col("src_start") - (F.col("del_end") - F.col("del_start"))
    e = edits.select("seq_id", F.col("del_end").alias("at"), F.lit(0).alias("o"), delta.alias("d"), F.lit(None).cast("bigint").alias("key"), "del_start", "del_end")
    p = positions.select("seq_id", F.col("pos").alias("at"), F.lit(1).alias("o"), F.lit(0).cast("bigint").alias("d"), F.col("key").cast("bigint").alias("key"), F.lit(None).cast("bigint").alias("del_start"), F.lit(None).cast("bigint").alias("del_end"))
    up = Window.partitionBy("seq_id").orderBy("at", "o").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("seq_id").orderBy(F.desc("at"), F.desc("o")).rowsBetween(Window.unboundedPreceding, -1)  # read backwards: one pass
    both = e.unionByName(p).withColumn("shift", F.sum("d").over(up)).withColumn("next", F.last("del_start", ignorenulls=True).over(down))
    inside = F.col("next").isNotNull() & (F.col("next") < F.col("at"))
    return both.where("o = 1").select("key", "seq_id", F.col("at").alias("pos"), (F.when(inside, F.col("next")).otherwise(F.col("at")) + F.col("shift")).alias("lifted"))


def lift_by_rank(old: DataFrame, new: DataFrame, least: int = 10) -> DataFrame:
    """Old gap starts to new ones: in order where a sequence has as many gaps (of `least`) as before, else the nearest new one, else unchanged."""
    def ranked(g: DataFrame, t: str) -> DataFrame:
        w = Window.partitionBy("seq_id")
        return g.where(F.col("length") >= least).select("seq_id", F.col("start").alias(f"{t}_start"), F.row_number().over(w.orderBy("start")).alias("r"), F.count("*").over(w).alias(f"{t}_n"))

    a, b = ranked(old, "old"), ranked(new, "new")
    same = a.join(b, ["seq_id", "r"], "left")
    # nearest: both on one line, the last new start at or before and the first after
    line = a.select("seq_id", F.col("old_start").alias("at"), F.lit(1).alias("o"), F.lit(None).cast("bigint").alias("n")).unionByName(b.select("seq_id", F.col("new_start").alias("at"), F.lit(0).alias("o"), F.col("new_start").alias("n")))
    w = Window.partitionBy("seq_id").orderBy("at", "o")
    line = line.withColumn("lo", F.last("n", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("hi", F.last("n", ignorenulls=True).over(Window.partitionBy("seq_id").orderBy(F.desc("at"), F.desc("o")).rowsBetween(Window.unboundedPreceding, -1)))
    near = F.when(F.col("lo").isNull(), F.col("hi")).when(F.col("hi").isNull(), F.col("lo")).when(F.col("at") - F.col("lo") <= F.col("hi") - F.col("at"), F.col("lo")).otherwise(F.col("hi"))
    nearest = line.where("o = 1").select("seq_id", F.col("at").alias("old_start"), near.alias("near")).distinct()
    out = same.join(nearest, ["seq_id", "old_start"], "left")
    lifted = F.when(F.col("old_n") == F.col("new_n"), F.col("new_start")).otherwise(F.coalesce("near", "old_start"))
    return out.select("seq_id", "old_start", lifted.alias("new_start"))
