"""Gap and fragment analytics over chunked sequences.

A sequence is a row (seq_id, seq_ord, bases) on reading and is cut at once into fixed-grid chunks; no later step
holds a chromosome in one row. Positions are 0-based, intervals half-open. Keys: `seq_id`, or `sample` and
`seq_id` where a table has both."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.packed import arrow_map, runs, texts

GRID = 4_000
#: Bases of the next chunk that each chunk holds besides its own: enough for words of 32 bases and all telomere units.
HALO = 31


def chunk_sequences(seqs: DataFrame, grid: int = GRID, halo: int = HALO) -> DataFrame:
    """seq_id, chunk_ix, start, bases, more: pieces of `grid` bases and the `halo` bases that follow each, cut in one pass; none for an
    empty sequence. What looks over a chunk's end reads `more`, so chunks are never joined with their neighbours."""
    cut = seqs.select("seq_id", F.posexplode(F.regexp_extract_all("bases", F.lit("(?s)(?=(.{1,%d})).{1,%d}" % (grid + halo, grid)), 1)).alias("chunk_ix", "long"))
    return cut.select("seq_id", "chunk_ix", (F.col("chunk_ix").cast("bigint") * grid).alias("start"), F.substring("long", 1, grid).alias("bases"), F.substring("long", grid + 1, halo).alias("more"))


def partition_by_gap(seqs: DataFrame, gaps: DataFrame) -> DataFrame:
    """seqs with has_gap."""
    found = gaps.select("seq_id").distinct().withColumn("_gap", F.lit(True))
    return seqs.join(found, "seq_id", "left").withColumn("has_gap", F.col("_gap").isNotNull()).drop("_gap")


def islands(df: DataFrame, by: list[str], reach: int = 0) -> DataFrame:
    """Adds `island`: rows of a key, by start, that begin at most `reach` after all before them end."""
    w = Window.partitionBy(*by).orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") > before + reach), 1).otherwise(0)
    return df.withColumn("_open", opens).withColumn("island", F.sum("_open").over(w)).drop("_open")


def find_gaps(chunks: DataFrame, least: int = 1, letter: str = "N", any_case: bool = False) -> DataFrame:
    """seq_id, start, end, length of maximal runs of the letter of at least `least`; runs that touch across chunks are one.

    Runs are placed where the chunk's bases are; only coordinates of those that touch a chunk's edge are moved, to meet their neighbours."""
    letters = {ord(letter), ord(letter.lower()), ord(letter.upper())} if any_case else {ord(letter)}

    def scan(batches):
        for part in batches:
            buf, at = texts(part.column("bases"))
            begin, end = runs(np.isin(buf, list(letters)), at)
            row = np.searchsorted(at, begin, side="right") - 1
            shift = part.column("start").to_numpy()[row] - at[row]
            edge = (begin == at[row]) | (end == at[row + 1])
            keep = edge | (end - begin >= least)
            begin, end, row, shift, edge = (x[keep] for x in (begin, end, row, shift, edge))
            yield pa.RecordBatch.from_arrays([part.column("seq_id").take(pa.array(row)), pa.array(begin + shift), pa.array(end + shift), pa.array(edge)], names=["seq_id", "start", "end", "edge"])

    found = arrow_map(chunks.select("seq_id", "start", "bases"), scan, "seq_id string, start bigint, end bigint, edge boolean")
    return joined_runs(found, ["seq_id"]).select("seq_id", "start", "end", (F.col("end") - F.col("start")).alias("length")).where(F.col("length") >= least)


def joined_runs(found: DataFrame, by: list[str]) -> DataFrame:
    """Runs (by, start, end, edge) of chunks as runs of whole sequences: those at an edge that touch become one, the others stay where they are."""
    at_edge = islands(found.where("edge"), by).groupBy(*by, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return found.where("not edge").select(*by, "start", "end").unionByName(at_edge.select(*by, "start", "end"))


def lengths(seqs: DataFrame) -> DataFrame:
    return seqs.select("seq_id", "seq_ord", F.length("bases").cast("bigint").alias("seq_length"))


def gap_stats_by_chrom(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("seq_id").agg(F.count("*").alias("n_gaps"), F.sum("length").alias("total"), F.max("length").alias("longest"), F.min("length").alias("shortest"), F.avg("length").alias("mean"))


def gap_stats_global(gaps: DataFrame, seqs: DataFrame) -> DataFrame:
    """Totals, coverage in percent, and the largest and smallest gap (ties: first by sequence and start)."""
    first = lambda sign: F.min_by(F.struct("seq_id", "start", "length"), F.struct(sign * F.col("length"), "seq_id", "start"))
    g = gaps.agg(F.count("*").alias("n_gaps"), F.sum("length").alias("total"), F.avg("length").alias("mean"), first(-1).alias("big"), first(1).alias("little"))
    s = seqs.agg(F.sum("seq_length").alias("bases"))
    return g.crossJoin(s).select("n_gaps", "total", "mean", (100 * F.col("total") / F.col("bases")).alias("coverage"), F.col("big.seq_id").alias("largest_seq"), F.col("big.start").alias("largest_start"), F.col("big.length").alias("largest"), F.col("little.seq_id").alias("smallest_seq"), F.col("little.start").alias("smallest_start"), F.col("little.length").alias("smallest"))


#: Upper edges of the length classes (fixed values).
BINS = [(10, "1-10"), (50, "11-50"), (100, "51-100"), (500, "101-500"), (1000, "501-1000"), (5000, "1001-5000"), (10000, "5001-10000")]


def gap_length_histogram(gaps: DataFrame) -> DataFrame:
    """bin, n for each of the eight classes, empty ones too."""
    label = F.lit(">10000")
    for edge, name in reversed(BINS):
        label = F.when(F.col("length") <= edge, name).otherwise(label)
    names = gaps.sparkSession.createDataFrame([(n,) for n in [*(b for _, b in BINS), ">10000"]], "bin string")
    return names.join(gaps.groupBy(label.alias("bin")).agg(F.count("*").alias("n")), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def gap_detail_stats(gaps: DataFrame, seqs: DataFrame) -> DataFrame:
    """Total, mean, extremes, upper median and density per Mb. The median is read off the counts of each length."""
    by = gaps.groupBy("length").agg(F.count("*").alias("n"))
    w = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    at = by.select("length", F.sum("n").over(w).alias("upto")).crossJoin(by.agg(F.sum("n").alias("all_n")))
    median = at.where("upto > all_n div 2").agg(F.min("length").alias("median"))
    g = gaps.agg(F.count("*").alias("n_gaps"), F.sum("length").alias("total"), F.avg("length").alias("mean"), F.max("length").alias("longest"), F.min("length").alias("shortest"))
    return g.crossJoin(median).crossJoin(seqs.agg(F.sum("seq_length").alias("bases"))).select("n_gaps", "total", "mean", "longest", "shortest", "median", (F.col("n_gaps") / F.col("bases") * 1e6).alias("per_mb"))


def gap_midpoints(gaps: DataFrame, least: int = 100, most: int | None = None) -> DataFrame:
    kept = gaps.where(F.col("length") >= least)
    kept = kept if most is None else kept.where(F.col("length") <= most)
    return kept.select("seq_id", "start", "end", "length", F.expr("start + length div 2").alias("mid"))


def top_chroms_by_gap(gaps: DataFrame, k: int = 10) -> DataFrame:
    return gaps.groupBy("seq_id").agg(F.count("*").alias("n_gaps"), F.sum("length").alias("total")).orderBy(F.desc("n_gaps"), "seq_id").limit(k)


def fragments(gaps: DataFrame, seqs: DataFrame, least: int = 1) -> DataFrame:
    """seq_id, start, end, length, piece (from 1, empty ones counted): what lies between gaps; empty pieces dropped by least."""
    w = Window.partitionBy("seq_id").orderBy("start")
    before = gaps.select("seq_id", F.coalesce(F.lag("end").over(w), F.lit(0)).alias("s"), F.col("start").alias("e"), F.row_number().over(w).alias("piece"))
    tail = gaps.groupBy("seq_id").agg(F.max("end").alias("s"), F.count("*").alias("n"))
    tail = seqs.join(tail, "seq_id", "left").select("seq_id", F.coalesce("s", F.lit(0)).alias("s"), F.col("seq_length").alias("e"), (F.coalesce("n", F.lit(0)) + 1).cast("int").alias("piece"))
    return before.unionByName(tail).select("seq_id", F.col("s").cast("bigint").alias("start"), F.col("e").alias("end"), (F.col("e") - F.col("s")).alias("length"), "piece").where(F.col("length") >= least)


def fragment_status(frags: DataFrame, least: int | None = None, large: int = 1_000_000) -> DataFrame:
    status = F.when(F.col("length") >= least, "kept").otherwise("discarded") if least else F.when(F.col("length") < large, "small").otherwise("large")
    return frags.withColumn("status", status)


def fragment_summary(frags: DataFrame) -> DataFrame:
    total = F.sum("length")
    kept = F.sum(F.when(F.col("status") == "kept", F.col("length")).otherwise(0))
    return frags.groupBy("seq_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("status") == "kept", 1)).alias("n_kept"), total.alias("total"), kept.alias("kept"), (100 * kept / total).alias("kept_percent"))


def filtered_segments(frags: DataFrame, joint: int = 100) -> DataFrame:
    """Kept fragments rejoined with `joint` Ns: seq_id, n, kind, start, end, out_start (a segment table)."""
    w = Window.partitionBy("seq_id").orderBy("start")
    kept = frags.where("status = 'kept'").withColumn("n", F.row_number().over(w))
    at = F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return kept.select("seq_id", "n", "start", "end", (F.coalesce(at, F.lit(0)) + joint * (F.col("n") - 1)).alias("out_start"))


def genome_stats(seqs: DataFrame, gaps: DataFrame, unit: int = 10) -> DataFrame:
    """Count, total, max, min, mean length; sequences with a run of `unit` Ns; non-overlapping runs of it."""
    runs = gaps.where(F.col("length") >= unit).agg(F.count_distinct("seq_id").alias("with_gaps"), F.coalesce(F.sum(F.floor(F.col("length") / unit)), F.lit(0)).cast("bigint").alias("n_units"))
    return seqs.agg(F.count("*").alias("n"), F.sum("seq_length").alias("total"), F.max("seq_length").alias("longest"), F.min("seq_length").alias("shortest"), F.avg("seq_length").alias("mean")).crossJoin(runs)


def fill_stat_table(seqs: DataFrame, gaps: DataFrame, least: int = 100) -> DataFrame:
    """Per sequence: length, gap count and 1-based loci in order. Loci of a sequence are collected; bases never are."""
    loci = gaps.where(F.col("length") >= least).groupBy("seq_id").agg(F.count("*").alias("n_gaps"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("at"))
    text = F.array_join(F.transform("at", lambda x: F.concat((x["start"] + 1).cast("string"), F.lit("-"), x["end"].cast("string"))), ",")
    return seqs.join(loci, "seq_id", "left").select("seq_id", "seq_length", F.coalesce("n_gaps", F.lit(0)).alias("n_gaps"), F.coalesce(text, F.lit("")).alias("loci"))


def gap_closure(before: DataFrame, after: DataFrame, least: int = 100) -> DataFrame:
    n = lambda g, c: g.where(F.col("length") >= least).agg(F.count("*").alias(c))
    return n(before, "before").crossJoin(n(after, "after")).select("before", "after", (F.col("before") - F.col("after")).alias("closed"), F.coalesce(100 * (F.col("before") - F.col("after")) / F.nullif("before", F.lit(0)), F.lit(0.0)).alias("rate"))


def fix_improvement(before: DataFrame, after: DataFrame, bases_before: DataFrame, bases_after: DataFrame) -> DataFrame:
    """Gaps, length and coverage before and after; the shares divide by at least 1."""
    s = lambda g, b, t: g.agg(F.count("*").alias(f"gaps_{t}"), F.coalesce(F.sum("length"), F.lit(0)).alias(f"length_{t}")).crossJoin(b.agg(F.sum("seq_length").alias(f"bases_{t}")))
    both = s(before, bases_before, "before").crossJoin(s(after, bases_after, "after"))
    less = lambda c: 100 * (F.col(f"{c}_before") - F.col(f"{c}_after")) / F.greatest(F.col(f"{c}_before"), F.lit(1))
    return both.select("gaps_before", "gaps_after", less("gaps").alias("gaps_percent"), "length_before", "length_after", less("length").alias("length_percent"), (100 * F.col("length_before") / F.col("bases_before")).alias("coverage_before"), (100 * F.col("length_after") / F.col("bases_after")).alias("coverage_after"))


def split_at_gaps(gaps: DataFrame, seqs: DataFrame, least_gap: int = 10, least: int = 1, suffix: str = "_tig") -> DataFrame:
    """Contigs between runs of at least least_gap: name, seq_id, start, end. `_tig` counts pieces, empty ones too; `_p` counts kept ones."""
    cut = fragments(gaps.where(F.col("length") >= least_gap), seqs, max(1, least))
    if suffix == "_p":
        cut = cut.withColumn("piece", F.row_number().over(Window.partitionBy("seq_id").orderBy("start")))
    return cut.select(F.concat("seq_id", F.lit(suffix), F.col("piece").cast("string")).alias("name"), "seq_id", "start", "end", "length")


def normalize_edits(gaps: DataFrame, size: int = 100) -> DataFrame:
    """Edits that make every run of Ns `size` long (for edits.apply_edits)."""
    return gaps.select("seq_id", F.col("start").alias("del_start"), F.col("end").alias("del_end"), F.lit("N").alias("src_kind"), F.lit(None).cast("string").alias("src_id"), F.lit(0).cast("bigint").alias("src_start"), F.lit(size).cast("bigint").alias("src_end"), F.lit("+").alias("strand"), F.lit(0).alias("priority"))


def normalize_chunks(chunks: DataFrame, size: int = 100, grid: int = GRID) -> DataFrame:
    """seq_id, chunk_ix, bases on the grid: the sequences with every run of Ns made `size` long (as normalize_edits, applied).

    Where a chunk's bases come to follows from running sums over a row a chunk, and each chunk is respelled where it is: no run is a
    row. Grid cells that lie in one chunk are done there; of those at its edges the parts are moved."""
    chunks = chunks.select("seq_id", "chunk_ix", "bases")

    def scan(batches):
        for part in batches:
            buf, at = texts(part.column("bases"))
            gap = np.concatenate([buf == ord("N"), [False]])
            begin, _ = runs(gap[:-1], at)
            begun = np.bincount(np.searchsorted(at, begin, side="right") - 1, minlength=part.num_rows)
            plain = np.diff(np.concatenate([[0], np.cumsum(~gap[:-1])])[at])
            head, tail = (gap[i] & (np.diff(at) > 0) for i in (at[:-1], at[1:] - 1))
            yield pa.RecordBatch.from_arrays([part.column("seq_id"), part.column("chunk_ix"), *(pa.array(x) for x in (plain, begun, head, tail))], names=["seq_id", "chunk_ix", "plain", "begun", "head", "tail"])

    seen = arrow_map(chunks, scan, "seq_id string, chunk_ix int, plain bigint, begun bigint, head boolean, tail boolean")
    w = Window.partitionBy("seq_id").orderBy("chunk_ix")
    seen = seen.withColumn("inside", F.col("head") & F.coalesce(F.lag("tail").over(w), F.lit(False)))
    long = F.col("plain") + size * (F.col("begun") - F.col("inside").cast("bigint"))
    places = seen.withColumn("long", long).select("seq_id", "chunk_ix", "inside", (F.sum("long").over(w) - F.col("long")).alias("out_start"))

    def spell(batches):
        for part in batches:
            buf, at = texts(part.column("bases"))
            gap = buf == ord("N")
            begin, _ = runs(gap, at)
            times = (~gap).astype(np.int64)
            times[begin] = size
            row = np.searchsorted(at, begin, side="right") - 1
            times[begin[part.column("inside").to_numpy(zero_copy_only=False)[row] & (begin == at[row])]] = 0
            line, ends = np.repeat(buf, times), np.concatenate([[0], np.cumsum(times)])[at]
            first = part.column("out_start").to_numpy()
            # parts begin where a chunk's bases or a cell of the grid do
            many = np.where(np.diff(ends) > 0, (first + np.diff(ends) - 1) // grid - first // grid + 1, 0)
            row = np.repeat(np.arange(part.num_rows), many)
            cell = first[row] // grid + np.arange(len(row)) - (np.cumsum(many) - many)[row]
            place = np.maximum(cell * grid, first[row])
            cut = np.append(ends[:-1][row] + place - first[row], len(line))
            bases = pa.LargeStringArray.from_buffers(len(row), pa.py_buffer(cut), pa.py_buffer(line)).cast(pa.string())
            out = pa.RecordBatch.from_arrays([part.column("seq_id").take(pa.array(row)), pa.array(cell.astype(np.int32)), pa.array(place), bases], names=["seq_id", "chunk_ix", "at", "bases"])
            for k in range(0, len(row), 1_000):
                yield out.slice(k, 1_000)

    parts = arrow_map(chunks.join(places, ["seq_id", "chunk_ix"]), spell, "seq_id string, chunk_ix int, at bigint, bases string")
    whole = F.length("bases") == grid
    edges = parts.where(~whole).groupBy("seq_id", "chunk_ix").agg(F.sort_array(F.collect_list(F.struct("at", "bases"))).alias("p"))
    edges = edges.select("seq_id", "chunk_ix", F.array_join(F.transform("p", lambda x: x["bases"]), "").alias("bases"))
    return parts.where(whole).select("seq_id", "chunk_ix", "bases").unionByName(edges)


def structure_track(seqs: DataFrame, features: DataFrame, bins: int = 50) -> DataFrame:
    """A letter for each of `bins` equal parts: '-' sequence, 'N' gap, 'i' internal telomere (by its midpoint), 't' end telomere.
    features: seq_id, kind, start, end. The strongest kind in a bin stands."""
    rank = F.when(F.col("kind") == "gap", 1).when(F.col("kind") == "internal", 2).when(F.col("kind") == "telomere", 3)
    f = features.join(seqs, "seq_id").where("seq_length > 0")
    mid = F.expr("(start + end) div 2")
    lo = F.when(F.col("kind") == "internal", mid).otherwise(F.col("start"))
    hi = F.when(F.col("kind") == "internal", mid).otherwise(F.col("end") - 1)
    at = lambda p: F.least(F.lit(bins - 1), F.floor(p * bins / F.col("seq_length")).cast("int"))
    marks = f.select("seq_id", rank.alias("r"), F.explode(F.sequence(at(lo), F.greatest(at(lo), at(hi)))).alias("b")).groupBy("seq_id", "b").agg(F.max("r").alias("r"))
    rows = marks.groupBy("seq_id").agg(F.map_from_entries(F.collect_list(F.struct("b", "r"))).alias("m"))
    letter = lambda b: F.substring(F.lit("-Nit"), F.coalesce(F.element_at("m", b), F.lit(0)) + 1, F.lit(1))
    return seqs.join(rows, "seq_id", "left").select("seq_id", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), letter), "").alias("track"))
