"""Gaps, edits and telomeres on small frames, against plain Python and across chunk grids."""

import random
import re
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gapwright.functions.packed import sliced
from gapwright.operators import edits as E
from gapwright.operators import gaps as D
from gapwright.operators import telomere as T
from gapwright.plans.registry import QUERIES

SEQS = [("a", 0, "NNACGTNNNAC"), ("b", 1, "NNNN"), ("c", 2, "ACGT"), ("d", 3, ""), ("e", 4, "A" * 79 + "N" * 10 + "C" * 30 + "N"), ("f", 5, "acnnNg")]


def frame(spark, rows=SEQS):
    return spark.createDataFrame(rows, "seq_id string, seq_ord long, bases string")


def expected(rows, least, flags=0):
    return sorted((i, m.start(), m.end(), m.end() - m.start()) for i, _, b in rows for m in re.finditer("N+", b, flags) if m.end() - m.start() >= least)


@pytest.mark.parametrize("grid", [2, 7, 80, 4000])
@pytest.mark.parametrize("least", [1, 3])
def test_runs_do_not_depend_on_the_grid(spark, grid, least):
    got = D.find_gaps(D.chunk_sequences(frame(spark), grid), least).collect()
    assert sorted(map(tuple, got)) == expected(SEQS, least)


def test_either_case(spark):
    got = D.find_gaps(D.chunk_sequences(frame(spark)), 1, any_case=True).collect()
    assert sorted(map(tuple, got)) == expected(SEQS, 1, re.I)


def test_fragments_tile_the_rest(spark):
    q = frame(spark)
    lens = D.lengths(q)
    gaps = D.find_gaps(D.chunk_sequences(q), 1)
    got = sorted((r.seq_id, r.start, r.end) for r in D.fragments(gaps, lens).collect())
    want = sorted((i, m.start(), m.end()) for i, _, b in SEQS for m in re.finditer("[^N]+", b))
    assert got == want


@pytest.mark.parametrize("grid", [5, 16, 80])
def test_edits_against_slicing(spark, grid):
    rng = random.Random(grid)
    rows, edits, want = [], [], {}
    for k in range(6):
        bases = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 200)))
        src = "".join(rng.choice("ACGT") for _ in range(60))
        rows += [(f"s{k}", k, bases), (f"x{k}", 100 + k, src)]
        at, out = 0, ""
        for _ in range(4):
            a = rng.randrange(at, len(bases) + 1)
            b = rng.randrange(a, min(len(bases), a + 20) + 1)
            if edits and edits[-1][0] == f"s{k}" and edits[-1][2] >= a:
                continue
            s = rng.randrange(0, 50)
            e = rng.randrange(s, 60)
            kind, strand = rng.choice([("x", "+"), ("x", "-"), ("N", "+")])
            new = "N" * (e - s) if kind == "N" else src[s:e]
            if strand == "-":
                new = new[::-1].translate(str.maketrans("ACGT", "TGCA"))
            edits.append((f"s{k}", a, b, kind, f"x{k}", s, e, strand, 0))
            out += bases[at:a] + new
            at = b
        want[f"s{k}"] = out + bases[at:]
    q = frame(spark, rows)
    own = q.where("seq_id like 's%'")
    ed = spark.createDataFrame(edits, "seq_id string, del_start long, del_end long, src_kind string, src_id string, src_start long, src_end long, strand string, priority int")
    segs = E.apply_edits(ed, D.lengths(own))
    kinds = "case when seq_id like 's%' then 'seq' else 'x' end as kind"
    chunks = D.chunk_sequences(q, grid).selectExpr("*", kinds)
    got = {}
    for r in sorted(E.materialize(segs, chunks, grid).collect(), key=lambda r: (r.seq_id, r.chunk_ix)):
        assert len(r.bases) <= grid
        got[r.seq_id] = got.get(r.seq_id, "") + r.bases
    assert got == {k: v for k, v in want.items() if v}


def test_overlapping_edits_keep_the_best(spark):
    cols = "seq_id string, del_start long, del_end long, src_kind string, src_id string, src_start long, src_end long, strand string, priority int"
    ed = spark.createDataFrame([("a", 0, 5, "N", "", 0, 1, "+", 1), ("a", 3, 8, "N", "", 0, 1, "+", 0), ("a", 8, 9, "N", "", 0, 1, "+", 2)], cols)
    assert sorted((r.del_start, r.del_end) for r in E.resolve(ed).collect()) == [(3, 8), (8, 9)]


@pytest.mark.parametrize("grid", [10, 50, 4000])
def test_arrays_over_chunk_edges(spark, grid):
    bases = "TTTAGGG" * 6 + "ACGT" + "CCCTAAA" * 3 + "TT" + "TTAGGG" * 4
    q = frame(spark, [("t", 0, bases)])
    got = sorted((r.pattern, r.start, r.end, r.repeats) for r in T.telomere_arrays(D.chunk_sequences(q, grid), 3, 10).collect())
    want = sorted((u, m.start(), m.end(), (m.end() - m.start()) // len(u)) for u in T.UNITS for m in re.finditer(f"(?:{u}){{3,}}", bases))
    assert got == want


def test_slice_is_clipped(spark):
    q = frame(spark)
    r = spark.createDataFrame([("k", "c", -5, 2), ("m", "a", 3, 99)], "key string, seq_id string, start long, end long")
    assert dict(map(tuple, E.slice_bases(r, D.chunk_sequences(q, 3), 3).collect())) == {"k": "AC", "m": "ACGTNNNAC"}


def test_ends_are_counted_once(spark):
    """Filters on the counts don't make the sequences anew for each unit and use."""
    seqs = spark.range(40).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("seq_id"), F.concat(F.expr("repeat('TTTAGGG', cast(id % 9 as int))"), F.upper(F.md5(F.col("id").cast("string")))).alias("bases"))
    ends = T.chromosome_ends(T.telomere_status(T.end_repeat_counts(seqs)), 30)
    # one for each of the two branches and fields that reads the sequence
    assert ends._jdf.queryExecution().optimizedPlan().toString().count("repeat(") <= 6
    assert sum(r.end_id.endswith("5prime") for r in ends.collect()) == sum(i % 9 < 5 for i in range(40))


def test_batches_are_cut_by_bytes():
    batch = pa.RecordBatch.from_pydict({"bases": ["A" * 1_000] * 50, "n": list(range(50))})
    parts = list(sliced([batch, batch.slice(0, 0)], 10_000))
    assert max(p.nbytes for p in parts) <= 12_000 and sum((p.column("n").to_pylist() for p in parts), []) == list(range(50))


@pytest.mark.parametrize("grid", [7, 16, 4_000])
def test_normal_gaps_against_the_regex(spark, grid):
    """Runs that go over several chunks, shrink to less than a cell or grow over many; and no shuffle of a row a run."""
    rng = random.Random(4)
    rows = [(f"s{k}", k, x) for k, x in enumerate(("", "N", "N" * 90, "ACG", "ANA" * 30, "N" * 33 + "ACGT" * 9 + "N" * 5, "".join(rng.choice("ACGTNNNN" if i // 40 % 2 else "ACGT") for i in range(900))))]
    chunks = D.chunk_sequences(frame(spark, rows), grid)
    for size in (1, 3, 50):
        got = {}
        for r in sorted(D.normalize_chunks(chunks, size, grid).collect(), key=lambda r: (r.seq_id, r.chunk_ix)):
            assert r.chunk_ix * grid == len(got.get(r.seq_id, "")) and 0 < len(r.bases) <= grid
            got[r.seq_id] = got.get(r.seq_id, "") + r.bases
        assert got == {i: t for i, _, x in rows if (t := re.sub("N+", "N" * size, x))}


def test_normal_gaps_move_chunks_not_runs(spark):
    """D19 moves a row a chunk at most twice, however many runs of Ns there are."""
    spark.sql("SELECT 0L AS doc_id, repeat('ab ', 100000) AS text").write.mode("overwrite").parquet(path := f"{tempfile.mkdtemp()}/documents.parquet")
    df = QUERIES["D19_normalize_gaps"](spark, path.removesuffix("/documents.parquet"))
    assert df.selectExpr("sum(length(bases))").first()[0] == 100_000 * 102
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "explode(sequence(" not in plan and "posexplode(" in plan
