"""The composed repairs and the file readers on small inputs, against plain Python."""

import math
import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from gapwright.operators import edits as E
from gapwright.operators import gaps as D
from gapwright.operators import kmer as K
from gapwright.operators import lift as M
from gapwright.operators import telomere as T
from gapwright.plans import pipelines as N
from gapwright.plans.queries_repair import STAGE1
from gapwright.sources import formats, sinks

ALN = "aln_id long, ref_contig string, query_contig string, identity double, ref_start long, ref_end long, query_start long, query_end long"
EDIT = "seq_id string, del_start long, del_end long, src_kind string, src_id string, src_start long, src_end long, strand string, priority int"
PAF = "hit_id long, qryid string, qrylen long, qrystart long, qryend long, strand string, refid string, reflen long, refstart long, refend long, matches long, alnlen long, mapq int"


def greedy(rows):
    kept = []
    for r in sorted(set(rows), key=lambda r: (r[2], -r[0], -r[1])):
        if all(r[1] <= k[0] or k[1] <= r[0] for k in kept):
            kept.append(r)
    return sorted(kept)


def test_chains_of_overlaps_keep_what_fits(spark):
    rng = random.Random(8)
    cases = [[(0, 5, 0), (3, 8, 9), (7, 12, 1)]] + [[(a, a + rng.randrange(1, 12), rng.randrange(4)) for a in (rng.randrange(60) for _ in range(25))] for _ in range(6)]
    rows = [(f"s{k}", a, b, "N", "", 0, 1, "+", p) for k, case in enumerate(cases) for a, b, p in case]
    got = {}
    for r in E.resolve(spark.createDataFrame(rows, EDIT)).collect():
        got.setdefault(r.seq_id, []).append((r.del_start, r.del_end, r.priority))
    assert {k: sorted(v) for k, v in got.items()} == {f"s{k}": greedy(case) for k, case in enumerate(cases)}
    assert len(got["s0"]) == 2


def test_a_long_chain_takes_few_rounds(spark):
    """Each edit overlaps the next: every second one stays, from the right; ids of one place, empty edits and several priorities beside."""
    stairs = [("a", 5 * k, 5 * k + 7, "N", "", 0, 1, "+", 1) for k in range(400)]
    rng = random.Random(4)
    rows = [("b", a, a + rng.choice([0, 0, 3, 9]), "N", str(rng.randrange(3)), 0, 1, "+", p) for a, p in ((rng.randrange(80), rng.randrange(3)) for _ in range(160))]
    got = {}
    for r in E.resolve(spark.createDataFrame(stairs + rows, EDIT)).collect():
        got.setdefault(r.seq_id, []).append((r.del_start, r.del_end, r.priority, r.src_id))
    assert sorted(x[0] for x in got["a"]) == [5 * k for k in range(1, 400, 2)]
    kept = []
    for r in sorted({x[:3] for x in got["b"]}):
        assert all(r[1] <= k[0] or k[1] <= r[0] or r == k for k in kept), (r, kept)
        kept.append(r)
    walked = []
    for r in sorted(set(rows), key=lambda r: (r[8], -r[1], -r[2])):
        starts = sorted(walked)
        after, prior = [x for x in starts if x[0] >= r[1]], [x for x in starts if x[0] < r[1]]
        if (not after or r[2] <= after[0][0]) and (not prior or max(x[1] for x in prior) <= r[1]):
            walked.append((r[1], r[2], r[8], r[4]))
    assert sorted({x[:3] for x in walked}) == sorted({x[:3] for x in got["b"]}) and len(walked) == len(got["b"])


def test_cutting_takes_time_in_proportion(spark):
    took = []
    for size in (1 << 21, 1 << 23):
        q = spark.range(1).selectExpr("'a' AS seq_id", f"repeat('ACGTN', {size // 5}) AS bases")
        D.chunk_sequences(q).count()
        began = time.time()
        D.chunk_sequences(q).write.format("noop").mode("overwrite").save()
        took.append(time.time() - began)
    assert took[1] < 12 * took[0] + 1


def test_kmers_over_chunk_edges(spark):
    rng = random.Random(1)
    bases = "".join(rng.choice("ACGT") for _ in range(9_000))
    bases = bases[:5000] + "N" + bases[5000:]
    got = {r.pos: r.w for r in K.kmers(spark.createDataFrame([("a", bases)], "seq_id string, bases string"), 21, both=False).select("pos", K.spelt(F.col("kmer"), 21).alias("w")).collect()}
    assert got == {i: bases[i : i + 21] for i in range(len(bases) - 20) if "N" not in bases[i : i + 21]}


@pytest.mark.parametrize(("k", "m", "both"), [(21, None, True), (11, None, True), (5, 2, False), (31, 9, True), (4, 4, True)])
def test_counts_by_minimizer(spark, k, m, both):
    """Repeats, copies on both strands, other letters, sequences shorter than a word, and words over chunk edges."""
    rng = random.Random(k)
    turn = lambda t: t.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    one = "".join(rng.choice("ACGT") for _ in range(5_000))
    rows = [("a", one), ("b", turn(one)), ("c", "A" * 4_100 + "N" + "TTAGGG" * 200), ("d", one[:17] + "NNxN" + one[30:8_000]), ("e", "ACG"), ("f", ""), ("g", one), ("h", "N" * 50)]
    want = {}
    for _, t in rows:
        for i in range(len(t) - k + 1):
            w = t[i : i + k]
            if set(w) <= set("ACGT"):
                w = min(w, turn(w)) if both else w
                want[w] = want.get(w, 0) + 1
    counts = K.kmer_counts(K.super_kmers(spark.createDataFrame(rows, "seq_id string, bases string").repartition(3), k, m, both), k, both)
    got = counts.select(K.spelt(F.col("kmer"), k).alias("w"), "times").collect()
    assert {r.w: r.times for r in got} == want and len(got) == len(want)


def shuffled(df):
    """The columns that each exchange of a plan carries."""
    plan, found = df._jdf.queryExecution().executedPlan(), []
    todo = [plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan]
    while todo:
        node = todo.pop()
        if "Exchange" in node.nodeName():
            found.append([node.output().apply(i).name() for i in range(node.output().size())])
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_no_bases_are_shuffled(spark):
    """Gaps, telomere arrays and words are found where the chunks are; only coordinates and packed stretches meet."""
    q = spark.createDataFrame([("a", "ACGTN" * 3_000)], "seq_id string, bases string")
    chunks = D.chunk_sequences(q)
    plain = {"seq_id", "start", "end", "edge", "island", "pattern", "part", "stretch", "n", "times"}
    for df, least in ((D.find_gaps(chunks), 1), (T.telomere_arrays(chunks), 1), (K.kmer_histogram(K.kmer_counts(K.super_kmers(q))), 2), (K.kmers(q), 0)):
        moved = shuffled(df)
        assert len(moved) >= least and all({c.split("#")[0] for c in x} <= plain | {"min", "max", "count", "sum"} for x in moved), moved
    assert not shuffled(K.kmers(q))


def test_stretches_are_less_than_half_of_the_words(spark):
    rng = random.Random(3)
    q = spark.createDataFrame([(f"s{k}", "".join(rng.choice("ACGT") for _ in range(20_000))) for k in range(5)], "seq_id string, bases string")
    size = K.super_kmers(q).selectExpr("sum(length(stretch) + 16) AS n").first().n
    assert size < 8 * K.kmers(q).count() / 1.5 and size < 21 * K.kmers(q).count() / 4


@pytest.mark.parametrize("block", ["64m", "40"])
def test_fasta_by_lines(spark, tmp_path, block):
    """Records over block edges, several files, and lines of odd widths give the same chunks as whole records."""
    rng = random.Random(2)
    for f in range(3):
        lines = []
        for k in range(4):
            lines.append(f">f{f}r{k} number {k}")
            lines += ["".join(rng.choice("acgtN") for _ in range(rng.choice([7, 30, 3]))) for _ in range(rng.randrange(6))]
        (tmp_path / f"{f}.fa").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got, more = {}, {}
        for r in sorted(formats.read_fasta_chunks(spark, str(tmp_path), 10).collect(), key=lambda r: (r.seq_id, r.chunk_ix)):
            assert r.start == 10 * r.chunk_ix == len(got.get(r.seq_id, ("", ""))[1])
            got[r.seq_id] = (r.description, got.get(r.seq_id, ("", ""))[1] + r.bases)
            more[r.seq_id, r.start + len(r.bases)] = r.more
        want = {r.seq_id: (r.description, r.bases) for r in formats.read_fasta(spark, str(tmp_path), "*.fa").collect() if r.bases}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want and len(want) >= 6
    assert all(t == want[name][1][at : at + D.HALO] for (name, at), t in more.items())


def test_no_file_begins_within_a_record(spark, tmp_path):
    """Sequences of many chunks and of one seq_ord, written by several tasks: each file holds whole records."""
    seqs = spark.createDataFrame([(n, i // 2, ("ACGT"[i] * 79 + "T") * 300) for i, n in enumerate("abcd")], "seq_id string, seq_ord long, bases string")
    chunks = D.chunk_sequences(seqs.select("seq_id", "bases")).join(seqs.select("seq_id", "seq_ord"), "seq_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_fasta(chunks, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [p.read_text() for p in (tmp_path / "out").glob("part-*") if p.stat().st_size]
    assert len(files) > 1 and all(f.startswith(">") for f in files)
    got = {r.seq_id: r.bases for r in formats.read_fasta(spark, str(tmp_path / "out")).collect()}
    assert got == {r.seq_id: r.bases for r in seqs.collect()}


def test_folders_of_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "my_contigs.fa").write_text(">a\n" + "ACGT" * 400)
    (tmp_path / "assembly.fasta").write_text(">b\nAC")
    (tmp_path / "other.fa").write_text(">c\n" + "ACGT" * 400)
    assert [r.path.rsplit("/", 1)[1] for r in formats.discover_contigs(spark, str(tmp_path)).collect()] == ["my_contigs.fa"]
    for name, size in (("assemblies.fasta", 400), ("flye.fa", 400), ("my_flye.fa", 400), ("Contigs.fa", 400), ("contig.fa.gz", 400), ("verkko.fa", 10)):
        (tmp_path / "sub" / name).write_text(">a\n" + "ACGT" * size)
    assert {r.path.rsplit("/", 1)[1] for r in formats.discover_contigs(spark, str(tmp_path)).collect()} == {"my_contigs.fa", "assemblies.fasta", "flye.fa"}
    for path in (tmp_path / "sub").glob("*"):
        if path.name != "my_contigs.fa":
            path.unlink()
    (tmp_path / "bad.fa").write_text(">empty\n>x\nAC\n")
    got = {r["sample"]: (r.n_sequences, r.n_bases, r.ok) for r in formats.fasta_dir_summary(spark, str(tmp_path), "*.fa", recursive=True).collect()}
    assert got == {"my_contigs.fa": (1, 1600, True), "other.fa": (1, 1600, True), "bad.fa": (2, 2, False)}
    report = str(tmp_path / "report")
    sinks.write_report(sinks.gap_report(spark.createDataFrame([("a", 5, 7, 2), ("a", 1, 2, 1)], "seq_id string, start long, end long, length long")), report)
    back = spark.read.json(report).first()
    assert back.summary.total == 3 and [g.start for g in back.gaps] == [1, 5]


def test_a_file_for_each_group(spark, tmp_path):
    """Records in order, whole and in one file a group; names with a comma or quote, an empty record, chunks of one record."""
    seqs = spark.createDataFrame([("b,1", 1, "x", "ACGT" * 2_500), ('a"2', 0, "x", "A" * 160), ("c", 2, "y", "AC"), ("d", 3, "y", "")], "seq_id string, seq_ord long, lab string, bases string")
    chunks = D.chunk_sequences(seqs.select("seq_id", "bases")).join(seqs.select("seq_id", "seq_ord", "lab"), "seq_id")
    sinks.write_fasta_files(chunks, str(tmp_path / "out"), "lab", "contig.fasta")
    files = {p.parent.name: p.read_text() for p in (tmp_path / "out").glob("*/contig-*.fasta")}
    bases = ("ACGT" * 20 + "\n") * 125
    assert files == {"lab=x": '>a"2\n' + ("A" * 80 + "\n") * 2 + ">b,1\n" + bases, "lab=y": ">c\nAC\n"}


def test_gaps_far_from_alignments_fall_back_on_synteny(spark):
    rows = [(1, "r", "q", 99.0, 1, 10_000, 1, 10_000), (2, "r", "q", 99.0, 20_000, 30_000, 1_500_000, 1_510_000), (3, "other", "q", 99.0, 1, 9_000, 5, 9_005)]
    gaps = spark.createDataFrame([(7, "q", 750_000), (8, "none", 5)], "gap_key long, query_contig string, gap_pos long")
    lens = spark.createDataFrame([("q", 2_000_000), ("none", 10)], "seq_id string, seq_length long")
    out = N.correct_gaps(spark.createDataFrame(rows, ALN), gaps, lens, mode="aggressive")
    got = [(r.gap_key, r.error_type, r.confidence, r.replace_start, r.replace_end, r.large_distance, r.conservative) for r in out["decided"].collect()]
    assert got == [(7, "type1", "low", 10_001, 1_499_999, True, False)]
    assert out["edits"].count() == 0 and out["improvement"].first().gaps_after == 2


def _patch_inputs(spark):
    aln = spark.createDataFrame([(1, "r", "q", 99.0, 1_000, 40_000, 1_000, 40_000), (2, "r", "q", 99.0, 60_000, 99_000, 45_000, 84_000)], ALN)
    gaps = spark.createDataFrame([(1, "q", 42_000, "q.1"), (2, "q", 200, "q.2")], "gap_key long, query_contig string, gap_pos long, gap_id string")
    refs = spark.createDataFrame([("r", 100_000)], "ref_contig string, ref_length long")
    hits = spark.createDataFrame([(1, "q.1.L", 10_000, 0, 10_000, "+", "q", 90_000, 30_000, 40_000, 9_900, 10_000, 60), (2, "q.1.R", 10_000, 0, 10_000, "+", "q", 90_000, 45_000, 55_000, 9_900, 10_000, 60)], PAF)
    lens = spark.createDataFrame([("q", 0, 90_000), ("w", 1, 50)], "seq_id string, seq_ord long, seq_length long")
    return aln, gaps, refs, hits, lens


def test_patching_to_the_end(spark):
    aln, gaps, refs, hits, lens = _patch_inputs(spark)
    out = N.patch_gaps(aln, gaps, refs, hits, lens)
    e = out["edits"].collect()
    # the patch is r:30001..69999 with flanks of 10,000; between the flanks' matches lie its bases 10,000 to 29,999
    assert [(r.seq_id, r.del_start, r.del_end, r.src_id, r.src_start, r.src_end, r.strand) for r in e] == [("q", 40_000, 45_000, "r", 40_000, 59_999, "+")]
    assert {r.seq_id: (r.seq_length, r.origin) for r in out["genome"].collect()} == {"q": (90_000 - 5_000 + 19_999, "repaired"), "w": (50, "original")}
    segs = sorted((r.seq_id, r.n, r.kind, r.out_start) for r in out["segments"].collect())
    assert segs == [("q", 1, "seq", 0), ("q", 2, "contig", 40_000), ("q", 3, "seq", 59_999), ("w", 1, "seq", 0)]


def test_patch_then_correct_and_refill(spark):
    aln, gaps, refs, hits, lens = _patch_inputs(spark)
    five = N.patch_then_correct(aln, gaps, refs, hits, lens)
    assert [(r.seq_id, r.n_gaps, r.n_extracted, r.n_applied, r.strategy) for r in five["strategy"].collect()] == [("q", 2, 1, 1, "partial_success_no_fixer")]
    assert five["again"].count() == 0
    # no match of the flanks: the patch isn't applied, so the sequence is corrected and its patches offered again
    none = N.patch_then_correct(aln, gaps, refs, hits.limit(0), lens)
    assert [r.strategy for r in none["strategy"].collect()] == ["full_fixer_reuse_patches"]
    refill = N.correct_then_refill(aln, gaps, lens, hits)
    assert refill["fill"]["detail"].count() == refill["correct"]["merged"].count()


def test_filling_twice(spark):
    bases = "A" * 3_000 + "N" * 100 + "C" * 50 + "N" * 100 + "G" * 3_000
    q = spark.createDataFrame([("a", 0, bases)], "seq_id string, seq_ord long, bases string")
    hit = lambda i, g, side, at: (i, f"a.{g}.{side}", 1_500, 0, 1_500, "+", "ctg", 90_000, at, at + 1_500, 1_450, 1_500, 60)
    hits = spark.createDataFrame([hit(1, 2, "L", 1_000), hit(2, 2, "R", 3_000)], PAF)
    hits2 = spark.createDataFrame([hit(3, 1, "L", 10_000), hit(4, 1, "R", 12_000)], PAF)
    gaps = D.find_gaps(D.chunk_sequences(q), 10)
    one = N.fill_gaps(D.lengths(q), gaps, hits)
    assert [(r.del_start, r.del_end, r.src_start, r.src_end) for r in one["edits"].collect()] == [(3_150, 3_250, 2_500, 3_000)]
    rounds = {r["round"]: (r.gaps_before, r.gaps_after) for r in N.two_round_fill(D.lengths(q), gaps, hits, hits2, 100, 10).collect()}
    assert rounds == {1: (2, 1), 2: (1, 0)}


def _ends(spark, aln, refs):
    arrays = spark.createDataFrame([("r", "CCCTAAA", 100, 800), ("r", "TTTAGGG", 99_100, 99_900)], "seq_id string, pattern string, start long, end long")
    return N.extract_repairs(aln, refs.selectExpr("ref_contig AS seq_id", "ref_length AS seq_length"), arrays)


def test_recovering_telomeres(spark):
    aln, _, refs, _, _ = _patch_inputs(spark)
    repairs = _ends(spark, aln, refs)
    got = {r.repair_end: (r.label, r.start, r.end, r.turned, r.n_arrays) for r in repairs.collect()}
    assert got == {"5prime": ("r_q_1_40000", 1, 40_000, False, 1), "3prime": ("r_q_60000_100000", 60_000, 100_000, False, 1)}
    status = T.telomere_status(spark.createDataFrame([("q", 90_000, 0, 9), ("w", 50, 9, 9)], "seq_id string, seq_length long, left_repeats long, right_repeats long"))
    ends = spark.createDataFrame([(1, "r_q_1_40000", 40_000, 1_000, 39_000, "+", "q", 90_000, 900, 38_900, 37_900, 38_000, 60, "5prime")], PAF + ", repair_end string")
    out = N.recover_telomeres(repairs, ends, status)
    assert [(r.seq_id, r.del_start, r.del_end, r.src_id, r.src_start, r.src_end) for r in out["edits"].collect()] == [("q", 0, 38_900, "r", 0, 39_000)]


@pytest.mark.parametrize("strategy", T.STRATEGIES)
def test_choosing_repairs_against_the_loop(spark, strategy):
    """Groups in the order of their first repair, repairs from the longest on; ties, unknown chromosomes, groups without a success."""
    rng = random.Random(5)
    genome = ["chr101", "chr102", "chr103", "chr104"]
    rows = []
    for i in range(60):
        target = rng.choice(["chr101", "CHR101", "chr102", "CHR102", "chr103", "Chr104", "chr999"])
        bad = target == "chr103" or target == "chr102" or rng.random() < 0.4
        rows.append((f"r{i}", target, i, rng.choice([100, 200, 300]), rng.choice([-500, 0, 500, 90_000]), rng.choice([0.5, 0.9]), rng.choice([0.7, 1.0]), rng.choice([20, 60]), "low_mapq" if bad else None))

    groups, done, want, picks = {}, set(), {}, {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    for target, own in groups.items():
        own.sort(key=lambda r: (-r[3], r[2]))
        name = next((g for g in genome if g == target.lower()), None)
        good = [r for r in own if r[8] is None]
        norm = lambda r: max(0, 1 - min(1, abs(r[4]) / 100_000))
        score = {"first_success": lambda r: 1.0, "minimal_extension": lambda r: round(0.6 * norm(r) + 0.3 * r[5] + 0.1 * r[6], 9), "balanced": lambda r: round(0.4 * norm(r) + 0.3 * r[5] + 0.2 * r[6] + 0.1 * min(1, r[7] / 60), 9)}[strategy]
        order = sorted(good, key=lambda r: -score(r))
        if order:
            first = strategy == "first_success"
            picks[target] = (order[0][0], 1 if first else len(order), not first and len(order) > 1 and round(score(order[0]) - score(order[1]), 9) < 0.1, "" if first else ",".join(r[0] for r in order[1:]))
        for r in own:
            if name is None:
                want[r[0]] = ("skipped", "chromosome_not_found")
            elif name in done:
                want[r[0]] = ("skipped", "chromosome_already_repaired")
            elif not good:
                want[r[0]] = ("failed", "repair_attempt_failed")
            else:
                want[r[0]] = ("success", "") if r is order[0] else ("skipped", "not_used_alternative")
        if name and good:
            done.add(name)

    plans = spark.createDataFrame(rows, "qryid string, target string, ord long, length long, extension long, quality double, identity double, mapq int, reason string")
    chosen = T.select_repair(plans.where("reason is null").withColumn("shorter", -F.col("length")), strategy, ("shorter", "ord"))
    assert {r.target: (r.qryid, r.n_successful, r.is_close, r.alternatives) for r in chosen.collect()} == picks
    found = T.repair_targets(plans, spark.createDataFrame([(g, k) for k, g in enumerate(genome)], "name string, seq_ord int"))
    made = T.first_repairs(chosen, found)
    got = T.outcomes(plans, made, found).collect()
    assert {r.qryid: (r.outcome, r.why) for r in got} == want and len(got) == len(rows)
    assert {r.qryid: r.detail for r in got} == {r[0]: r[8] for r in rows}
    assert {w for _, w in want.values()} == {"", "chromosome_not_found", "chromosome_already_repaired", "repair_attempt_failed", "not_used_alternative"}
    with pytest.raises(ValueError):
        T.select_repair(plans, "best")


def _random_bases(seed, n):
    return "".join(random.Random(seed).choices("ACGT", k=n))


def test_repairing_a_genome(spark):
    """All rounds, every input in original coordinates; the bases are those that splicing the original strings gives."""
    q, u, v, w = _random_bases(1, 90_000), _random_bases(2, 10_400), _random_bases(3, 30_000), _random_bases(4, 50)
    put = lambda t, *at: t if not at else put(t[: at[0]] + "N" * 100 + t[at[0] + 100 :], *at[1:])
    genome = {"q": put(q, 5_000, 42_000), "u": put(u, 5_000, 5_300), "v": put(v, 15_000), "w": w}
    contigs = {"r": _random_bases(5, 100_000), "ctg": _random_bases(6, 90_000)}
    aln, _, refs, _, _ = _patch_inputs(spark)
    aln = aln.unionByName(spark.createDataFrame([(3, "r2", "v", 99.0, 1, 6_001, 12_000, 18_000)], ALN))
    gaps = spark.createDataFrame([(1, "q", 5_000, "q.g1"), (2, "q", 42_000, "q.g2"), (3, "u", 5_000, "u.a"), (4, "u", 5_300, "u.b"), (5, "v", 15_000, "v.a")], "gap_key long, query_contig string, gap_pos long, gap_id string")
    matches = spark.createDataFrame([(1, "q.g2.L", 10_000, 0, 10_000, "+", "q", 90_000, 30_000, 40_000, 9_900, 10_000, 60), (2, "q.g2.R", 10_000, 0, 10_000, "+", "q", 90_000, 45_000, 55_000, 9_900, 10_000, 60)], PAF)
    hit = lambda i, g, side, at, strand="+": (i, f"{g}.{side}", 1_500, 0, 1_500, strand, "ctg", 90_000, at, at + 1_500, 1_450, 1_500, 60)
    fills = spark.createDataFrame([hit(1, "q.1", "L", 1_000), hit(2, "q.1", "R", 3_000)], PAF)
    again = spark.createDataFrame([hit(3, "u.1", "L", 10_000), hit(4, "u.1", "R", 12_000)], PAF)
    refill = spark.createDataFrame([hit(5, "v.1", "R", 20_000, "-"), hit(6, "v.1", "L", 22_000, "-")], PAF)
    lens = spark.createDataFrame([(k, i, len(t)) for i, (k, t) in enumerate(genome.items())], "seq_id string, seq_ord long, seq_length long")
    status = T.telomere_status(spark.createDataFrame([("q", 90_000, 9, 0), ("u", 10_400, 9, 9), ("v", 30_000, 9, 9), ("w", 50, 9, 9)], "seq_id string, seq_length long, left_repeats long, right_repeats long"))
    repairs = _ends(spark, aln.where("query_contig = 'q'"), refs)
    ends = spark.createDataFrame([(1, "r_q_60000_100000", 40_001, 20_000, 39_000, "+", "q", 90_000, 70_000, 89_000, 18_900, 19_000, 60, "3prime")], PAF + ", repair_end string")
    one = N.recover_telomeres(repairs, ends, status)["edits"].first()
    run = lambda *stages: N.repair_genome(lens, gaps, aln, refs, matches, fills, repairs, ends, status, again, refill, stages, least_fragment=1_000)
    out = run("fill", "patch", "correct", "telomere")
    cut = contigs["r"][one.src_start : one.src_end]
    assert one.strand == "+" and one.del_start >= 55_000
    want = {
        "q": genome["q"][:5_000] + contigs["ctg"][2_500:3_000] + genome["q"][5_100:40_000] + contigs["r"][40_000:59_999] + genome["q"][45_000 : one.del_start] + cut + genome["q"][one.del_end :],
        "u": genome["u"][:5_000] + contigs["ctg"][11_500:12_000] + genome["u"][5_400:],
        "v": genome["v"][:11_999] + contigs["ctg"][21_500:22_000].translate(str.maketrans("ACGT", "TGCA"))[::-1] + genome["v"][18_000:],
        "w": w,
    }
    source = [("seq", k, t) for k, t in genome.items()] + [("contig", k, t) for k, t in contigs.items()]
    chunks = None
    for kind in ("seq", "contig"):
        part = D.chunk_sequences(spark.createDataFrame([(k, t) for x, k, t in source if x == kind], "seq_id string, bases string")).selectExpr(f"'{kind}' AS kind", "*")
        chunks = part if chunks is None else chunks.unionByName(part)
    got = {}
    for r in sorted(E.materialize(out["segments"], chunks).collect(), key=lambda r: (r.seq_id, r.chunk_ix)):
        got[r.seq_id] = got.get(r.seq_id, "") + r.bases
    assert {k: len(t) for k, t in got.items()} == {k: len(t) for k, t in want.items()}
    assert got == want
    assert {r.seq_id: r.seq_length for r in out["lens"].collect()} == {k: len(t) for k, t in want.items()} and out["gaps"].count() == 0
    rows = {r["round"]: (r.ran, r.n_edits, r.n_changed, r.n_gaps) for r in out["steps"].collect()}
    assert rows == {"fill": (True, 1, 1, 4), "filter": (True, 1, 1, 3), "fill again": (True, 1, 1, 2), "patch": (True, 1, 1, 1), "correct": (True, 1, 1, 1), "refill": (True, 1, 1, 0), "telomere": (True, 1, 1, 0)}
    none = run()
    assert {r["round"]: (r.ran, r.n_gaps) for r in none["steps"].collect()} == {name: (False, 5) for _, name in N.ROUNDS} and none["segments"].count() == 4


def test_lifting_by_brute_force(spark):
    """Positions after random edits, base by base: intervals, gaps, two rounds composed, alignments and hits."""
    rng = random.Random(12)
    size, edits, second = {"a": 400, "b": 90}, [], []
    for name, n in size.items():
        at = 0
        while at < n - 20:
            a = at + rng.randrange(25)
            b = min(n, a + rng.choice([0, 1, 7, 30]))
            edits.append((name, a, b, rng.choice(["N", "contig"]), "c", 5, 5 + rng.choice([1, 9, 40]), "+", 0))
            at = b + 1
    lens = spark.createDataFrame(list(size.items()), "seq_id string, seq_length long")
    first = E.apply_edits(spark.createDataFrame(edits, EDIT), lens).cache()

    def spliced(text, rows):
        """Lists of (kind, id, place) tags, one a base."""
        for _, a, b, kind, src, s, e, way, _ in sorted(rows, key=lambda r: (r[1], r[2]), reverse=True):
            new = [(kind, src if kind != "N" else None, k if kind != "N" else None) for k in range(s, e)]
            text = text[:a] + (new if way == "+" else new[::-1]) + text[b:]
        return text

    base = {k: [("seq", k, i) for i in range(n)] for k, n in size.items()}
    after = {k: spliced(base[k], [e for e in edits if e[0] == k]) for k in size}
    place = {k: {t[2]: i for i, t in enumerate(after[k]) if t[0] == "seq"} for k in size}
    rows = [(k, s, s + rng.randrange(0, 60), i) for k, n in size.items() for i, s in enumerate(rng.randrange(n) for _ in range(40))]
    rows = [(k, s, min(e, size[k]), i) for k, s, e, i in rows] + [("a", 0, 400, 99), ("zz", 0, 5, 100)]
    got = {}
    for r in M.lift_intervals(spark.createDataFrame(rows, "seq_id string, start long, end long, i int"), first).collect():
        got.setdefault((r.seq_id, r.i), []).append((r.piece, r.start, r.end))
    for k, s, e, i in rows:
        stay = [place[k][p] for p in range(s, e) if p in place.get(k, {})] if k in place else []
        pieces = sorted(got.get((k, i), []))
        assert [x for _, a, b in pieces for x in range(a, b)] == stay, (k, s, e)
        assert [p for p, _, _ in pieces] == list(range(1, len(pieces) + 1))
    for name, n in {k: len(t) for k, t in after.items()}.items():
        second += [(name, x, x + 9, "contig", "d", 0, 4, "-", 0) for x in range(3, n - 12, 31)]
    new_lens = spark.createDataFrame([(k, len(t)) for k, t in after.items()], "seq_id string, seq_length long")
    both = M.compose(first, E.apply_edits(spark.createDataFrame(second, EDIT), new_lens)).collect()
    for k in size:
        want = spliced(after[k], [e for e in second if e[0] == k])
        made = []
        for r in sorted((r for r in both if r.seq_id == k), key=lambda r: r.n):
            assert r.out_start == len(made)
            part = [(r.kind, r.src_id if r.kind != "N" else None, p if r.kind != "N" else None) for p in range(r.src_start, r.src_end)]
            made += part if r.strand == "+" else part[::-1]
        assert made == want
    runs = [("a", 2, 30, 28, 1, "x"), ("a", 60, 62, 2, 2, "y"), ("b", 0, 90, 90, 3, "z")]
    marked = {k: [("N",) if t[0] == "N" or t[0] == "seq" and any(s == k and a <= t[2] < b for s, a, b, *_ in runs) else t for t in after[k]] for k in size}
    found = M.lift_gaps(spark.createDataFrame(runs, "seq_id string, start long, end long, length long, gap_key long, gap_id string"), first, "round").collect()
    for k in size:
        assert sorted(x for r in found if r.seq_id == k for x in range(r.start, r.end)) == [i for i, t in enumerate(marked[k]) if t == ("N",)]
    assert len({r.gap_key for r in found}) == len(found)
    for way in (1, -1):
        aln = [(i, "r", k, 99.0, 1_001, 1_000 + 2 * (e - s), s + 1, e) if way > 0 else (i, "r", k, 99.0, 1_001, 1_000 + 2 * (e - s), e, s + 1) for k, s, e, i in rows if e > s and k != "zz"]
        cut = {}
        for r in M.lift_alignments(spark.createDataFrame(aln, ALN), first).collect():
            lo, hi = sorted((r.query_start, r.query_end))
            assert (r.query_start <= r.query_end) == (way > 0) or lo == hi
            cut.setdefault((r.query_contig, r.aln_id), []).append((lo - 1, hi, r.ref_start, r.ref_end))
        for k, s, e, i in rows:
            want = sorted(place[k][p] for p in range(s, e) if p in place.get(k, {})) if k in place else []
            assert [x for a, b, _, _ in sorted(cut.get((k, i), [])) for x in range(a, b)] == want
            for a, b, t0, t1 in cut.get((k, i), []):
                p = after[k][a][2] if way > 0 else after[k][b - 1][2]
                assert t1 - t0 + 1 == 2 * (b - a) and t0 == 1_001 + 2 * ((p - s) if way > 0 else (e - 1 - p))


def test_names_by_substring(spark):
    from gapwright.operators import fill as L

    seqs = spark.createDataFrame([("chr10", 0), ("chr1", 1), ("scaffold_Chr2_x", 2)], "seq_id string, seq_ord long")
    names = spark.createDataFrame([("chr1",), ("CHR10",), ("CHR2",), ("zz",)], "name string")
    assert {(r.name, r.seq_id, r["rank"]) for r in L.select_sequences(seqs, names).collect()} == {("chr1", "chr1", 1), ("CHR10", "chr10", 2), ("CHR2", "scaffold_Chr2_x", 2)}
    got = {r.target: (r.name, r["rank"]) for r in L.match_names(spark.createDataFrame([("chr1", 0), ("lg7b", 1)], "name string, seq_ord long"), spark.createDataFrame([("1",), ("chr12",), ("ctg_7",), ("q",)], "target string")).collect()}
    assert got == {"1": ("chr1", 1), "chr12": ("chr1", 2), "ctg_7": ("lg7b", 3)}


def _seeds_of(text, k, w):
    turn = lambda t: t.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    rows = []
    for i in range(len(text) - k + 1):
        a = text[i : i + k]
        b = turn(a)
        n = sum("ACGT".index(c) << 2 * (k - 1 - j) for j, c in enumerate(min(a, b))) if set(a) <= set("ACGT") else None
        rows.append((n, b < a, None if n is None else n * K.SCATTER % 4**k))
    chosen = {i + j for i in range(len(rows) - w + 1) if all(r[2] is not None for r in rows[i : i + w]) for j in range(w) if rows[i + j][2] == min(r[2] for r in rows[i : i + w])}
    return {(i, rows[i][0], rows[i][1]) for i in chosen}


def test_seeds_and_chains(spark):
    """Copies on both strands with changes, repeats, other letters and chunk edges, against plain Python."""
    rng = random.Random(21)
    turn = lambda t: t.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    unit, base = word(40), word(6_000)
    changed = "".join(c if rng.random() > 0.01 else rng.choice("ACGT") for c in base)
    ref = [("r1", base), ("r2", turn(changed)), ("r3", unit * 12 + "NNN" + word(300)), ("r4", "ACG"), ("r5", "")]
    query = [("q1", word(500) + changed[1_000:5_500] + word(200)), ("q2", "N" + unit * 5), ("q3", base[:3_000] + word(700) + base[3_500:])]
    k, w = 15, 8
    table = lambda rows: spark.createDataFrame(rows, "seq_id string, bases string")
    for rows in (ref, query):
        got = {(r.seq_id, r.pos, r.kmer, r.turned) for r in K.minimizer_seeds(table(rows), k, w).collect()}
        assert got == {(name, *s) for name, t in rows for s in _seeds_of(t, k, w)}
    own = {name: _seeds_of(t, k, w) for name, t in query}
    places = {}
    for name, t in ref:
        for j, y, b in _seeds_of(t, k, w):
            places.setdefault(y, []).append((name, j, b))
    want = sorted((qn, rn, i, j, "+" if a == b else "-") for qn in own for i, x, a in own[qn] for rn, j, b in places.get(x, []))
    for most in (2, 1_000):
        anchors = K.seed_anchors(table(query), table(ref), k, w, most)
        assert sorted((r.query_contig, r.ref_contig, r.q, r.r, r.strand) for r in anchors.collect()) == want
    assert len(want) > 1_000
    pairs = {}
    for qn, rn, q, r, strand in want:
        pairs.setdefault((qn, rn, strand), []).append((r, q if strand == "+" else -q - k))
    chains = []
    for (qn, rn, strand), rows in pairs.items():
        rows, done, tops = sorted(set(rows)), [], {}
        for r, x in rows:
            best = (float(k), (x, r), 1)
            for px, pr, ps, proot, n in done[-25:]:
                dx, dr = x - px, r - pr
                if 0 < dx <= 2_000 and 0 < dr <= 2_000:
                    off = abs(dx - dr)
                    s = ps + min(dx, dr, k) - (0.01 * off + 0.5 * math.log2(off) if off else 0)
                    if s > best[0]:
                        best = (s, proot, n + 1)
            done.append((x, r, best[0], best[1], best[2]))
            if best[1] not in tops or best[0] > tops[best[1]][0]:
                tops[best[1]] = (best[0], x, r, best[2])
        for (x0, r0), (score, x1, r1, n) in tops.items():
            lo, hi = (x0, x1 + k) if strand == "+" else (-x1 - k, -x0)
            if hi - lo >= 300:
                chains.append((qn, rn, r0 + 1, r1 + k, *((lo + 1, hi) if strand == "+" else (hi, lo + 1)), n, round(score, 6)))
    got = K.chain_anchors(anchors, k, step=2_000, least=300).collect()
    assert sorted((r.query_contig, r.ref_contig, r.ref_start, r.ref_end, r.query_start, r.query_end, r.n, round(r.score, 6)) for r in got) == sorted(chains)
    assert any(r.ref_contig == "r2" and r.query_start > r.query_end and r.n > 200 for r in got)
    assert K.chain_anchors(anchors.limit(0)).count() == 0


def test_repeated_seeds_are_not_paired(spark):
    """Runs of one letter in both: a row for some places of each, sums and chains as from all pairs (F18, F20)."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("ACGT", k=n))
    shared, k, w = word(900), 15, 8
    ref = [("r1", word(200) + "A" * 200 + shared + "T" * 100), ("r2", "AC" * 60 + shared[::-1])]
    query = [("q1", "A" * 150 + shared + word(100) + "A" * 80), ("q2", "GT" * 50 + word(50))]
    table = lambda rows: spark.createDataFrame(rows, "seq_id string, bases string")
    runs, anchors = K.seed_runs(table(query), table(ref), k, w, 2).cache(), K.seed_anchors(table(query), table(ref), k, w, 2).cache()
    assert anchors.count() > 50 * runs.count()
    sums = anchors.groupBy("query_contig", "ref_contig", "strand").agg(F.count("*").alias("n"), F.sum("q").alias("sum_q"), F.sum("r").alias("sum_r"))
    assert sorted(map(tuple, K.seed_sums(runs).collect())) == sorted(map(tuple, sums.collect()))
    for least in (1, 300):
        chains = sorted(map(tuple, K.chain_anchors(runs, k, step=2_000, least=least).collect()))
        assert chains == sorted(map(tuple, K.chain_anchors(anchors, k, step=2_000, least=least).collect()))
        assert chains


def test_gaps_of_one_place_are_one_run(spark):
    """Two gaps at every place: the SQL of the fill stage numbers no two equal rows (their order would be left to chance), and the operator makes one run of each pair (F27)."""
    rule = STAGE1.replace("FROM gap_positions", "FROM (SELECT 'chr1' AS query_contig, 400 * (i % 3000) AS gap_pos FROM range(6000) t(i)) g")
    rule = rule[: rule.index(" hits1 AS")].rstrip().rstrip(",")
    assert duckdb.sql(rule + " SELECT count(*), count(DISTINCT (s, e)) FROM raw").fetchall() == [(3_000, 3_000)]
    assert duckdb.sql(rule + " SELECT count(*), min(e - s), max(e - s) FROM run").fetchall() == [(3_000, 100, 100)]
    places = spark.range(6_000).select(F.lit("chr1").alias("seq_id"), (400 * (F.col("id") % 3_000)).alias("start")).withColumn("end", F.col("start") + 100)
    runs = D.islands(places, ["seq_id"]).groupBy("island").agg((F.max("end") - F.min("start")).alias("size"), F.count("*").alias("n"))
    assert sorted(map(tuple, runs.groupBy("size", "n").count().collect())) == [(100, 2, 3_000)]


def test_telomere_outcomes_match_once(spark):
    """G20 (F30): what joins the outcomes reads plans written once, not the hits again for each branch."""
    from gapwright.plans.registry import QUERIES

    out = QUERIES["G20_telomere_outcomes"](spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and not [f for f in out.inputFiles() if "lineitem" in f]


def test_fills_read_hits_once(spark, tmp_path):
    """E20 (F40): the best fills come from one reading of the hits."""
    from gapwright.operators import fill as L

    rows = [(1, "c.1.L", 5000, 0, 1000, "+", "k", 9000, 100, 1100, 900, 1000, 60), (2, "c.1.R", 5000, 0, 1000, "+", "k", 9000, 1101, 2100, 800, 1000, 60), (3, "c.1.R", 5000, 0, 1000, "+", "k", 9000, 1100, 2100, 990, 1000, 60)]
    spark.createDataFrame(rows, PAF).write.parquet(str(tmp_path / "hits"))
    best = L.best_fill(L.flank_hits(spark.read.parquet(str(tmp_path / "hits"))))
    assert [(r.l_id, r.r_id, r.fill_start, r.fill_end) for r in best.collect()] == [(1, 2, 1100, 1101)]
    assert best._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_only_gaps_that_may_fall_back_ask_for_blocks(spark, monkeypatch):
    """N5c (F9): gaps outside all alignments can't have support, so no blocks are made for them; hits of gaps that aren't there aren't sorted."""
    from gapwright.operators import fill as L
    from gapwright.operators import synteny as Y

    rows = [(1, "r", "q", 99.0, 1, 10_000, 1_001, 11_000), (2, "r", "q", 99.0, 20_000, 30_000, 1_500_001, 1_510_000), (3, "other", "q", 99.0, 1, 9_000, 2_000_001, 2_009_000)]
    aln = spark.createDataFrame(rows, ALN)
    gaps = lambda *at: spark.createDataFrame([(i, "q", p) for i, p in enumerate(at)], "gap_key long, query_contig string, gap_pos long")
    none = spark.createDataFrame([], "gap_key long")
    asked, blocks = [], Y.synteny_blocks
    monkeypatch.setattr(Y, "synteny_blocks", lambda a: asked.append(1) or blocks(a))
    # before all, at the first one's end, at the last start that has an end of its own contig before it, and beyond
    assert Y.fallback_support(aln, gaps(5, 11_000, 1_500_001, 1_900_000), none).collect() == [] and asked == []
    assert [(r.gap_key, r.gap_pos) for r in Y.fallback_support(aln, gaps(5, 11_001, 1_900_000), none).collect()] == [(1, 11_001)] and asked == [1]
    seen, best = [], L.best_fill
    monkeypatch.setattr(L, "best_fill", lambda hits: seen.append(hits) or best(hits))
    hit = lambda i, g, side, at: (i, f"a.{g}.{side}", 1_500, 0, 1_500, "+", "ctg", 90_000, at, at + 1_500, 1_450, 1_500, 60)
    hits = spark.createDataFrame([hit(1, 1, "L", 1_000), hit(2, 1, "R", 3_000), *(hit(i, i, "L", 1_000) for i in range(3, 50))], PAF)
    lens = spark.createDataFrame([("a", 0, 9_000)], "seq_id string, seq_ord long, seq_length long")
    out = N.fill_gaps(lens, spark.createDataFrame([("a", 3_000, 3_100, 100)], "seq_id string, start long, end long, length long"), hits)
    assert [(r.gap_id, r.status) for r in out["detail"].collect()] == [("a.1", "Closed")]
    assert {r.gap_id for r in seen[0].collect()} == {"a.1"}


def test_lifts_move_rows_once(spark):
    """N7 (F19): alignments and hits meet parts in cells of their size, as they do by number, without windows over them or further joins."""
    rng = random.Random(3)
    parts, rows = [], []
    for name, size in (("a", 400_000_000), ("b", 60_000)):
        at = 0
        while at < size:
            hi = min(size, at + int(10 ** rng.uniform(0, 7.5)))
            parts.append((name, at, hi, at + 7))
            at = hi + rng.choice([0, 0, 1, 4_999, 5_000])
        rows += [(name, s, s + int(10 ** rng.uniform(0, 8.6)), i) for i, s in enumerate(rng.randrange(-3, size) for _ in range(400))]
        rows += [(name, p[1] - x, p[1] + y, 500 + i) for i, p in enumerate(parts[:100]) for x, y in ((0, 1), (1, 0), (1, 1), (0, 0), (5_000, 40_000))]
    p = spark.createDataFrame(parts, "seq_id string, lo long, hi long, at long")
    r = spark.createDataFrame(rows + rows[:9] + [("c", 0, 9, 1)], "seq_id string, start long, end long, i int")
    columns = ["seq_id", "start", "end", "i", "p_lo", "p_hi", "part", "a", "b"]
    got, want = (sorted(map(tuple, f(r, p).select(columns).collect())) for f in (M.touched, M.meet))
    assert got == want and len(got) > len(rows)
    aln = spark.createDataFrame([(1, "r", "a", 99.0, 1, 10_000, 1_001, 11_000)], ALN)
    lens = spark.createDataFrame([("a", 50_000)], "seq_id string, seq_length long")
    segments = E.apply_edits(spark.createDataFrame([("a", 3_000, 4_000, "N", None, 0, 10, "+", 0)], EDIT), lens).localCheckpoint()
    lifted = M.lift_alignments(aln, segments)
    assert sorted((r.query_start, r.query_end, r.ref_start, r.ref_end) for r in lifted.collect()) == [(1_001, 3_000, 1, 2_000), (3_011, 10_010, 3_001, 10_000)]
    plan = lifted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Window" not in plan and "Aggregate" not in plan
