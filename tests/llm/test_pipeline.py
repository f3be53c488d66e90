"""Every stage of the pipeline on its own input, and run() over all of them, against plain Python."""

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from gapwright.llm import tokens
from test_corpus import _near, split

rng = random.Random(21)
VOCAB = [f"w{k:03}" for k in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
MENU = "home | about us | contact | privacy"


def prose(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("data")
    item = prose(30)
    texts = [f"{prose(60)}\n{MENU}\n{prose(50)}" for _ in range(12)]
    texts += [texts[0] + " " + prose(2), texts[0], prose(5), "spam spam spam spam spam " * 30, "### $$$ *** " * 60, f"{prose(40)} {item} {prose(30)}", prose(3000), None, ""]
    rows = [(k, t, "en", f"s{k % 7}", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, prose(20))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The rows that each stage gets and gives."""
    path, _ = folder
    out, docs = {}, spark.read.parquet(f"{path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, path)
        to = str(tmp_path_factory.mktemp("stage") / name)
        made.write.parquet(to)
        out[name] = (docs, docs := spark.read.parquet(to))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == [x.split()[0] for x in SCHEMA.split(", ")]
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_rules_drop_junk_only(stages, folder):
    before, after = map(texts, stages["quality_rules"])
    assert len(before) == len(folder[1])
    assert set(before) - set(after) == {14, 15, 16, 19, 20}


def test_lines_lose_the_menu(stages):
    before, after = map(texts, stages["line_dedup"])
    assert set(before) == set(after) and any(MENU in t for t in before.values())
    assert after == {k: t.replace(MENU + "\n", "") for k, t in before.items()}
    assert all(r.n_chars == len(r.text) for r in stages["line_dedup"][1].collect())


def test_one_of_each_group_stays(stages):
    before, after = map(texts, stages["near_dedup"])
    import test_corpus

    rows, test_corpus.ROWS = test_corpus.ROWS, [(k, t, None, None) for k, t in before.items()]
    try:
        want = _near(5, 80)
    finally:
        test_corpus.ROWS = rows
    assert set(after) == {k for k, root in want.items() if k == root} and len(after) < len(before)


def test_benchmark_passages_go(stages):
    before, after = map(texts, stages["decontamination"])
    assert set(before) - set(after) == {17}


def test_packing_is_whole(stages):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokens.default_path())
    before, after = stages["packing"]
    pieces, bins = {}, {}
    for r in sorted(after.collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert bins.get(r.sequence_id, 0) == r.offset
        bins[r.sequence_id] = r.offset + r.length
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert max(bins.values()) <= 1024
    for k, t in texts(before).items():
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert [(s, n, zlib.crc32(ids[s : s + n].tobytes())) for s, n, _ in sorted(pieces[k])] == sorted(pieces[k])
        assert sum(n for _, n, _ in pieces[k]) == len(ids)


def test_run_gives_the_last_stage(spark, folder, stages):
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(corpus_pipeline.run(spark, folder[0])) == key(stages["packing"][1])
    assert split("a b") == ["a", "b"]
