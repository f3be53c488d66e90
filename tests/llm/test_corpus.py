"""Each corpus operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapwright.llm import decontaminate, langid, lines, minhash, packing, quality, rules, store, suffixes, tokens, warc
from gapwright.llm.shared import components, running, shared_dir, staged

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
rng = random.Random(11)
VOCAB = ["the", "of", "and", "sun", "Moon", "stone,", "river.", "élan", "tree", "bird", "x|y", "100%", "ça", "wind", "rain"]


def text(n):
    return " ".join(rng.choice(VOCAB) + str(rng.randrange(40)) for _ in range(n))


LONG = text(3000)
BASE = text(120)
ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "b"), (3, BASE.replace("the", "The"), "en", "c"), (4, BASE + " one more", "en", "a"),
    (5, None, None, None), (6, "", "en", "a"), (7, " \n\t ", "fr", "b"), (8, "one", "fr", "b"), (9, LONG, "en", "a"), (10, LONG[:9000] + text(400), "en", "b"),
    (11, "word " * 300, "en", "c"), (12, "a b\n\na b\n a b\nc", "de", "c"), (None, BASE, "en", "a"), (None, None, None, None), (13, text(60), "en", "b"), (13, text(60), "en", "b"),
    (14, "  two  blanks \x0b and\x0ctabs\t", "en", "a"), (15, text(30) + "\n" + text(30), "es", "d"),
]
ROWS += [(20 + k, f"{text(40)}\nshared line that stands on many sites\n{text(40)}", "en", f"s{k}") for k in range(7)]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def clash(docs):
    """The same rows with columns whose names the operators use inside."""
    extra = {c: docs["doc_id"] for c in ("row", "words", "h", "n_items", "kept", "rank", "marks", "hits", "cut")}
    return docs.withColumns(extra)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def split(t):
    return WORD.findall(t or "")


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_rules(docs, clash, none):
    want = []
    for i, t, _, _ in ROWS:
        w = split(t)
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        covered = {j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(k, k + 5)} if len(w) < 1000 else set()
        full = [x for x in (t or "").split("\n") if split(x)]
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(full) - len(set(full)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)))
    for df in (docs, clash):
        got = rules.judged(df).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
        same([tuple(r) for r in got if (r.n_words or 0) < 1000], [w for w in want if w[1] < 1000])
    assert rules.judged(none).count() == 0
    assert rules.kept_documents(clash).columns == clash.columns


def test_rules_have_every_language(spark):
    """The last of 70 languages, in another script and of long words, is held against its own reference."""
    rows = [(k, " ".join(f"{w}{k}" for w in ["the", "sun", "of", "stone"] * 15), f"l{k:02}", "a") for k in range(69)]
    rows.append((69, " ".join(["προσεκτικά", "ανθρώπινος", "δικαιοσύνη", "θαλασσινός"] * 12), "l69", "a"))
    rows += [(70, None, "zz", "a"), (71, "the sun", "", "a")]
    got = {r.doc_id: r for r in rules.judged(spark.createDataFrame(rows, SCHEMA)).select("row.doc_id", "char_distance", "word_distance").collect()}
    assert len(got) == len(rows) and got[69].char_distance == pytest.approx(0, abs=1e-6) and got[69].word_distance == pytest.approx(0, abs=1e-6)
    refs = {r.ref_lang: r for r in rules.references(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(refs) == 72 and refs["l69"].common[0] == "ανθρώπινος" and refs["zz"].common == refs[""].common


def test_distance(spark):
    df = spark.createDataFrame([([3, 1], [0.75, 0.25]), ([4, 0], [0.0, 1.0]), ([0, 0], [0.5, 0.5])], "c array<long>, q array<double>")
    got = [r.d for r in df.select(rules.distance(df["c"], df["q"]).alias("d")).collect()]
    assert got[0] == pytest.approx(0) and got[1] == pytest.approx(1) and 0 < got[2] < 1


def test_lines(docs, clash, none):
    bare = lambda x: x.strip(" \t\n\x0b\x0c\r")
    sites = {}
    for _, t, _, s in ROWS:
        for x in (t or "").split("\n") if t is not None else []:
            sites.setdefault(bare(x), set()).add(s)
    mark = {x for x, s in sites.items() if len(s) >= 5 and len(x.encode()) >= 15}
    assert mark
    want = []
    for i, t, _, _ in ROWS:
        cut = t.split("\n") if t is not None else []
        rest = [x for x in cut if bare(x) not in mark]
        want.append((i, "\n".join(rest) if t is not None else None, len(cut), len(cut) - len(rest)))
    for df in (docs, clash):
        same([tuple(r) for r in lines.stripped(df).select("row.doc_id", "text", "n_lines", "n_removed").collect()], want)
    assert lines.stripped(none).count() == 0


def test_lines_of_short_pages(spark):
    """Pages of mostly boilerplate lose it; copies of a document keep their text."""
    menu, copied = "home | about | contact | licence", "\n".join(f"sentence {k} of a copied document" for k in range(6))
    rows = [(k, f"{text(30)}\n{menu}", "en", f"s{k}") for k in range(5)] + [(10, f"short\n{menu}", "en", "s0"), (11, menu, "en", "s9"), (11, menu, "en", "s9")]
    rows += [(20 + k, f"{copied}\n{menu}\nvariant {k}", "en", f"s{k}") for k in range(7)]
    got = {r.doc_id: r.text for r in lines.stripped(spark.createDataFrame(rows, SCHEMA), most_share=0.5).select("row.doc_id", "text").collect()}
    assert got == {i: t.replace("\n" + menu, "").replace(menu, "") for i, t, _, _ in rows}


def _encoded(end):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokens.default_path())
    lib.encode_special_tokens = True
    return [(i, lib.encode(t or "", add_special_tokens=False).ids + [end]) for i, t, _, _ in ROWS]


def test_packing(docs, clash, none):
    want = []
    for i, ids in _encoded(2):
        cut = len(ids) % 1024 or 1024
        at = [0, *range(cut, len(ids), 1024), len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(at, at[1:], strict=False))]
    for df in (docs, clash):
        got = packing.pack(df).collect()
        same([(r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in got], want)
        bins = {}
        for r in sorted(got, key=lambda r: r.offset):
            assert bins.get(r.sequence_id, 0) == r.offset
            bins[r.sequence_id] = r.offset + r.length
        assert max(bins.values()) <= 1024
    assert packing.pack(none).count() == 0


def test_best_two_fit():
    sizes = np.random.default_rng(2).integers(1, 1024, 5000)
    bins, off = packing.best_two_fit(sizes, 1024)
    fill = np.bincount(bins, sizes)
    assert fill.max() <= 1024 and len(fill) <= 1.03 * max(sizes.sum() / 1024, (sizes > 512).sum()) + 1  # uniform sizes are hard: two of over half never share a bin
    bins, _ = packing.best_two_fit(np.array([6, 3, 3, 2, 4]), 10)
    assert len(set(bins.tolist())) == 2


def test_store(spark, docs, none):
    root = shared_dir(spark)
    store.write_store(docs, root)
    assert store.verified(spark, root).isEmpty()
    got = spark.read.parquet(f"{root}/recipes").join(store.read_store(spark, root), "row").collect()
    enc = _encoded(0)
    same([(r.doc_id, list(np.frombuffer(bytes(r.ids), "<u4"))) for r in got], [(i, list(map(np.uint32, x))) for i, x in enc])
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.row))
    at = 0
    for r in order:
        assert r.start == at and r.root == r.read_root
        at += r.n_tokens
    packs = spark.read.parquet(f"{root}/packs").collect()
    stored = [n for p in packs for n, at in zip(p.hashes, p.at, strict=True) if at is not None]
    keys = {r.row: (r.doc_id is not None, r.doc_id or 0) for r in got}
    assert [keys[p.row] for p in sorted(packs, key=lambda p: (p.part, p.row))] == sorted(keys.values())
    assert len(stored) == len(set(map(bytes, stored)))
    other = shared_dir(spark)
    store.write_store(none, other)
    assert store.read_store(spark, other).count() == 0


def test_cut_points_follow_content():
    ids = np.random.default_rng(1).integers(0, 50_000, 20_000).astype(np.uint16)
    a, b = store.cut_points(ids), store.cut_points(np.concatenate([ids[:7], ids]))
    assert a[-1] == 20_000 and max(np.diff([0, *a])) <= store.MOST
    assert len({x + 7 for x in a} & set(b)) > 0.8 * len(a)


def _near(words, percent):
    sets = {}
    for i, t, _, _ in ROWS:
        if i is not None:
            w = split((t or "").translate(LOWER))
            sets.setdefault(i, []).append(frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_minhash(docs, none, words, percent):
    got = minhash.near_duplicates(docs, words, percent).collect()
    want = _near(words, percent)
    assert len(got) == len(ROWS)
    for r in got:
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    assert minhash.near_duplicates(none).count() == 0


def test_each_text_of_an_id_is_compared(spark):
    """Near copies of either text of an id are linked with it, and so with each other."""
    a, b = text(80), text(80)
    rows = [(5, a), (5, b), (7, a + " more"), (9, b + " more"), (9, None), (11, text(80)), (None, a)]
    got = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect())
    assert got == [(0, None, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (9, 9, True), (11, 11, True)]


def test_near_group_whose_head_is_far(spark):
    """Members linked with each other but not with their bucket's smallest id must still be joined."""
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base[:170] + [f"z{k}" for k in range(30)]))]
    for i in range(1, 30):
        w = list(base)
        w[195 + i % 5] = f"v{i}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, 3, 85).collect()}
    assert got[0] == 0 and {got[i] for i in range(1, 30)} == {1}


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(31)) and got[100] == got[70] == 50


def test_decontamination(spark, docs, clash, none):
    item = text(40)
    w = item.split(" ")
    more = [(50, f"{text(20)} {item} {text(20)}"), (51, " ".join(w[20:] + [text(9)] + w[:20])), (52, " ".join(w[:10]) + text(50)), (53, item.upper())]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    bench = spark.createDataFrame([(7, item), (7, "a different text of the same id"), (8, None), (None, "x y z u v w"), (9, "too short"), (10, "only four words here")], "item_id long, text string")
    more = [(60, f"{text(9)} a different text of the same id {text(9)}"), (61, f"{text(9)} u v w {text(3)} x y z u v w"), (62, f"{text(5)} Only, four words here {text(5)}"), (63, f"four words {text(9)} only here")]
    df = df.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r.doc_id: r.item_id for r in decontaminate.overlaps(df, bench).where("n_items > 0").select("row.doc_id", "item_id").collect()}
    assert got == {50: 7, 51: 7, 53: 7, 60: 7, 61: None, 62: 10}
    assert decontaminate.decontaminated(clash, bench).columns == clash.columns
    assert decontaminate.overlaps(none, bench).count() == 0
    assert decontaminate.overlaps(docs, bench.limit(0)).where("n_items > 0").count() == 0


def test_tiles_do_not_overlap():
    r = np.random.default_rng(4)
    for _ in range(30):
        a, b = r.integers(0, 4, 40).astype(np.uint64), r.integers(0, 4, 60).astype(np.uint64)
        used = [np.zeros(40, int), np.zeros(60, int)]
        for q, p, k in decontaminate.tiles(a, b, 3):
            assert k >= 3 and (a[q : q + k] == b[p : p + k]).all()
            used[0][q : q + k] += 1
            used[1][p : p + k] += 1
        assert max(used[0].max(), used[1].max()) <= 1


def test_running_hashes_tell_windows_apart():
    words = np.random.default_rng(6).integers(0, 1 << 63, 5, dtype=np.uint64)[np.random.default_rng(5).integers(0, 5, 400)]
    for n in (1, 3, 50, 400):
        h = running(words)(n)
        names = {}
        assert all(names.setdefault(int(x), words[k : k + n].tobytes()) == words[k : k + n].tobytes() for k, x in enumerate(h))
        assert len(h) == 401 - n and len(names) == len({words[k : k + n].tobytes() for k in range(len(h))})
    assert len(running(words[:3])(5)) == 0


def test_suffix_ranks(spark):
    x = [rng.randrange(1, 4) for _ in range(700)]
    x = x + x[100:400] + [1] * 31
    for n in (len(x), len(x) - 1, len(x) - 2):
        got = suffixes.suffix_ranks(spark.createDataFrame(list(enumerate(x[:n])), "pos long, c long"), 300).toPandas().sort_values("pos")["rank"].tolist()
        order = sorted(range(n), key=lambda i: x[i:n])
        want = [0] * n
        for k, i in enumerate(order):
            want[i] = k
        assert got == want


def _removed(rows):
    seen, want = {}, []
    for i, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            seen.setdefault(b[k : k + 50], i)
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if i is not None and seen[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        want.append((i, len(b), int(gone.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return want


def _suffix_rows(df, **options):
    return [(r.doc_id, r.n_bytes, r.n_removed, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffixes.deduplicated(df, **options).collect()]


def test_suffix_dedup(clash, none):
    same(_suffix_rows(clash), _removed(ROWS))
    assert suffixes.deduplicated(none).count() == 0


def test_suffix_order_decides(spark):
    """All levels of the recursion run; texts of one id keep their own bytes; any other order than the suffixes' loses repeats."""
    shared = [text(14) for _ in range(4)]
    rows = [(k // 2, f"{text(6)} {shared[k % 4][: 60 + 3 * k]} {text(5)} {shared[(k + 1) % 4]}") for k in range(14)] + [(3, shared[2]), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = _removed(rows)
    assert sum(n for _, _, n, _ in want) > 500
    same(_suffix_rows(df, base=200), want)
    by_place = lambda line, base: staged(line.select("pos", F.col("pos").alias("rank")))
    assert sum(n for _, _, n, _ in _suffix_rows(df, ranked=by_place)) < sum(n for _, _, n, _ in want)


def test_suffix_pieces(spark, monkeypatch):
    """By pieces: strings of frequent names one by one, long runs, bytes of zero, and a phrase in every text; far fewer rows are written than bytes repeat."""
    phrase, long = "this very phrase is in every one of them ", text(900)
    rows = [(k // 2, f"{text(6)} {phrase}{long[40 * k : 40 * k + 90]} {text(2)} {long[30 * k : 30 * k + 200]}") for k in range(40)]
    rows += [(20 + k, "a" * (40 + 10 * k) + text(3) + "b\0" * k) for k in range(12)] + [(90, long), (91, "é" * 90 + long[500:7000]), (None, long[:80])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = _removed(rows)
    lines = []
    monkeypatch.setattr(suffixes, "staged", lambda df, **o: lines.append((out := staged(df, **o)).count()) or out)
    same(_suffix_rows(df), want)
    assert sum(lines) < sum(n for _, _, n, _ in want) / 2
    for large in (100, 2000):
        same(_suffix_rows(df, large=large), want)


def test_window_ranks():
    for n in (0, 1, 7, 60, 300):
        b = bytes(rng.randrange(2) for _ in range(n))
        for length in (5, 8, 9, 50):
            at = np.arange(max(0, n - length + 1))
            rank = suffixes.window_ranks(np.frombuffer(b, np.uint8), length, at).tolist()
            cut = [b[i : i + length] for i in at.tolist()]
            order = sorted(set(cut))
            assert rank == [order.index(x) for x in cut]


def test_warc(spark, tmp_path):
    page = '<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head><body><!-- no --><p>One<br>two &lt;b&gt; <a href="/x?a=1&amp;b=2">link</a></p></body></html>'
    pages = spark.createDataFrame([(1, "http://h/x", page), (2, None, None), (None, "u", "plain")], "page_id long, url string, html string")
    made = warc.responses(pages)
    got = {(r.page_id, r.warc_type): r for r in warc.derive(made, "page_id").collect()}
    assert len(got) == 6 and got[1, "conversion"].block == b"A & B\nOne\ntwo <b> link"
    src = {r.page_id: r for r in made.collect()}
    for (k, _), r in got.items():
        assert r.refers_to == src[k].record_id and r.payload_digest == src[k].payload_digest
    assert b'"/x?a=1&b=2"' in got[1, "metadata"].block and got[2, "conversion"].block == b""
    whole = b"".join(bytes(r.warc) for r in warc.serialised(made).collect())
    (tmp_path / "x.warc").write_bytes(whole)
    warc.write_warc(made.repartition(2), str(tmp_path / "out"))
    again = warc.read_warc(spark, str(tmp_path / "out")).collect()
    back = warc.read_warc(spark, str(tmp_path / "x.warc")).collect()
    assert sorted((r.record_id, bytes(r.block)) for r in again) == sorted((r.record_id, bytes(r.block)) for r in back)
    assert sorted((r.record_id, bytes(r.block), r.block_digest) for r in back) == sorted((r.record_id, bytes(r.block), r.block_digest) for r in src.values())
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


def test_warc_headers_and_encodings(spark):
    """Repeated headers in order, names of any case, charset, chunked and gzipped bodies."""
    import gzip
    import json

    page = "<p>\u00e9t\u00e9</p>".encode("latin-1")
    packed = gzip.compress(page)
    chunked = b"%x\r\n%s\r\n%x;x=1\r\n%s\r\n0\r\n\r\n" % (5, packed[:5], len(packed) - 5, packed[5:])
    head = b"HTTP/1.1 200 OK\r\nset-cookie: a\r\nSet-Cookie:b\r\ncontent-type: text/html; Charset='iso-8859-1'\r\nTRANSFER-ENCODING: chunked\r\nContent-encoding: gzip\r\n\r\n"
    rows = [("<r1>", "response", head + chunked), ("<r2>", "response", head.replace(b"TRANSFER-ENCODING: chunked\r\n", b"") + b"not gzip"), ("<r3>", "request", b"GET /"), ("<r4>", "response", None)]
    df = spark.createDataFrame([(i, t, None, None, None, None, None, b, None, None, None) for i, t, b in rows], warc.RECORD)
    got = {(r.refers_to, r.warc_type): bytes(r.block) for r in warc.derive(df).collect()}
    assert len(got) == 6 and got["<r1>", "conversion"].decode() == "\u00e9t\u00e9" and got["<r2>", "conversion"] == b"not gzip" and got["<r4>", "conversion"] == b""
    headers = json.loads(got["<r1>", "metadata"])["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"]
    assert headers[:2] == [["set-cookie", "a"], ["Set-Cookie", "b"]]


def test_language(spark, docs, none):
    words = {"en": "the house and the river of stone", "fr": "la maison et le fleuve de pierre"}
    learn = spark.createDataFrame([(" ".join([t] * 40), k) for k, t in words.items()] + [(None, "en"), ("x", None)], "text string, lang string")
    pages = [(i, f"http://h{i % 3}.fr/a", f'<html lang="{k}"><p>{words[k]}</p>') for i, k in enumerate(["en", "fr"] * 10)] + [(90, None, None), (91, "http://h0.fr/", "<html lang=fr>")]
    got = {r.page_id: r for r in langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), learn).collect()}
    assert len(got) == 22 and all(got[i].lang == ("fr" if i % 2 else "en") for i in range(20))
    assert got[91].lang == "fr" and got[90].lang in words and 0 < got[90].confidence < 1
    empty = langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), learn.limit(0)).collect()
    assert {r.lang for r in empty} == {None}


def test_quality_held_out(spark, none):
    good = [(i, " ".join(rng.choice(["plain", "words", "of", "a", "good", "page"]) + str(rng.randrange(30)) for _ in range(60)), "en", f"h{i % 4}") for i in range(300)]
    bad = [(1000 + i, " ".join(rng.choice(["win###", "cash$$$", "now|||", "page"]) + str(rng.randrange(30)) for _ in range(60)), "en", f"h{i % 4}") for i in range(100)]
    df = spark.createDataFrame(good + bad + [(5000, None, None, None), (None, "x", "en", "h")], SCHEMA)
    marks = spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in good + bad if r[0] % 2] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.classify(df, marks).collect()}
    held = [r[0] for r in good + bad if r[0] % 2 == 0]
    assert np.mean([got[i] == (i < 1000) for i in held]) > 0.95
    assert quality.classify(none, marks).count() == 0
    assert quality.classify(df, marks.limit(0)).count() == df.count()


def test_encoder_equals_library():
    """Ids of cut and cached pieces against whole texts, over joints of every kind of white space."""
    from tokenizers import Tokenizer

    from gapwright.llm.tokens import Encoder, default_path

    lib, own, rng = Tokenizer.from_file(default_path()), Encoder(default_path()), random.Random(3)
    parts = ["a", "b", "the", "ing", "'s", "'", "'ll", " ", " ", "  ", "\n", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "é", "ß", "漢", "1", "23", "²", "!", "?!", "\0", "　", "😀", "ÿ", "þ"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(13))) for _ in range(3000)]
    ids, at = own.encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_keeps_added_tokens(spark):
    """Texts that hold the vocabulary's added token, by the library's default settings."""
    from tokenizers import Tokenizer

    lib, own, rng = Tokenizer.from_file(tokens.default_path()), tokens.Encoder(tokens.default_path()), random.Random(5)
    parts = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", "a", " ", "  ", "\n", "the", "é", "\0"]
    texts = ["a<|endoftext|>b", "", *("".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(500))]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    ids, at = own.encode(texts)
    assert want[0] == [64, 50256, 65]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
    df = spark.createDataFrame([(1, texts[0])], "doc_id long, text string")
    assert np.frombuffer(bytes(packing.pack(df).first().ids), "<u4").tolist() == want[0] + [2]
