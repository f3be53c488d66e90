"""Operators 11 to 13 against brute force in plain Python: nulls, ties, repeated rows, long texts, empty tables and clashing names."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gapwright.llm import fim, licences, vectors
from test_corpus import ROWS, SCHEMA, same

rng = random.Random(5)
TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
EXTRA = ("row", "n", "form", "output", "prefix_chars", "h1", "plain", "spm", "n_words", "places", "codes", "error", "seq", "dims", "part", "key", "ints")


def more(df):
    return df.withColumns({c: df[df.columns[0]] for c in EXTRA if c not in df.columns})


# --- fill-in-middle ----------------------------------------------------------


def middle(key, text, seed=42, rate=50, spm_rate=80):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    tok = TOKENS.findall(text)
    a, b = sorted((h[0] % (len(tok) + 1), h[1] % (len(tok) + 1)))
    p, m, s = ("".join(x) for x in (tok[:a], tok[a:b], tok[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return key, len(tok), "plain", text, None, None
    if h[3] % 100 < spm_rate:
        return key, len(tok), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return key, len(tok), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


FIM_ROWS = [(i, t, a, b) for i, t, a, b in ROWS] + [(100 + k, t, "en", "a") for k, t in enumerate(["<P>", "a <M> b", "<", "<P", "P> <S", "< P > <", " a", "a ", " ", "\x00 \x00", "é  x", "a\n\n b", "日本 語 ", "<<P >>", "x" * 50])]
FIM_ROWS += [(200 + k, " ".join(rng.choice(["<", "S>", "é", "ab", "\n", "  ", "<P", ">"]) for _ in range(rng.randrange(9))), "en", "a") for k in range(80)]


def test_fill_in_middle(spark):
    df = spark.createDataFrame(FIM_ROWS, SCHEMA)
    for docs in (df, more(df)):
        for rate, spm in ((50, 80), (100, 50), (0, 80)):
            made = fim.fill_in_middle(docs, rate=rate, spm_rate=spm)
            got = fim.restored(made.select("row", F.col("row.doc_id").alias("doc_id"), "n", "form", "output", "prefix_chars", "middle_chars")).collect()
            same([(r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in got], [middle(i, t, rate=rate, spm_rate=spm) for i, t, _, _ in FIM_ROWS])
            same([(r.doc_id, r.restored) for r in got], [(i, t or "") for i, t, _, _ in FIM_ROWS])
            assert "text" not in got[0].row
    assert fim.restored(fim.fill_in_middle(spark.createDataFrame([], SCHEMA))).count() == 0


def test_very_long_text_is_moved_in_steps(spark):
    """A text of several steps of the scatter, with short ones beside it; all forms come back."""
    long = " ".join(rng.choice(["rivière", "stone", "月"]) + str(rng.randrange(99)) for _ in range(400_000))
    assert len(long.encode()) > 3 * fim.STEP
    rows = [(k, t) for k in range(12) for t in (long if k % 4 == 1 else f"a few words {k}",)]
    got = fim.restored(fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), rate=100)).collect()
    same([(r.row.doc_id, hashlib.md5(r.restored.encode()).hexdigest(), r.form) for r in got], [(k, hashlib.md5(t.encode()).hexdigest(), middle(k, t, rate=100)[2]) for k, t in rows])
    same([(r.row.doc_id, r.output == middle(k, t, rate=100)[3]) for r, (k, t) in zip(sorted(got, key=lambda r: r.row.doc_id), rows, strict=True)], [(k, True) for k, _ in rows])
    assert {r.form for r in got} == {"spm", "psm"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.text(alphabet="ab <>PSM\né", max_size=30)), max_size=8), st.integers(0, 3))
def test_scatter_and_gather(rows, bad):
    """The array steps alone, many small texts at once; a damaged output is told."""
    texts = [t.encode() for _, t in rows]
    buf, at = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    starts = fim.token_starts(buf, at)
    want = [a + len("".join(TOKENS.findall(t.decode())[:k]).encode()) for a, t in zip(at.tolist(), texts, strict=False) for k in range(len(TOKENS.findall(t.decode())))]
    assert starts.tolist() == want
    made = [middle(k, t, rate=100) for k, t in rows]
    plain, spm = np.array([m[2] == "plain" for m in made], bool), np.array([m[2] == "spm" for m in made], bool)
    outs = [m[3].encode() for m in made]
    out_at = np.concatenate([[0], np.cumsum([len(x) for x in outs], dtype=np.int64)]).astype(np.int64)
    got, got_at = fim.put_back(np.frombuffer(b"".join(outs), np.uint8), out_at, spm, plain)
    assert got.tobytes() == buf.tobytes() and got_at.tolist() == at.tolist()
    if (~plain).any():
        k = int(np.flatnonzero(~plain)[0])
        broken = outs[k].replace((b"<P>", b"<S>", b"<M>", b"<M>")[bad], b"")
        with pytest.raises(ValueError):
            fim.put_back(np.frombuffer(broken, np.uint8), np.array([0, len(broken)]), spm[k : k + 1], plain[k : k + 1])


# --- licences ----------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(t):
    return WORD.findall((t or "").translate(LOWER))


def at_places(words, phrase):
    return [k for k in range(len(words) - len(phrase) + 1) if words[k : k + len(phrase)] == phrase]


def scanned(rows, rare=12, slack=32, share=0.6):
    """(id, n_words, places) by plain Python, word by word."""
    templates = [(label, split(t), [split(p) for p in keys]) for label, t, keys in licences.TEMPLATES]
    order = {}
    for _, own, _ in templates:
        for w in own:
            order.setdefault(w, len(order))
    for _, _, keys in templates:
        for p in keys:
            for w in p:
                order.setdefault(w, len(order))
    texts = [(i, split(t)) for i, t in rows]
    df = {w: sum(w in set(x) for _, x in texts) for w in order}
    idf = {w: math.log((len(texts) + 1) / (df[w] + 1)) + 1 for w in order}
    out = []
    for i, words in texts:
        places = [(label, True, k, k + len(split(p)), 1.0) for label, p in licences.BASE for k in at_places(words, split(p))]
        for label, own, keys in templates:
            if not all(at_places(words, p) for p in keys):
                continue
            look = sorted({w for w in own if w in words}, key=lambda w: (-idf[w], order[w]))[:rare]
            votes = {}
            for w in look:
                for k in at_places(words, [w]):
                    for q in at_places(own, [w]):
                        for b in ((k - q) // (slack // 2), (k - q) // (slack // 2) - 1):
                            votes.setdefault(b, set()).add(w)
            best = None
            for b in sorted(b for b, v in votes.items() if 4 * len(v) >= len(look)):
                begin = b * (slack // 2)
                lo, hi = max(0, begin), min(len(words), begin + slack + len(own))
                if not all(any(lo <= k and k + len(p) <= hi for k in at_places(words, p)) for p in keys):
                    continue
                n = sum(any(0 <= k < len(words) and words[k] == w for k in range(begin + q, begin + q + slack)) for q, w in enumerate(own))
                if n / len(own) >= share and (best is None or n / len(own) > best[4]):
                    best = (label, False, lo, hi, n / len(own))
            places += [best] if best else []
        out.append((i, len(words), sorted(places)))
    return out


def licence_rows():
    filler = lambda n: " ".join(rng.choice(["the", "software", "License,", "any", "tree", "élan", "work", "version", "permission", "is", "2"]) for _ in range(n))
    rows = [(1, None), (2, ""), (3, " ,;\n"), (4, "Released under the MIT License."), (5, "UNDER-THE-MIT\nLICENSE under the mit license"), (6, "under the mit"), (7, "CC BY-NC 4.0, cc by nc"), (8, "Apache License, Version 2.0"), (9, "apache license versión 2"), (10, "ümit license under the ümit license")]
    rows += [(None, "This work is licensed under the GNU General Public License, version 3."), (11, "This work is licensed under the GNU General Public License, version 3."), (11, "This work is licensed under the GNU General Public License, version 3.")]
    for k, (_, text, _) in enumerate(licences.TEMPLATES):
        words = text.split()
        rows.append((20 + k, f"{filler(60)} {text} {filler(40)}"))
        rows.append((60 + k, " ".join(w for w in words if rng.random() < 0.8)))
        at = rng.randrange(len(words))
        rows.append((100 + k, f"{filler(9)}\n{' '.join(words[:at])} {filler(7)} {' '.join(words[at:])}"))
        rng.shuffle(words)
        rows.append((140 + k, " ".join(words)))
    rows.append((200, " and ".join(text for _, text, _ in licences.TEMPLATES)))
    return rows + [(300 + k, filler(rng.randrange(80))) for k in range(60)]


def test_licences_by_brute_force(spark):
    rows = licence_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = scanned(rows)
    for docs in (df, more(df)):
        got = licences.scan(docs).select("row.doc_id", "n_words", "places").collect()
        same([(r.doc_id, r.n_words, sorted(tuple(p) for p in r.places)) for r in got], want)
    labels = {i: {p[0] for p in places} for i, _, places in want}
    texts = dict(rows)
    for k, (label, _, keys) in enumerate(licences.TEMPLATES):
        assert label in labels[20 + k], label
        whole = all(at_places(split(texts[100 + k]), split(p)) for p in keys)  # the words put in may stand within a key phrase
        assert (label in labels[100 + k]) == whole, label
    assert labels[200] >= {label for label, _, _ in licences.TEMPLATES}
    assert not any(labels[300 + k] for k in range(60)), "ordinary text has no licence"
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [len(r.places) for r in licences.scan(df.where("doc_id = 20"), templates=[]).collect()] == [0]
    assert licences.scan(df.where("doc_id = 4"), keep=["doc_id"]).first().row.asDict() == {"doc_id": 4}


def test_licence_in_a_very_long_text(spark):
    """Behind 200,000 words, and many licences in one text."""
    far = " ".join(rng.choice(["license", "software", "stone"]) for _ in range(200_000))
    rows = [(1, f"{far} {licences.TEMPLATES[4][1]} {far} Under the MIT License"), (2, " ".join(licences.TEMPLATES[0][1] for _ in range(300))), (3, "short")]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "n_words", "places").collect()}
    assert got[1].n_words == 400_004 + len(split(licences.TEMPLATES[4][1]))
    assert {(p.label, p.base) for p in got[1].places} == {("isc", False), ("mit", True)} and [p.start for p in got[1].places if p.base] == [got[1].n_words - 4]
    assert [(p.label, p.start, p.score) for p in got[2].places] == [("mit", 0, 1.0)] and not got[3].places


# --- vector codes ------------------------------------------------------------


def coded(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, codes, error) and codebooks by plain Python integers."""
    kept = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    sizes = [len(v) for _, v in kept if len(v) % parts == 0]
    if not sizes:
        return [], []
    dims = max(set(sizes), key=lambda n: (sizes.count(n), n))
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in kept if len(v) == dims]
    w = dims // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))[:entries]
    books = [[v[p * w : (p + 1) * w] for _, v in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for _, v in kept:
                groups.setdefault(nearest(v[p * w : (p + 1) * w], book)[1], []).append(v[p * w : (p + 1) * w])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(book)]
    out = []
    for i, v in kept:
        best = [nearest(v[p * w : (p + 1) * w], books[p]) for p in range(parts)]
        out.append((i, [k for _, k in best], sum(d for d, _ in best)))
    return out, books


VECTORS = "vec_id long, embedding array<float>, label int"
F32 = lambda x: float(np.float32(x))


def vector_rows(n, dims, spread=1.0):
    """Clusters, copies, ties, negative and null ids, and rows that are dropped."""
    centres = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(6)]
    rows = [(k, [F32(x + rng.gauss(0, 0.1 * spread)) for x in centres[k % 6]], k % 3 if k % 7 else None) for k in range(n)]
    rows += [(-5, [0.0] * dims, 1), (-5, [F32(-0.5)] * dims, 2), (None, [F32(0.25)] * dims, 0)] + [(1000 + k, [F32(0.125)] * dims, 4) for k in range(n // 3)]
    rows += [(2000, None, 0), (2001, [0.0, None] + [0.0] * (dims - 2), 0), (2002, [math.nan] * dims, 0), (2003, [math.inf] + [0.0] * (dims - 1), 0), (2004, [], 0), (2005, [0.0] * (dims + 4), 0), (2006, [0.0] * (dims + 1), 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "dims", "parts", "entries", "block"), [(90, 16, 4, 8, 4), (60, 8, 2, 256, 32), (40, 160, 2, 5, 3)])
def test_codes_by_brute_force(spark, n, dims, parts, entries, block):
    rows = vector_rows(n, dims)
    want, books = coded([(i, v) for i, v, _ in rows], parts, entries)
    df = spark.createDataFrame(rows, VECTORS)
    for table in (df, more(df)):
        found, got_books = vectors.compress(table, parts, entries, block=block)
        same([(r.vec_id, r.codes, r.error) for r in found.select("row.vec_id", "codes", "error").collect()], want)
        assert got_books.tolist() == books
    back = vectors.restored(found, got_books).select("row.vec_id", "codes", "vector").collect()
    assert all(r.vector == [x for p, k in enumerate(r.codes) for x in books[p][k]] for r in back) and len(back) == len(want)


def test_codes_of_few_or_no_rows(spark):
    for rows in ([], [(1, None, 0)], [(1, [0.5] * 8, 0)]):
        found, books = vectors.compress(spark.createDataFrame(rows, VECTORS))
        assert [(r.codes, r.error) for r in found.collect()] == [([0] * 4, 0)] * (len(rows) and rows[0][1] is not None)
    with pytest.raises(Exception, match="more than"):
        vectors.compress(spark.createDataFrame([(1, [1e9] * 8, 0)], VECTORS))


def test_hilbert_steps_are_one_cell_long():
    """Along the curve, neighbours differ by one in one coordinate, and every cell has its own place."""
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        keys = vectors.hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 6), st.integers(1, 9), st.integers(0, 10**6))
def test_shortlists_lose_no_nearest_entry(width, entries, seed):
    r = np.random.default_rng(seed)
    book = r.integers(-9, 9, (entries, width))
    x = r.integers(-12, 12, (7, width)) + r.integers(-3, 3, width)
    short = vectors.shortlists(x.min(axis=0)[None], x.max(axis=0)[None], book)[0]
    best, far = vectors.nearest(x, book)
    listed = np.flatnonzero(short)
    again, again_far = vectors.nearest(x, book[listed])
    assert (listed[again] == best).all() and (again_far == far).all()
    assert (far == ((x - book[best]) ** 2).sum(axis=1)).all()
