"""Clashing names, ties, very long texts and brute force for the operators that other tests don't cover there."""

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapwright.llm import decontaminate, langid, minhash, quality, rules, store, warc
from gapwright.llm.shared import shared_dir
from test_corpus import SCHEMA, clash, docs, none, same, split  # noqa: F401

rng = random.Random(31)
NAMES = ("row", "text_", "host", "path", "evidence", "score", "p", "n", "s", "sh", "nh", "ll", "soft", "prior", "up", "of_host", "declared", "suffix", "part", "seq", "ids", "lent", "at", "bands", "sig", "rep", "root", "items", "block", "headers", "warc_type")
PAGE = "page_id long, url string, html string"
PAGES = [(i, f"http://h{i % 3}.x{i % 2}/a", f"<html lang={'en' if i % 4 else 'fr'}><p>{'the house of stone' if i % 2 else 'la maison de pierre'} {i % 5}</p>") for i in range(24)] + [(50, None, None), (None, "u", "plain"), (3, "http://h0.x1/a", "<p>x</p>")]


def more(df):
    return df.withColumns({c: df[df.columns[0]] for c in NAMES if c not in df.columns})


def rows(df, *columns):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in (df.select(*columns) if columns else df).collect()]


def test_clashing_names(spark, docs):  # noqa: F811
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (9, 1, 0), (11, 0, 1)], "doc_id long, quality int, toxic int")
    same(rows(quality.classify(more(docs), more(labels))), rows(quality.classify(docs, labels)))
    same(rows(minhash.near_duplicates(more(docs))), rows(minhash.near_duplicates(docs)))
    pages = spark.createDataFrame(PAGES, PAGE)
    learn = spark.createDataFrame([("the house of stone " * 20, "en"), ("la maison de pierre " * 20, "fr")], "text string, lang string")
    same(rows(langid.identify(more(pages), more(learn))), rows(langid.identify(pages, learn)))
    same(rows(warc.derive(warc.responses(more(pages)), "page_id")), rows(warc.derive(warc.responses(pages), "page_id")))
    root = shared_dir(spark)
    store.write_store(more(docs), root)
    assert store.read_store(spark, root).count() == docs.count() and store.verified(spark, root).isEmpty()


def test_empty_pages(spark):
    pages, learn = spark.createDataFrame([], PAGE), spark.createDataFrame([("the house", "en")], "text string, lang string")
    assert langid.identify(pages, learn).count() == 0 and warc.derive(warc.responses(pages)).count() == 0


def fused(pages, learn):
    """The posterior of each page, term by term."""
    names = sorted({k for _, k in learn})
    counts = np.zeros((len(names), 1 << langid.BITS))
    tri = lambda t: langid.trigrams(np.frombuffer(t.encode(), np.uint8))
    for t, k in learn:
        np.add.at(counts[names.index(k)], tri(t), 1)
    pooled = counts.sum(axis=0) + 0.5
    smooth = counts + 1000 * pooled / pooled.sum()
    logp = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    seen = []
    for key, url, html in pages:
        host = (url or "").split("//")[-1].split("/")[0].lower() if "//" in (url or "") else ""
        declared = (html or "").split("lang=")[1][:2] if "lang=" in (html or "") else ""
        ll = langid.TEMPER * logp[:, tri(warc.plain_text(html or ""))].sum(axis=1, dtype=np.float64)
        soft = np.exp(ll - ll.max())
        seen.append((key, host, host.rsplit(".", 1)[-1], declared, ll, soft / soft.sum()))
    total = sum(x[5] for x in seen) + 1
    out = []
    for key, host, suffix, declared, ll, soft in seen:
        up = total / total.sum()
        for name, k in ((suffix, 2), (host, 1)):
            own = [x[5] for x in seen if x[k] == name]
            up = (np.maximum(sum(own) - soft, 0) + langid.STRENGTH * up) / (max(sum(map(np.sum, own)) - 1, 0) + langid.STRENGTH)
        says = np.log((sum(x[5] for x in seen if x[3] == declared) + 0.5) / (total + 0.5)) if declared else 0
        post = ll + np.log(up) + says
        out.append((key, names[int(post.argmax())], round(float(1 / np.exp(post - post.max()).sum()), 6)))
    return out


def test_language_by_brute_force(spark):
    learn = [("the house of stone " * 9, "en"), ("la maison de pierre " * 9, "fr"), ("das haus aus stein " * 9, "de")]
    got = langid.identify(spark.createDataFrame(PAGES, PAGE), spark.createDataFrame(learn, "text string, lang string")).collect()
    same([(r.page_id, r.lang, round(r.confidence, 6)) for r in got], fused(PAGES, learn))


def test_many_languages(spark):
    """More languages than the driver fetches at a time; the last is found."""
    learn = [(" ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{x}" for x in ("ab", "cd", "ef") * 30), f"l{k:02}") for k in range(70)]
    pages = [(k, f"http://h{k}/", f"<p>{t[:60]}</p>") for k, (t, _) in enumerate(learn)]
    got = {r.page_id: r.lang for r in langid.identify(spark.createDataFrame(pages, PAGE), spark.createDataFrame(learn, "text string, lang string")).collect()}
    assert got == {k: name for k, (_, name) in enumerate(learn)}


def test_overlaps_by_brute_force(spark):
    """Items of unique words: what tiles cover is what common windows of five words cover."""
    items = {k: [f"i{k}x{j}" for j in range(rng.randrange(5, 40))] for k in range(12)}
    texts = []
    for k in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            own = items[rng.randrange(12)]
            a = rng.randrange(len(own))
            words += own[a : a + rng.randrange(3, 30)] + [f"f{rng.randrange(50)}" for _ in range(rng.randrange(6))]
        texts.append((k, " ".join(words)))
    want = []
    for k, t in texts:
        w = split(t)
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        n = 0
        for own in items.values():
            cover = {j for i in range(len(own) - 4) if tuple(own[i : i + 5]) in grams for j in range(i, i + 5)}
            n += 100 * len(cover) >= 50 * len(own) and bool(cover)
        want.append((k, n))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(99, " ".join(items[3]))], "item_id long, text string")
    found = decontaminate.overlaps(spark.createDataFrame(texts, "doc_id long, text string"), bench).select("row.doc_id", "row.text", "n_items", "item_id").collect()
    apart = decontaminate.overlaps(spark.createDataFrame(texts, "doc_id long, text string"), bench, most_bytes=0).select("row.doc_id", "row.text", "n_items", "item_id").collect()
    same(apart, found)
    twice = {r.doc_id: r.n_items for r in decontaminate.overlaps(spark.createDataFrame(texts, "doc_id long, text string"), bench.where("item_id = 99")).select("row.doc_id", "n_items").collect()}
    same([(r.doc_id, r.n_items - twice[r.doc_id]) for r in found], want)
    assert all(r.item_id != 99 for r in found), "of equally covered items the smallest id is named"
    assert sum(n for _, n in want) > 5


def test_benchmarks_that_are_not_broadcast(spark):
    """The shuffled join of seeds gives what the broadcast one gives: nulls, empty texts, repeated rows and items, short items,
    a text and an item of more than a slice, a phrase that every item and document has, clashing column names, empty tables."""
    words = [f"w{k}" for k in range(40)]
    hot = "one of the most important things in this book".split()
    items = [(k, " ".join(hot + rng.choices(words, k=rng.randrange(1, 40)))) for k in range(30)]
    items += [(None, items[3][1]), (3, items[4][1]), (40, items[5][1]), (41, None), (42, ""), (43, "w1 w2 w3"), (44, "w1 w2"), (45, "aa bb cc dd")]
    long = " ".join(f"long{k}" for k in range(120_000))
    items.append((46, long))
    docs = []
    for k in range(120):
        own = items[rng.randrange(30)][1].split()
        a = rng.randrange(len(own))
        docs.append((k, " ".join(hot + rng.choices(words, k=rng.randrange(30)) + own[a:] + rng.choices(words, k=3) + own[:a]), k % 3))
    docs += [docs[0], docs[1], (None, docs[2][1], 1), (200, None, 1), (201, "", 1), (202, "aa bb cc dd", 1), (203, f"x {long} w1 w2 w3", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id long").withColumn("at", F.lit(1)).withColumn("size", F.lit(2)).withColumn("seed", F.lit(3))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for least, percent in ((5, 50), (5, 80), (3, 30)):
        both = [sorted((str(r) for r in decontaminate.overlaps(df, bench, least, percent, most_bytes=most).selectExpr("row.*", "n_items AS n", "item_id AS worst", "round(coverage, 9) AS share").collect())) for most in (1 << 24, 0)]
        assert both[0] == both[1] and len(both[0]) == len(docs)
        assert sum("n=0" not in r for r in both[0]) > 10
    assert decontaminate.overlaps(df.limit(0), bench, most_bytes=0).count() == 0
    few = spark.createDataFrame([(1, "a b"), (2, "")], "item_id long, text string")
    assert decontaminate.overlaps(df, few, most_bytes=0).where("n_items = 0").count() == len(docs)
    assert decontaminate.decontaminated(df, bench, most_bytes=0).columns == df.columns


def test_very_long_texts(spark):
    """A text of more than a slice, beside short ones."""
    item = " ".join(f"unique{k}" for k in range(20))
    long = " ".join(rng.choice(["river", "stone", "bird", "moon", "wind"]) + str(rng.randrange(5000)) for _ in range(160_000))
    assert len(long) > 1 << 20
    df = spark.createDataFrame([(1, f"{long} {item}", "en", "a"), (2, item, "en", "b"), (3, "short one", "fr", "b")], SCHEMA)
    got = {r.doc_id: r for r in rules.judged(df).select("row.doc_id", "n_words", "base_failed").collect()}
    assert got[1].n_words == 160_020 and got[3].base_failed
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {r.doc_id: r.n_items for r in decontaminate.overlaps(df, bench).select("row.doc_id", "n_items").collect()} == {1: 1, 2: 1, 3: 0}
    assert quality.classify(df, spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")).count() == 3
    pages = spark.createDataFrame([(1, "http://h/", f"<p>{long}</p>"), (2, "http://h/", "<p>x</p>")], PAGE)
    assert {r.page_id: r.content_length for r in warc.derive(warc.responses(pages), "page_id").where("warc_type = 'conversion'").collect()} == {1: len(long), 2: 1}
    assert langid.identify(pages, df).count() == 2
    root = shared_dir(spark)
    store.write_store(df, root)
    assert store.read_store(spark, root).agg({"n_read": "max"}).first()[0] > 160_000 and store.verified(spark, root).isEmpty()


@pytest.mark.parametrize("url", [None, "url"])
def test_sites_speak_without_the_document_itself(spark, url):
    """A lone document of a site gets the rate of all; one of two gets the other's share."""
    rows_ = [(k, f"good words here {k}", f"http://big.org/a/{k}", "big.org", "a") for k in range(40)] + [(100, "good words", "http://lone.org/b/1", "lone.org", "b")]
    df = spark.createDataFrame(rows_, "doc_id long, text string, url string, source string, lang string")
    got = {r.doc_id: r for r in quality.classify(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"), url_col=url).collect()}
    assert got[100].evidence == 0 and got[100].host_rate == pytest.approx(got[100].path_rate) == pytest.approx(0.5)
    assert got[100].score == pytest.approx(0.5)


def test_warc_within_warc(spark, tmp_path):
    """Pages that quote WARC files, a record that is one, a URL with line breaks, and many small splits of a plain file."""
    inner = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:%d>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    quoted = "".join((inner % k).decode() for k in range(40))
    rows = [(1, "http://h/1", f"<p>before</p>\r\n\r\n{quoted}after"), (2, "http://h/2\r\nX-Bad: 1", "plain"), (3, "http://h/3", "\r\n\r\nWARC/1.0\r\n" * 3), (4, "http://h/4", "x" * 5_000)]
    made = warc.responses(spark.createDataFrame(rows, PAGE)).cache()
    want = sorted((r.record_id, bytes(r.block)) for r in made.collect())
    assert all("\n" not in r.target_uri for r in made.collect())
    whole = b"".join(bytes(r.warc) for r in warc.serialised(made).collect())
    resource = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:all>\r\nContent-Length: %d\r\n\r\n" % len(whole) + whole + b"\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(whole + resource + whole)
    (tmp_path / "b.warc").write_bytes(whole)
    warc.write_warc(made.coalesce(1), str(tmp_path / "packed"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("64m", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = sorted((r.record_id, bytes(r.block)) for r in warc.read_warc(spark, str(tmp_path / "*.warc")).collect())
            assert got == sorted([*want * 3, ("<urn:all>", whole)])
            assert sorted((r.record_id, bytes(r.block)) for r in warc.read_warc(spark, str(tmp_path / "packed")).collect()) == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "cut.warc").write_bytes(whole[:-200])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_warc(spark, str(tmp_path / "cut.warc")).collect()


def test_bodies_of_several_members():
    packed = gzip.compress(b"one ") + gzip.compress(b"two")
    assert warc._body([("Content-Encoding", "gzip")], packed) == b"one two"
    assert warc._body([("Content-Encoding", "gzip")], packed + b"trailing") == b"one two"
    assert warc._body([("Content-Encoding", "gzip")], b"not packed") == b"not packed"


def test_labelled_rows_of_one_text(spark, monkeypatch):
    """Equal and null texts are drawn row by row, so the sample keeps its size."""
    monkeypatch.setattr(quality, "FIT_ROWS", 200)
    monkeypatch.setattr(quality, "MOST_LABELS", 1_000)
    n = 4_000
    df = spark.range(n).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'one text of all' END AS text", "'en' AS lang", "'a' AS source")
    seen = []
    fitted = quality._regression
    monkeypatch.setattr(quality, "_regression", lambda labelled, *a: seen.append(labelled.count()) or fitted(labelled, *a))
    got = quality.classify(df, spark.range(n).selectExpr("id AS doc_id", "int(id % 2) AS quality", "0 AS toxic"))
    assert got.count() == n and (not seen or 700 < seen[0] < 1_300)
