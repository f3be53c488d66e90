"""Benchmark decontamination by greedy string tiling.

Words are what blanks and ASCII punctuation leave, in lower case. A benchmark of at most `BLOCK_BYTES` goes to every
task once and its seeds (windows of `least` words) are joined with the documents' windows there, so documents are
neither shuffled nor exploded. A larger one isn't sent anywhere: seeds and windows meet by a shuffled join, each item
by its rarest seeds only, of which a document that covers enough of it has one at least (`_by_seeds`). A document
and an item that share seeds are tiled: matches of running Karp-Rabin hashes, longest first, are marked and not used again,
with search lengths halved down to `least` words. An item is contaminated by a document whose tiles, in
any order, cover at least `percent` of the item's words.

An item of fewer than `least` words is found where a document has it whole, in one piece; one of fewer than
`shortest` can't be told from ordinary language and is not looked for.

Each distinct pair of id and text is an item of its own, also where the id is null or has several texts; n_items counts
these. Null texts match nothing. Repeated rows each get the same answer; of equally covered items the smallest id is
named, null last. An empty table on either side contaminates nothing. A very long text is one task's row: its
windows are looked up at once, and it is tiled only with items that share enough seeds.
Further columns of the documents pass through whatever their names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import PUNCTUATED, arrow_map, buffer_of, running, shingles_of, slices, staged, words_of

BLOCK_BYTES = 16 << 20


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(item position, document position, length) of the greedy tiles of two word-hash arrays."""
    free = [np.ones(len(item), bool), np.ones(len(doc), bool)]
    windows = [running(x) for x in (item, doc)]
    found: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(doc)))
    while len(item) >= least and len(doc) >= least:
        spans = []
        grams = [f(size) for f in windows]
        taken = [np.concatenate([[0], np.cumsum(~f)]) for f in free]
        whole = [t[size:] == t[:-size] for t in taken]
        at: dict[int, list[int]] = {}
        for q in np.flatnonzero(whole[0]).tolist():
            at.setdefault(int(grams[0][q]), []).append(q)
        hits = np.flatnonzero(whole[1] & np.isin(grams[1], np.array(list(at), np.uint64))) if at else []
        for p in list(hits):
            for q in at[int(grams[1][p])]:
                if (item[q : q + size] != doc[p : p + size]).any():
                    continue  # equal hashes of different words
                if p and q and free[0][q - 1] and free[1][p - 1] and item[q - 1] == doc[p - 1]:
                    continue  # part of the match that begins earlier
                k = size
                while q + k < len(item) and p + k < len(doc) and free[0][q + k] and free[1][p + k] and item[q + k] == doc[p + k]:
                    k += 1
                spans.append((k, q, int(p)))
        marked = False
        for k, q, p in sorted(spans, key=lambda x: (-x[0], x[1], x[2])):
            if free[0][q : q + k].all() and free[1][p : p + k].all():
                free[0][q : q + k] = free[1][p : p + k] = False
                found.append((q, p, k))
                marked = True
        if not marked:
            if size == least:
                break
            size = max(least, size // 2)
    return found


def _block(rows: list, least: int, shortest: int) -> dict:
    """Items of a block with their ids, and their seeds by length of window, sorted. Items shorter than `least` words are one seed."""
    buf, at = buffer_of(pa.array([r["text"] for r in rows], pa.string()))
    h, _, _, first = words_of(buf, at, apart=PUNCTUATED)
    found = [(r["item_id"], h[a:b]) for r, a, b in zip(rows, first[:-1].tolist(), first[1:].tolist(), strict=True) if b - a >= min(least, shortest)]
    ids, items = [i for i, _ in found], [w for _, w in found]
    seeds = {}
    for size in sorted({min(least, len(w)) for w in items}):
        own = [(shingles_of(w, size), k) for k, w in enumerate(items) if min(least, len(w)) == size]
        flat = np.concatenate([s for s, _ in own])
        order = np.argsort(flat, kind="stable")
        seeds[size] = (flat[order], np.repeat(np.array([k for _, k in own]), [len(s) for s, _ in own])[order])
    return {"ids": ids, "items": items, "seeds": seeds}


def _rank(share: float, item: int | None) -> tuple:
    """The order in which the item to name is chosen: the most covered, then the smallest id, null last."""
    return share, item is not None, -(item or 0)


def _worst(words: np.ndarray, block: dict, least: int, percent: float) -> tuple[int, int | None, float]:
    """Contaminated items of the block, the id of the one covered most, and its covered share."""
    n, best, most = 0, None, 0.0
    for size, (seeds, owner) in block["seeds"].items():
        if len(words) < size:
            continue
        grams = shingles_of(words, size)
        lo = np.searchsorted(seeds, grams)
        hit = grams[seeds[np.minimum(lo, len(seeds) - 1)] == grams]
        if not len(hit):
            continue
        shared = np.isin(seeds, hit)
        for k, count in zip(*np.unique(owner[shared], return_counts=True), strict=True):
            own = block["items"][k]
            # seeds cover at most `size` words each: no need to tile where even that falls short
            if 100 * size * int(count) < percent * len(own):
                continue
            share = sum(x for _, _, x in tiles(own, words, size)) / len(own)
            n += 100 * share >= percent
            if share and _rank(share, block["ids"][k]) > _rank(most, best):
                best, most = block["ids"][k], share
    return n, best, most


def overlaps(docs: DataFrame, bench: DataFrame, least: int = 5, percent: float = 50, shortest: int = 3, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each row of docs as struct `row`, with n_items (contaminated items), item_id and coverage (of the item covered most).

    most_bytes: the text of a benchmark that may be broadcast."""
    source = bench.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null").distinct()
    size = source.agg(F.sum(F.octet_length("text") + F.lit(32))).first()[0] or 0
    out = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    if size > most_bytes:
        return _by_seeds(out, source, least, percent, shortest)
    schema = T.StructType([out.schema["row"], T.StructField("n_items", T.IntegerType()), T.StructField("item_id", T.LongType()), T.StructField("coverage", T.DoubleType())])
    # of at most most_bytes, so it may go through the driver
    block = docs.sparkSession.sparkContext.broadcast(_block(source.orderBy("item_id", "text").collect(), least, shortest))

    def run(batches):
        data = block.value
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h, _, _, first = words_of(buf, at, apart=PUNCTUATED)
            rows = [_worst(h[a:b], data, least, percent) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            n, i, c = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(n, pa.int32()), pa.array(i, pa.int64()), pa.array(c, pa.float64())], names=["row", "n_items", "item_id", "coverage"])

    return arrow_map(out, run, schema)


def _windows(texts: DataFrame, key: str, sizes: list[int] | None, least: int, shortest: int) -> DataFrame:
    """key, size, seed, n (places in the text), words of texts (key, text): distinct windows of the sizes, or (None) the seeds of an item."""

    def run(batches):
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h, _, _, first = words_of(buf, at, apart=PUNCTUATED)
            keys, out = part.column(key).to_pylist(), {"key": [], "size": [], "seed": [], "n": [], "words": []}
            for k, a, b in zip(keys, first[:-1].tolist(), first[1:].tolist(), strict=True):
                for size in sizes or ([min(least, b - a)] if b - a >= min(least, shortest) else []):
                    if b - a >= size:
                        seed, n = np.unique(shingles_of(h[a:b], size), return_counts=True)
                        for name, x in (("key", k), ("size", size), ("seed", seed.view(np.int64)), ("n", n), ("words", b - a)):
                            out[name].append(np.broadcast_to(np.asarray(x, np.int64), len(seed)))
            if out["key"]:
                yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate(x)) for c, x in out.items()})

    return arrow_map(texts.select(key, "text"), run, "key long, size long, seed long, n long, words long")


def _by_seeds(out: DataFrame, source: DataFrame, least: int, percent: float, shortest: int) -> DataFrame:
    """overlaps without a broadcast of the benchmark: windows that are a seed, counted; candidates by each item's rarest seeds; tiles.

    An item of n words needs c = n * percent / (100 * size) of its m seed places in a document, so a document that has as many
    has one of the seeds that stay when the commonest, of fewer than c places in all, are left out. Each document's text moves
    once, before the items that it is tiled with; a task holds one document and one item at a time."""
    docs = staged(out.withColumn("at", F.monotonically_increasing_id()))
    items = staged(source.withColumn("item", F.monotonically_increasing_id()))
    seeds = staged(_windows(items, "item", None, least, shortest).withColumnRenamed("key", "item"))
    sizes = sorted(r["size"] for r in seeds.select("size").distinct().collect())  # of `least` values at most
    wanted = seeds.select("size", "seed").distinct()
    hits = staged(_windows(docs, "at", sizes, least, shortest).select(F.col("key").alias("at"), "size", "seed").join(wanted, ["size", "seed"], "left_semi") if sizes else _windows(docs.limit(0), "at", None, least, shortest).select(F.col("key").alias("at"), "size", "seed"))
    often = seeds.join(hits.groupBy("size", "seed").agg(F.count("*").alias("df")), ["size", "seed"])
    # seeds that no document has count as left out last: the places that are found anywhere decide
    line = Window.partitionBy("item").orderBy(F.desc("df"), "seed").rowsBetween(Window.unboundedPreceding, 0)
    rare = often.withColumn("upto", F.sum("n").over(line)).where(F.col("upto") * 100 * F.col("size") >= F.lit(percent) * F.col("words"))
    pairs = staged(hits.join(rare.select("size", "seed", "item"), ["size", "seed"]).select("at", "item", "size").distinct())
    asked = pairs.join(items, "item").select("at", F.lit(1).alias("kind"), "item", "item_id", "text", "size")
    none = {c: F.lit(None).cast("long").alias(c) for c in ("item", "item_id", "size")}
    texts = docs.join(pairs.select("at").distinct(), "at", "left_semi").select("at", F.lit(0).alias("kind"), none["item"], none["item_id"], "text", none["size"])
    lined = asked.unionByName(texts).repartition("at").sortWithinPartitions("at", "kind", "item")

    def tile(batches):
        doc = grams = None
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h, _, _, first = words_of(buf, at, apart=PUNCTUATED)
            found = []
            for k, a, b in zip(range(part.num_rows), first[:-1].tolist(), first[1:].tolist(), strict=True):
                if part.column("kind")[k].as_py() == 0:
                    doc, grams = h[a:b].copy(), {}
                    continue
                own, size = h[a:b], part.column("size")[k].as_py()
                if size not in grams:
                    grams[size] = np.unique(shingles_of(doc, size))
                count = int(np.isin(shingles_of(own, size), grams[size]).sum())
                if 100 * size * count >= percent * len(own):
                    share = sum(x for _, _, x in tiles(own, doc, size)) / len(own)
                    found.append((part.column("at")[k].as_py(), part.column("item_id")[k].as_py(), share, 100 * share >= percent))
            if found:
                a, i, s, f = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64()), pa.array(f, pa.bool_())], names=["at", "item_id", "share", "full"])

    rank = F.struct("share", F.col("item_id").isNotNull(), -F.coalesce("item_id", F.lit(0)))
    best = arrow_map(lined, tile, "at long, item_id long, share double, full boolean").where("share > 0").groupBy("at").agg(F.count_if("full").cast("int").alias("n_items"), F.max_by("item_id", rank).alias("item_id"), F.max("share").alias("coverage"))
    return docs.join(best, "at", "left").select("row", F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def decontaminated(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The rows of docs, columns unchanged, that contaminate no item."""
    return overlaps(docs, bench, **options).where("n_items = 0").select("row.*")


def op9_string_tiling(spark, sf_dir: str) -> DataFrame:
    """Query: every document with the number of benchmark items that it contaminates and the item covered most."""
    found = overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("row.doc_id", "n_items", "item_id", F.round("coverage", 6).alias("coverage"), (F.col("n_items") == 0).alias("kept"))
