"""Near-duplicate groups: MinHash banding with sequential Bayesian verification.

1. Each text's set of word shingles is hashed, with `BANDS * ROWS` min-hashes. Texts of equal sets are one
   class, kept by its smallest doc_id, so a hot text costs one representative.
2. Classes that share a band's min-hashes are candidates. Each is first paired with its bucket's smallest
   member (pairs grow with the members, not their square). Signatures are compared in batches of
   `BATCH` hashes; a pair is dropped as soon as the posterior probability that its similarity reaches the
   threshold (uniform prior) is below `MISS`. Survivors are confirmed on their full sets.
3. Buckets whose members are still in several components get all their cross-component pairs compared
   in the same way, except those within the bucket's largest component, in blocks of bounded size. In buckets of
   more than `MANY` members the block's task also counts the shingles that survivors share (by 32 bits of their
   hashes, which can only add to the count), so that groups of texts just below the threshold make no pairs. The
   first round confirms each member's most similar partner only, which joins nearly all that belongs together; the
   last confirms every pair that is left. So no link is lost to a bad choice of partner, and copies don't emit all pairs.
   Sets of more than `MOST_ITEMS` shingles aren't counted in the block; their survivors are confirmed as all others are.

The chance that a link at the threshold shares no band is (1 - s**ROWS)**BANDS, 2e-6 at 0.8.

Nulls: a null or wordless text has the empty set and is linked with nothing. A row of null id is returned
with a null component and kept. Rows that share an id are one document, linked with each other, each text compared. An empty
table gives no rows. A very long text is hashed alone, in slices of its set. Other columns are not read, so their names cannot clash."""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_map, buffer_of, components, mix, shingles_of, slices, small, staged, words_of

BANDS, ROWS, BATCH, MISS = 25, 4, 20, 1e-6
HASHES = BANDS * ROWS
#: Members of a bucket's block; two blocks are compared at a time.
BLOCK = 400
#: Buckets of more members carry their sets of up to MOST_ITEMS shingles into the blocks.
MANY, MOST_ITEMS = 32, 8192


@lru_cache(maxsize=1)
def _params() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(1, 1 << 63, HASHES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES min-hashes (uint32) of a set of 64-bit hashes."""
    a, b = _params()
    least = np.full(HASHES, np.uint64((1 << 64) - 1))
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[i : i + 2048, None] * a + b).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


@lru_cache(maxsize=8)
def least_matches(percent: int) -> tuple[int, ...]:
    """For each batch: the fewest matches so far that leave P(similarity >= percent) at MISS or more."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < MISS:  # with a uniform prior, P(s >= t | m of n) = P(Binomial(n + 1, t) <= m)
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def passing(a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the signature pairs that no batch prunes, and their matches."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int32)
    for k, least in enumerate(least_matches(percent)):
        at = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[left, at] == b[left, at]).sum(axis=1)
        keep = matches >= least
        left, matches = left[keep], matches[keep]
    return left, matches


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, two hashes of the set, its signature and band keys (null without shingles)."""

    def run(batches):
        pow31 = np.uint64(0x9E3779B97F4A7C15)
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h, _, _, first = words_of(buf, at)
            n, k1, k2, sigs, bands = [], [], [], [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                own = np.unique(shingles_of(h[a:b], words))
                n.append(len(own))
                if not len(own):
                    k1.append(None), k2.append(None), sigs.append(None), bands.append(None)
                    continue
                k1.append(int(own.sum().astype(np.int64)))
                k2.append(int(mix(own ^ np.uint64(len(own))).sum().astype(np.int64)))
                sig = signature(own)
                key = np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    key = mix(key * pow31 + sig[r::ROWS])
                sigs.append(sig.tobytes())
                bands.append(key.astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "k1", "k2", "sig", "bands"])

    return arrow_map(docs, run, "doc_id long, n_shingles long, k1 long, k2 long, sig binary, bands array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h, _, _, first = words_of(buf, at)
            sets = [np.unique(shingles_of(h[a:b], words)).astype(np.int64) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            ends = np.cumsum([0, *map(len, sets)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets), pa.int64()))], names=["doc_id", "items"])

    return arrow_map(docs, run, "doc_id long, items array<long>")


def _short_sets(docs: DataFrame, words: int) -> DataFrame:
    """rep, items: 32 bits of each shingle's hash, for sets of MOST_ITEMS at most."""

    def run(batches):
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h, _, _, first = words_of(buf, at)
            sets = [np.unique(shingles_of(h[a:b], words)) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            items = [(x >> np.uint64(32)).astype("<u4").tobytes() if len(x) <= MOST_ITEMS else None for x in sets]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(items, pa.binary())], names=["rep", "items"])

    return arrow_map(docs, run, "rep long, items binary")


class Shared:
    """Upper bounds of the shingles that members of one block share."""

    def __init__(self, items: list[bytes | None]):
        sets = [np.frombuffer(x or b"", "<u4") for x in items]
        self.known = np.array([x is not None for x in items], bool)
        self.ends = np.cumsum([0, *map(len, sets)])
        names, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(names), bool)

    def reaching(self, x: int, y: np.ndarray, percent: int) -> np.ndarray:
        """Which of the ascending members y may reach the threshold with x; unknown sets may."""
        if not self.known[x]:
            return np.ones(len(y), bool)
        own = self.ids[self.ends[x] : self.ends[x + 1]]
        self.mark[own] = True
        begin, end = self.ends[y[0]], self.ends[y[-1] + 1]
        total = np.concatenate([[0], np.cumsum(self.mark[self.ids[begin:end]])])
        self.mark[own] = False
        both = total[self.ends[y + 1] - begin] - total[self.ends[y] - begin]
        return (100 * both >= percent * (len(own) + self.ends[y + 1] - self.ends[y] - both)) | ~self.known[y]


def _pruned(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Of (a, b) those whose signatures may reach the threshold."""
    both = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b")

    def run(batches):
        for x in batches:
            if x.num_rows:
                sa, sb = (np.frombuffer(b"".join(x.column(c).to_pylist()), "<u4").reshape(-1, HASHES) for c in ("sa", "sb"))
                yield x.take(pa.array(passing(sa, sb, percent)[0])).select(["a", "b"])

    return arrow_map(both.select("a", "b", "sa", "sb"), run, "a long, b long")


def _confirmed(pairs: DataFrame, source: DataFrame, words: int, percent: int) -> DataFrame:
    """Of (a, b), a staged table, those whose full sets reach the threshold."""
    need = staged(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    # a document may have several rows: one text stands for it
    sets = staged(_sets(source.join(small(need), "doc_id", "left_semi"), words).groupBy("doc_id").agg(F.max("items").alias("items")))
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b")


def _mixed(buckets: DataFrame) -> DataFrame:
    """The rows of buckets that have members in several components, with the members' count."""
    mixed = buckets.groupBy("band", "key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("size")).where("r0 <> r1")
    return buckets.join(mixed.select("band", "key", "size"), ["band", "key"])


def _cross_pairs(rows: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int, best: bool) -> DataFrame:
    """(a, b) from buckets with several components: compared in pairs of blocks, all but those within the largest.

    With `best`, only each member's most similar partner of a block."""
    per = rows.groupBy("band", "key", "root").agg(F.count("*").alias("m"))
    main = per.groupBy("band", "key").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("m"))
    main = main.select("band", "key", F.col("top.root").alias("main"), F.ceil(F.col("top.m") / BLOCK).cast("int").alias("n_main"), F.ceil((F.col("m") - F.col("top.m")) / BLOCK).cast("int").alias("n_rest"))
    rows = rows.join(main, ["band", "key"]).withColumn("is_main", F.col("root") == F.col("main"))
    block = F.pmod(F.xxhash64("rep"), F.when(F.col("is_main"), F.col("n_main")).otherwise(F.col("n_rest"))).cast("int")
    rows = rows.withColumn("block", block)
    rows = rows.join(sigs, "rep").join(sets, "rep", "left").withColumn("items", F.when(F.col("size") > MANY, F.col("items")))
    # pairs of blocks: (rest i, rest j), i <= j, and (rest i, main j)
    mates = F.when(F.col("is_main"), F.expr("transform(sequence(0, n_rest - 1), i -> struct(i as i, -1 - block as j))")).otherwise(
        F.concat(F.expr("transform(sequence(0, n_rest - 1), i -> struct(least(i, block) as i, greatest(i, block) as j))"), F.expr("transform(sequence(0, n_main - 1), j -> struct(block as i, -1 - j as j))"))
    )
    dealt = rows.select("band", "key", "rep", "root", "sig", "bands", "items", F.explode(mates).alias("g")).select("band", "key", "g.i", "g.j", "rep", "root", "sig", "bands", "items")

    def compare(band: int, rep, root, sig, bands, items) -> list[tuple[np.ndarray, np.ndarray]]:
        out, shared = [], Shared(items) if any(x is not None for x in items) else None
        for x in range(len(rep) - 1):
            y = np.flatnonzero(root[x + 1 :] != root[x]) + x + 1
            if band and len(y):  # compared in the first band that they share
                y = y[~(bands[y, :band] == bands[x, :band]).any(axis=1)]
            if len(y):
                near, matches = passing(np.broadcast_to(sig[x], (len(y), HASHES)), sig[y], percent)
                y = y[near]
                if shared and len(y):
                    may = shared.reaching(x, y, percent)
                    y, matches = y[may], matches[may]
                if best and len(y):
                    y = y[[matches.argmax()]]
                out.append((np.full(len(y), rep[x]), rep[y]))
        return out

    def run(batches):
        """Groups come one after another; one that a batch may not end waits for the next (2 * BLOCK rows or so at most)."""
        wait = None
        for batch in _and_none(batches):
            if batch is None:
                table = wait
            else:
                table = pa.Table.from_batches([batch]) if wait is None else pa.concat_tables([wait, pa.Table.from_batches([batch])])
            if table is None or not table.num_rows:
                continue
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("band", "key", "i", "j")])
            cuts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])
            end = table.num_rows if batch is None else int(cuts[-1])
            wait = table.slice(end)
            rep, root = (table.column(c).to_numpy()[:end] for c in ("rep", "root"))
            head = table.slice(0, end)
            sig = np.frombuffer(b"".join(head.column("sig").to_pylist()), "<u4").reshape(-1, HASHES)
            items = head.column("items").to_pylist()
            bands = head.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
            out = []
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), table.num_rows], strict=True):
                if e <= end:
                    out += compare(int(keys[0, s]), rep[s:e], root[s:e], sig[s:e], bands[s:e], items[s:e])
            a, b = (np.concatenate([z[k] for z in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])

    by = ["band", "key", "i", "j"]
    return arrow_map(dealt.repartition(*by).sortWithinPartitions(*by), run, "a long, b long").distinct()


def _and_none(items):
    yield from items
    yield None


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id that links reach), kept, for each row of docs."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = staged(_signed(source, words))
    filled = signed.where("doc_id is not null and n_shingles > 0")
    set_of = F.struct("k1", "k2")
    if not filled.groupBy("doc_id").agg(F.min(set_of).alias("lo"), F.max(set_of).alias("hi")).where("lo <> hi").isEmpty():
        return _by_text(source, words, percent)
    classes = staged(filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")))
    reps = filled.join(classes.withColumnRenamed("rep", "doc_id"), ["k1", "k2", "doc_id"]).dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("rep"), "sig", "bands")
    keys = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    heads = keys.groupBy("band", "key").agg(F.min("rep").alias("head"), F.count("*").alias("m")).where("m > 1").drop("m")
    members = staged(keys.join(heads, ["band", "key"]))
    # 1. each member with the head of its bucket
    stars = members.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    touched = staged(members.select("rep").distinct())
    sigs = staged(reps.join(small(touched), "rep", "left_semi"))
    links = staged(_confirmed(staged(_pruned(stars, sigs, percent)), source, words, percent))
    roots = components(links)
    # 2. what is still apart within a bucket: by the most similar partners, which joins most, then all that is left
    sets = None
    for best in (True, False):
        rooted = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("band", "key", "rep", F.coalesce("root", "rep").alias("root"))
        rows = staged(_mixed(rooted))
        if sets is None:  # later rounds have no other mixed buckets
            many = staged(rows.where(F.col("size") > MANY).select(F.col("rep").alias("doc_id")).distinct())
            sets = staged(_short_sets(source.join(small(many), "doc_id", "left_semi"), words).groupBy("rep").agg(F.when(F.count("*") == 1, F.max("items")).alias("items")))
        more = staged(_cross_pairs(rows, sigs, sets, percent, best))
        if more.isEmpty():
            break
        links = staged(links.union(_confirmed(more.join(stars, ["a", "b"], "left_anti"), source, words, percent)))
        roots = components(links)
    own = signed.join(classes, ["k1", "k2"], "left").select("doc_id", "n_shingles", "rep")
    found = own.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    component = F.coalesce("root", "rep", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _by_text(source: DataFrame, words: int, percent: int) -> DataFrame:
    """near_duplicates where an id has several different texts: each text is compared under a key of its own, then those of one id are linked."""
    texts = source.withColumn("t", F.sha2(F.coalesce("text", F.lit("")), 256))
    keyed = staged(texts.where("doc_id is not null").select("doc_id", "t").distinct().withColumn("key", F.monotonically_increasing_id()))
    rows = texts.join(keyed, ["doc_id", "t"], "left")
    found = staged(near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"), words, percent).distinct()).withColumnRenamed("doc_id", "key")
    filled = found.where("key is not null and n_shingles > 0").join(keyed, "key")
    own = filled.withColumn("a", F.min("key").over(Window.partitionBy("doc_id"))).select("a", F.col("key").alias("b"))
    roots = components(filled.select(F.col("component_id").alias("a"), F.col("key").alias("b")).union(own))
    roots = filled.select("key", "doc_id").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = roots.groupBy("root").agg(F.min("doc_id").alias("least"))
    named = roots.join(least, "root").select("key", "least")
    sizes = found.select("key", "n_shingles")
    out = rows.select("doc_id", "key").join(named, "key", "left")
    both = out.where("key is not null").join(sizes.where("key is not null"), "key").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
    none = _signed(source.where("doc_id is null"), words).select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return both.unionByName(none).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Query: three-word shingles, similarity of 0.85 or more, all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=85)
