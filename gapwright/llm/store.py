"""Content-addressed store of token-id streams.

Documents are dealt by ranges of their id and sorted (nulls first, ties in input order); a task encodes its range in that
order, appends the end id to each and cuts the stream where a rolling hash of its last 16 ids meets a mask (64 to 2048 ids,
about 512). `row` counts the documents in that order. A chunk is named by the BLAKE2b hash of its bytes and stored once, in
the pack of the first row that has it. Files below the root, all Parquet, parts in ascending order and rows ascending in each:

  packs      part, row, wide, hashes, lens, at, payload: a document's chunk names in order, their ids, where the payload
             holds them (null: another row's pack does), and those chunks' little-endian ids one after another
  recipes    part, doc_id, row, start, n_tokens, root: start = ids of all documents before it, root = Merkle root of the names
  manifests  part, n_docs, n_tokens, root: Merkle root of each recipe part's document roots

Reading takes own chunks from the row itself and looks up by name only those of other packs, hashes every
chunk again and compares the Merkle roots.

Nulls: a null text is an empty document (its end id alone); a null id comes first. Repeated rows and rows of one id are
documents of their own that share their chunks. A very long text is encoded alone and is one row (2 GB of ids at most); its
chunks are bounded. An empty table gives an empty store. Other columns are not read, so their names cannot clash."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import arrow_map, shared_dir, slices, small, staged
from .tokens import default_path, encoder

WINDOW, MASK_BITS, LEAST, MOST = 16, 9, 64, 2048
_MUL = np.uint64(0x9E3779B97F4A7C15)


def marks_of(ids: np.ndarray) -> np.ndarray:
    """Where the hash of the last WINDOW ids meets the mask (the first WINDOW - 1 places say nothing)."""
    value = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    h = np.zeros(len(ids), np.uint64)
    for k in range(min(WINDOW, len(ids)) - 1, -1, -1):
        h *= _MUL
        h[k:] += value[: len(ids) - k]
    return np.flatnonzero(h >> np.uint64(64 - MASK_BITS) == 0) + 1


def ends_of(marks: list[int], begin: int, end: int) -> list[int]:
    """Ends of the chunks of the stream from begin to end; chunks of LEAST ids or more keep windows within the stream."""
    ends, last = [], begin
    for m in [*marks, end]:
        while m - last > MOST:
            last += MOST
            ends.append(last)
        if m - last >= LEAST or m == end and m > last:
            last = m
            ends.append(m)
    return ends


def cut_points(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream, by content."""
    return ends_of(marks_of(ids).tolist(), 0, len(ids))


def name_of(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle(names: list[bytes]) -> bytes:
    """Root of a binary Merkle tree; an odd last node goes up as it is."""
    if not names:
        return name_of(b"")
    level = list(names)
    while len(level) > 1:
        level = [name_of(b"".join(level[i : i + 2])) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


PACKS = "part int, row long, wide int, hashes array<binary>, lens array<int>, at array<int>, payload binary"
RECIPES = "part int, doc_id long, row long, start long, n_tokens long, root binary"
_ENCODED = "part int, row long, doc_id long, before long, n_tokens long, root binary, hashes array<binary>, lens array<int>, repeated boolean, wide int, ids binary"


def _lists(values: pa.Array, counts: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _cut(data: bytes, ends: np.ndarray) -> pa.Array:
    """A binary column of consecutive parts of data."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    fields = [x.split()[0] for x in _ENCODED.split(", ")]

    def run(batches):
        enc, number, n, before = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        for part in slices(batches):
            ids, at = enc.encode([x or "" for x in part.column("text").to_pylist()])
            own, at = np.insert(ids, at[1:], end_id), at + np.arange(len(at))
            marks, data, wide = marks_of(own), memoryview(own.tobytes()), own.itemsize
            per = np.searchsorted(marks, at, side="right").tolist()
            marks, names, lens, counts, roots, repeated = marks.tolist(), [], [], [], [], []
            for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                last, mine = a, []
                for e in ends_of(marks[per[k] : per[k + 1]], a, b):
                    mine.append(name_of(data[last * wide : e * wide]))
                    lens.append(e - last)
                    last = e
                names += mine
                counts.append(len(mine))
                roots.append(merkle(mine))
                repeated.append(len(set(mine)) < len(mine))
            size = np.diff(at)
            rows = (number << 36) + n + np.arange(len(size))
            columns = [
                pa.array(np.full(len(size), number, np.int32)), pa.array(rows, pa.int64()), part.column("doc_id"), pa.array(before + at[:-1] - at[0], pa.int64()), pa.array(size, pa.int64()),
                pa.array(roots, pa.binary()), _lists(_cut(b"".join(names), 16 * np.arange(1, len(names) + 1)), counts), _lists(pa.array(lens, pa.int32()), counts), pa.array(repeated), pa.array(np.full(len(size), wide, np.int32)), _cut(data, at[1:] * wide),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=fields)
            n, before = n + len(size), before + len(own)

    return arrow_map(docs, run, _ENCODED)


def _packs(rows: DataFrame) -> DataFrame:
    """Keep of each row the chunks that it stores; `lent` has the places of those that other packs have."""
    fields = [x.split()[0] for x in PACKS.split(", ")]

    def run(batches):
        for part in slices(batches, "ids"):
            lens, counts = part.column("lens").flatten().to_numpy(), np.diff(part.column("lens").offsets.to_numpy()).tolist()
            first = np.cumsum([0, *counts])
            mixed = [k for k, (lent, again) in enumerate(zip(part.column("lent").to_pylist(), part.column("repeated").to_pylist(), strict=True)) if lent or again]
            mine = np.ones(len(lens), bool)
            for k in mixed:
                names = part.column("hashes")[k].as_py()
                lent, seen = set(part.column("lent")[k].as_py() or ()), set()
                for i, name in enumerate(names):
                    mine[first[k] + i] = i not in lent and name not in seen
                    seen.add(name)
            kept = np.where(mine, lens, 0)
            done = np.concatenate([[0], np.cumsum(kept)])
            at = done[:-1] - np.repeat(done[first[:-1]], counts)
            payload, ids, wide = part.column("ids"), part.column("ids"), part.column("wide").to_pylist()
            if mixed:
                data = ids.to_pylist()
                for k in mixed:
                    ends = np.cumsum(lens[first[k] : first[k + 1]]).tolist()
                    own = mine[first[k] : first[k + 1]].tolist()
                    data[k] = b"".join(data[k][(e - int(n)) * wide[k] : e * wide[k]] for e, n, o in zip(ends, lens[first[k] : first[k + 1]], own, strict=True) if o)
                payload = pa.array(data, pa.binary())
            places = pa.array(at, pa.int32(), mask=~mine)
            yield pa.RecordBatch.from_arrays([part.column("part"), part.column("row"), part.column("wide"), part.column("hashes"), part.column("lens"), _lists(places, counts), payload], names=fields)

    return arrow_map(rows, run, PACKS)


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _manifests(recipes: DataFrame) -> DataFrame:
    """A row for each part of the recipes, which come sorted within their file."""

    def run(batches):
        part, stack, docs, tokens = None, [], 0, 0

        def done():
            return _batch([(part, docs, tokens, merkle(stack))], [pa.int32(), pa.int64(), pa.int64(), pa.binary()], ["part", "n_docs", "n_tokens", "root"])

        for batch in batches:
            for r in batch.to_pylist():
                if part is not None and r["part"] != part:
                    yield done()
                    stack, docs, tokens = [], 0, 0
                part, docs, tokens = r["part"], docs + 1, tokens + r["n_tokens"]
                stack.append(r["root"])
        if part is not None:
            yield done()

    dealt = recipes.repartition(F.col("part")).sortWithinPartitions("part", "row")
    return arrow_map(dealt.select("part", "n_tokens", "root"), run, "part int, n_docs long, n_tokens long, root binary")


def write_store(docs: DataFrame, root: str, tokenizer: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all documents and write the store below root."""
    # ties keep the input's order, which also splits an id that many rows share
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("seq"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("seq")]
    rows = staged(_encoded(source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"), tokenizer or default_path(), end_id))
    chunks = rows.select("row", F.posexplode("hashes").alias("k", "name"))
    shared = chunks.groupBy("name").agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first <> last").select("name", "first")
    shared = staged(shared)
    lent = chunks.join(small(shared), "name").where("row <> first").groupBy("row").agg(F.collect_list("k").alias("lent"))
    lent = staged(lent)
    # a document's own chunks never move where the places of the few that others store can be broadcast
    joined = rows.select("part", "row", "wide", "hashes", "lens", "repeated", "ids").join(small(lent), "row", "left").select("part", "row", "wide", "hashes", "lens", "repeated", "lent", "ids")
    _packs(joined).sortWithinPartitions("part", "row").write.option("compression", "zstd").partitionBy("part").parquet(f"{root}/packs")
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each part
    base = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    recipes = rows.select("part", "doc_id", "row", "before", "n_tokens", "root").join(F.broadcast(base), "part")
    recipes.select("part", "doc_id", "row", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "root").sortWithinPartitions("part", "row").write.partitionBy("part").parquet(f"{root}/recipes")
    _manifests(docs.sparkSession.read.schema(RECIPES).parquet(f"{root}/recipes")).write.parquet(f"{root}/manifests")


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """Every document's ids from the packs: row, n_tokens, ids (little-endian uint32), root; raises on a chunk whose bytes don't fit its name."""
    packs = spark.read.schema(PACKS).parquet(f"{root}/packs")
    # the names that a row needs and doesn't store (a chunk repeated within a row is in that row)
    need = packs.select("row", F.explode(F.array_distinct(F.expr("filter(hashes, (x, i) -> at[i] is null)"))).alias("name"), F.expr("filter(hashes, (x, i) -> at[i] is not null)").alias("mine"))
    need = staged(need.where("not array_contains(mine, name)").select("row", "name"))
    names = staged(need.select("name").distinct())
    borrowers = staged(need.groupBy("row").agg(F.count("*").alias("n_lent")))
    offered = packs.select("wide", "payload", F.explode(F.arrays_zip("hashes", "lens", "at")).alias("c")).where("c.at is not null").select(F.col("c.hashes").alias("name"), F.expr("substring(payload, c.at * wide + 1, c.lens * wide)").alias("data"))
    offered = offered.join(small(names), "name", "left_semi")
    lent = need.join(offered, "name").groupBy("row").agg(F.collect_list(F.struct("name", "data")).alias("lent"))
    alone = packs.join(small(borrowers), "row", "left_anti").withColumn("lent", F.lit(None).cast("array<struct<name:binary,data:binary>>"))
    rows = alone.unionByName(packs.join(small(borrowers), "row", "left_semi").join(lent, "row")).select("row", "wide", "hashes", "lens", "at", "payload", "lent")

    def run(batches):
        for part in slices(batches, "payload"):
            read, sizes, roots = [], [], []
            for row, wide, hashes, lens, at, payload, lent in zip(*(part.column(c).to_pylist() for c in ("row", "wide", "hashes", "lens", "at", "payload", "lent")), strict=True):
                have, data, held = {x["name"]: x["data"] for x in lent or ()}, [], memoryview(payload)
                for name, n, a in zip(hashes, lens, at, strict=True):
                    if a is not None:
                        have[name] = held[a * wide : (a + n) * wide]
                    if name_of(have[name]) != name:
                        raise ValueError(f"row {row}: a chunk's bytes don't fit its name")
                    data.append(have[name])
                read.append(np.frombuffer(b"".join(data), f"<u{wide}").astype("<u4"))
                sizes.append(len(read[-1]))
                roots.append(merkle(hashes))
            ids = np.concatenate(read).tobytes()
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(sizes, pa.int64()), _cut(ids, 4 * np.cumsum(sizes)), pa.array(roots, pa.binary())], names=["row", "n_read", "ids", "read_root"])

    return arrow_map(rows, run, "row long, n_read long, ids binary, read_root binary")


def verified(spark: SparkSession, root: str) -> DataFrame:
    """Recipe parts whose manifest differs from the Merkle root of their recipes: no rows if all is well."""
    kept = spark.read.parquet(f"{root}/manifests").withColumnRenamed("root", "kept")
    now = _manifests(spark.read.schema(RECIPES).parquet(f"{root}/recipes")).select("part", F.col("root").alias("now"))
    return kept.join(now, "part", "full").where("not (kept <=> now)")


def op7_token_store(spark, sf_dir: str) -> DataFrame:
    """Query: write the store of all documents, read it back, and return what the files hold."""
    root = shared_dir(spark)
    write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), root)
    if not verified(spark, root).isEmpty():
        raise ValueError("a manifest doesn't fit its recipes")
    read = read_store(spark, root).select("row", "n_read", "read_root", F.crc32("ids").alias("ids_crc32"))
    got = spark.read.schema(RECIPES).parquet(f"{root}/recipes").join(read, "row")
    fits = (F.col("root") == F.col("read_root")) & (F.col("n_tokens") == F.col("n_read"))
    return got.select("doc_id", "start", "n_tokens", F.when(fits, F.col("ids_crc32")).otherwise(F.raise_error(F.lit("a document doesn't fit its recipe"))).alias("ids_crc32"))
