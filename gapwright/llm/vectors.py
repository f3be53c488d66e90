"""Product codes of vectors, with codebooks learnt exactly on integers.

Components become integers. Every part of every vector gets the Hilbert index of its cell; the parts are dealt by ranges of
(position, index, row) and sorted, so that equal parts of a hot group fall into many tasks, and `block` neighbours at a time make
a flat block with the box that bounds them (least and largest components) and their sum. A round sends the codebooks (parts x entries
x components, a fixed size) to every task and compares boxes with entries: an entry whose least distance to the box is more than the
largest distance of another can't be the nearest of any part there, so the others are the block's shortlist. Where it has
one entry, the block's stored sum goes to it as a whole; otherwise an integer kernel evaluates the block's parts against the shortlist.
Tasks give one sum an entry, which are added by grouping; the driver divides parts x entries sums.

All is exact: components are at most 2**26 in size once they are integers (larger ones raise an error), so distances and
sums fit in a long, and neither blocks nor partitions change the result.

Nulls: vectors that are null or hold null or non-finite components are dropped; ids and labels may be null (null ids last, null
labels together). Vectors not as long as most are (of equally many, the longer; a multiple of the parts) can't be
cut alike and are dropped. Ties: the lower entry; of rows of one id the smaller vector goes first. Repeated rows each get their code. Fewer rows than entries: that
many entries. A very long vector is cut like any other (a Hilbert cell then has one bit for each of its first components). An empty
table gives an empty result. Other columns pass through in `row` whatever their names."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_map, small, staged

#: Largest size of an integer component: squares of differences, times 256 components, stay below 2**63.
LARGEST = 1 << 26
#: Block rows that are compared with the codebook at once.
STEP = 64


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of cells (rows; a coordinate of `bits` bits a column) along the Hilbert curve, by Gray-code transposition."""
    x = cells.T.astype(np.int64)
    n = len(x)
    for b in range(bits - 1, 0, -1):
        one, low = 1 << b, (1 << b) - 1
        for i in range(n):
            hit = x[i] & one != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(hit, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        turn = np.where(x[n - 1] & (1 << b), turn ^ ((1 << b) - 1), turn)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> b & 1
    return key


def box_distances(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distances of boxes (rows) to the entries of a codebook (columns)."""
    below, above = lo[:, None, :] - book[None], book[None] - hi[:, None, :]
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    return (near * near).sum(axis=2), (far * far).sum(axis=2)


def shortlists(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Which entries can be the nearest of a part in each box."""
    near, far = box_distances(lo, hi, book)
    return near <= far.min(axis=1)[:, None]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each part (row) the first of its nearest entries, and the squared distance."""
    inner = (book * book).sum(axis=1)[None, :] - 2 * (parts @ book.T)
    best = inner.argmin(axis=1)
    return best, inner[np.arange(len(parts)), best] + (parts * parts).sum(axis=1)


def _binary(values: list) -> pa.Array:
    return pa.array([np.ascontiguousarray(x).tobytes() for x in values], pa.binary())


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Kept rows (a staged table): seq, id, row (the other columns), dims, and floor(scale * component) as little-endian ints."""
    rest = [F.col(f"`{c}`") for c in vectors.columns if c != vector_col]
    given = vectors.select(F.monotonically_increasing_id().alias("seq"), F.col(id_col).cast("long").alias("id"), F.struct(*rest).alias("row"), F.col(vector_col).cast("array<double>").alias("vector"))
    schema = T.StructType([*(given.schema[c] for c in ("seq", "id", "row")), T.StructField("dims", T.IntegerType()), T.StructField("ints", T.BinaryType())])

    def run(batches):
        for part in batches:
            column = part.column("vector")
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            flat = pc.fill_null(column.flatten(), float("nan")).to_numpy()
            ends = np.concatenate([[0], np.cumsum(size)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            kept = np.flatnonzero((bad[ends[1:]] == bad[ends[:-1]]) & (size > 0))
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(flat * scale)
            for a, b in zip(ends[kept], ends[kept + 1], strict=True):
                if np.abs(whole[a:b]).max() > LARGEST:
                    raise ValueError(f"a component is more than {LARGEST} / {scale} in size, so its distances may not fit in a long")
            rows = part.take(pa.array(kept))
            ints = _binary([whole[a:b].astype("<i4") for a, b in zip(ends[kept], ends[kept + 1], strict=True)])
            yield pa.RecordBatch.from_arrays([rows.column("seq"), rows.column("id"), rows.column("row"), pa.array(size[kept], pa.int32()), ints], names=schema.names)

    return staged(arrow_map(given, run, schema))


def _spread(base: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each component over all rows (they only shape the cells)."""

    def run(batches):
        n, total, square = 0, np.zeros(dims), np.zeros(dims)
        for part in batches:
            x = np.frombuffer(b"".join(part.column("ints").to_pylist()), "<i4").reshape(-1, dims).astype(float)
            n, total, square = n + len(x), total + x.sum(axis=0), square + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(dims, n)), pa.array(np.arange(dims, dtype=np.int32)), pa.array(total), pa.array(square)], names=["n", "k", "total", "square"])

    summed = arrow_map(base.select("ints"), run, "n long, k int, total double, square double").groupBy("k").agg(*(F.sum(c).alias(c) for c in ("n", "total", "square")))
    got = np.array([(r.n, r.total, r.square) for r in summed.orderBy("k").collect()]).T  # a row a component
    mean = got[1] / got[0]
    return mean, np.sqrt(np.maximum(got[2] / got[0] - mean * mean, 0))


BLOCKS = "part int, seqs binary, flat binary, lo binary, hi binary, sums binary"


def blocks_of(base: DataFrame, dims: int, parts: int, block: int) -> DataFrame:
    """Flat blocks of Hilbert neighbours (a staged table): rows, parts, box and sum of each."""
    width = dims // parts
    used = min(width, 63)
    bits = max(1, min(8, 63 // used))
    mean, spread = _spread(base, dims)
    low, step = mean - 2 * spread, np.where(spread > 0, 4 * spread, 1) / (1 << bits)

    def keyed(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("ints").to_pylist()), "<i4").reshape(-1, dims)
            cells = np.clip(np.floor((x - low) / step), 0, (1 << bits) - 1).astype(np.int64)
            for p in range(parts):
                own = slice(p * width, (p + 1) * width)
                key = hilbert(cells[:, own][:, :used], bits)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), pa.array(key), batch.column("seq"), _binary(list(x[:, own]))], names=["part", "key", "seq", "ints"])

    def cut(batches):
        for batch in batches:
            part, seq = (batch.column(c).to_numpy() for c in ("part", "seq"))
            x = np.frombuffer(b"".join(batch.column("ints").to_pylist()), "<i4").reshape(-1, width)
            edges = np.flatnonzero(np.diff(part, prepend=-1))
            at = np.concatenate([np.arange(a, b, block) for a, b in zip(edges, [*edges[1:], len(part)], strict=True)])
            ends = np.append(at[1:], len(part))
            lo, hi = np.minimum.reduceat(x, at, axis=0), np.maximum.reduceat(x, at, axis=0)
            sums = np.add.reduceat(x.astype("<i8"), at, axis=0)
            spans = list(zip(at.tolist(), ends.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(part[at], pa.int32()), _binary([seq[a:b].astype("<i8") for a, b in spans]), _binary([x[a:b] for a, b in spans]), _binary(list(lo)), _binary(list(hi)), _binary(list(sums))], names=["part", "seqs", "flat", "lo", "hi", "sums"])

    rows = arrow_map(base.select("seq", "ints"), keyed, "part int, key long, seq long, ints binary")
    return staged(arrow_map(rows.repartitionByRange("part", "key", "seq").sortWithinPartitions("part", "key", "seq"), cut, BLOCKS))


def _evaluated(batch, books: np.ndarray):
    """For each run of blocks of one position: (position, lines, parts of each line, shortlists)."""
    width = books.shape[2]
    position = batch.column("part").to_numpy()
    lo, hi = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i4").reshape(-1, width).astype(np.int64) for c in ("lo", "hi"))
    flat = batch.column("flat")
    for p in np.unique(position).tolist():
        own = np.flatnonzero(position == p)
        for k in range(0, len(own), STEP):
            lines = own[k : k + STEP]
            yield p, lines, [np.frombuffer(flat[i].as_py(), "<i4").reshape(-1, width).astype(np.int64) for i in lines.tolist()], shortlists(lo[lines], hi[lines], books[p])


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round of assignment and replacement."""
    parts, entries, width = books.shape

    def run(batches):
        total, n = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            sums = np.frombuffer(b"".join(batch.column("sums").to_pylist()), "<i8").reshape(-1, width)
            for p, lines, held, short in _evaluated(batch, books):
                single = short.sum(axis=1) == 1
                for line, x, which, alone in zip(lines.tolist(), held, short, single.tolist(), strict=True):
                    listed = np.flatnonzero(which)
                    if alone:
                        total[p, listed[0]] += sums[line]
                        n[p, listed[0]] += len(x)
                    else:
                        best = listed[nearest(x, books[p][listed])[0]]
                        np.add.at(total[p], best, x)
                        n[p] += np.bincount(best, minlength=entries)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    found = arrow_map(blocks.drop("seqs"), run, "part int, entry int, n long, sums array<long>").groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[k]) for k in range(width))).alias("sums"))
    after = books.copy()
    for r in found.collect():  # parts x entries rows
        after[r.part, r.entry] = [x // r.n for x in r.sums]
    return after


def codebooks(base: DataFrame, blocks: DataFrame, dims: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (position, entry, component) after all rounds; they start from the rows of the smallest ids."""
    first = base.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    books = np.frombuffer(b"".join(r.ints for r in first), "<i4").reshape(len(first), parts, dims // parts).transpose(1, 0, 2).astype(np.int64)
    for _ in range(rounds):
        books = _round(blocks, books)
    return books


def assigned(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(seq, codes, error) of every row: its nearest entries in order of position, and the sum of the squared distances."""

    def run(batches):
        for batch in batches:
            seqs = batch.column("seqs")
            for p, lines, held, short in _evaluated(batch, books):
                codes, errors = [], []
                for x, which in zip(held, short, strict=True):
                    listed = np.flatnonzero(which)
                    best, far = nearest(x, books[p][listed])
                    codes.append(listed[best])
                    errors.append(far)
                seq = np.frombuffer(b"".join(seqs[i].as_py() for i in lines.tolist()), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(seq), pa.array(np.full(len(seq), p, np.int32)), pa.array(np.concatenate(codes), pa.int32()), pa.array(np.concatenate(errors))], names=["seq", "part", "code", "error"])

    found = arrow_map(blocks.select("part", "seqs", "flat", "lo", "hi"), run, "seq long, part int, code int, error long")
    codes = F.array(*(F.max(F.when(F.col("part") == p, F.col("code"))) for p in range(len(books))))
    return found.groupBy("seq").agg(codes.alias("codes"), F.sum("error").alias("error"))


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, block: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Kept rows of vectors as struct `row` (without the vector), with codes and error (squared distance, summed over parts); and the codebooks."""
    base = integers(vectors, id_col, vector_col, scale)
    sizes = base.where(F.col("dims") % parts == 0).groupBy("dims").count()
    most = sizes.orderBy(F.desc("count"), F.desc("dims")).first()
    dims = most.dims if most else parts
    base = base.where(F.col("dims") == dims)
    if most is None:
        return base.select("row", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 1), np.int64)
    blocks = blocks_of(base, dims, parts, block)
    books = codebooks(base, blocks, dims, parts, entries, rounds)
    return base.select("seq", "row").join(assigned(blocks, books), "seq").select("row", "codes", "error"), books


def restored(coded: DataFrame, books: np.ndarray, codes_col: str = "codes") -> DataFrame:
    """coded with `vector`: the integers that its codes stand for."""
    given = coded.select(F.struct("*").alias("row"), F.col(codes_col).cast("array<int>").alias("codes"))
    schema = T.StructType([given.schema["row"], T.StructField("vector", T.ArrayType(T.LongType()))])

    def run(batches):
        place = np.arange(len(books))
        for part in batches:
            codes = part.column("codes").flatten().to_numpy().reshape(-1, len(books))
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(list(books[place, codes].reshape(len(codes), -1)), pa.list_(pa.int64()))], names=["row", "vector"])

    return arrow_map(given, run, schema).select("row.*", "vector")


def books_text(books: np.ndarray) -> str:
    """All components by position, entry and place, joined by commas."""
    return ",".join(map(str, books.ravel().tolist()))


def op11_hilbert_blocks(spark, sf_dir: str) -> DataFrame:
    """Query: every kept vector's code, its error, the error of its label, and the codebooks' digest."""
    found, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding"))
    coded = staged(found.select("row.vec_id", "row.label", "codes", "error"))
    labels = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    code = F.array_join(F.transform("codes", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), "")
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    own = small(labels.withColumnRenamed("label", "of"))
    return coded.join(own, F.col("label").eqNullSafe(F.col("of")), "left").select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    return f"""
near{k} AS MATERIALIZED (
  SELECT v.seq, v.p, v.x, min_by(c.j, struct_pack(d := v.xx + c.cc - 2 * list_dot_product(v.x, c.x), j := c.j)) AS j,
         min(v.xx + c.cc - 2 * list_dot_product(v.x, c.x)) AS d
  FROM cut v JOIN book{k} c ON v.p = c.p GROUP BY v.seq, v.p, v.x)""" + (
        ""
        if k == 4
        else f""",
mean{k} AS MATERIALIZED (
  SELECT p, j, list(m ORDER BY i) AS x
  FROM (SELECT p, j, i, floor(sum(x[i]) / count(*)) AS m FROM near{k}, unnest(generate_series(1, 16)) g(i) GROUP BY p, j, i) t
  GROUP BY p, j),
book{k + 1} AS MATERIALIZED (
  SELECT p, j, x, list_dot_product(x, x) AS cc
  FROM (SELECT b.p, b.j, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.j = m.j) t),"""
    )


#: Doubles hold these integers exactly: components are below 2**22 in the given table.
OP11_SQL = (
    """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS seq, vec_id, label,
         list_transform(embedding, lambda x: floor(1024 * cast(x AS double))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT seq, p, x, list_dot_product(x, x) AS xx
  FROM (SELECT seq, p, v[16 * p + 1:16 * p + 16] AS x FROM kept, unnest(generate_series(0, 3)) g(p)) t),
book0 AS MATERIALIZED (SELECT p, seq - 1 AS j, x, xx AS cc FROM cut WHERE seq <= 256),"""
    + "".join(map(_round_sql, range(5)))
    + """,
digest AS (
  SELECT sha256(string_agg(cast(cast(x[i] AS bigint) AS varchar), ',' ORDER BY p, j, i)) AS codebooks_sha256
  FROM book4, unnest(generate_series(1, 16)) g(i)),
coded AS (
  SELECT seq, string_agg(lower(lpad(to_hex(cast(j AS bigint)), 2, '0')), '' ORDER BY p) AS code, cast(sum(d) AS bigint) AS error
  FROM near4 GROUP BY seq)
SELECT k.vec_id, c.code, c.error, cast(sum(c.error) OVER (PARTITION BY k.label) AS bigint) AS label_error, codebooks_sha256
FROM kept k JOIN coded c ON k.seq = c.seq, digest"""
)
