"""Helpers of the corpus operators: staged tables, sized joins, array hashing, components."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Word separators of every contract: space and 0x09-0x0D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RE = "[\\x20\\x09-\\x0D]+"
#: Bytes of a key table that may be broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 16 << 20
#: Text bytes that one vectorised step holds.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; below a temporary one where that is unset and all tasks run in this process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="gapwright-")
    return f"{base.rstrip('/')}/gapwright-{uuid.uuid4().hex}"


def staged(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _width(field: T.StructField) -> Column:
    """About the bytes that a column's value takes in memory."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType | T.StructType | T.MapType):
        return 2 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
    return F.lit(8)


def small(keys: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """keys (a staged table) with a broadcast hint if its measured bytes are few; else as it is, for a shuffle join."""
    width = sum((_width(f) for f in keys.schema.fields), F.lit(32))
    size = keys.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(keys) if size <= most else keys


def visible(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver found it outside their path."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def arrow_map(df: DataFrame, f, schema: str) -> DataFrame:
    """df.mapInArrow with this package importable on the workers, which give back their spare memory after each task."""
    visible(df.sparkSession)

    def run(batches):
        yield from f(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def slices(batches, column: str = "text", most: int = SLICE_BYTES):
    """Cut record batches so that each holds about `most` bytes of `column`; a longer text is alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, done + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each row's begin and end; null is empty."""
    values = [x.encode() if isinstance(x, str) else x or b"" for x in column.to_pylist()]
    ends = np.cumsum(np.fromiter((len(x) for x in values), np.int64, len(values)))
    return np.frombuffer(b"".join(values), np.uint8), np.concatenate([[0], ends])


# --- word and shingle hashes -------------------------------------------------

_P = 0x9E3779B97F4A7C15
_INV = pow(_P, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(p):
        x = np.full(n, p, np.uint64)
        x[0] = 1
        return np.multiply.accumulate(x)

    return run(_P), run(_INV)


@lru_cache(maxsize=2)
def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Blanks and ASCII punctuation.
PUNCTUATED = _BLANK.copy()
PUNCTUATED[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def words_of(buf: np.ndarray, at: np.ndarray, lower: bool = True, apart: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of concatenated texts: 64-bit hashes, starts, ends, and the first word's index of each text (and the end)."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z, np.zeros(len(at), np.int64)
    word = ~apart[buf]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = max(SLICE_BYTES * 2, 1 << int(n).bit_length())
    up, down = _powers(size)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values(lower)[buf] * up[:n], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts, ends, np.searchsorted(starts, at)


def running(words: np.ndarray):
    """f(n): Karp-Rabin hashes of all windows of n words, each from the one before (differences of prefix sums, modulo 2**64)."""
    up, down = _powers(max(SLICE_BYTES * 2, 1 << len(words).bit_length()))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
    return lambda n: (total[n:] - total[:-n]) * down[: max(0, len(words) - n + 1)]


def shingles_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n-word windows of one text; of the whole text if it is shorter; none without words."""
    if not len(words):
        return words
    n = min(n, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix(h * np.uint64(_P) + words[i : len(words) - n + 1 + i])
    return h


# --- components --------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of longs -> (node, root): root is the smallest node that can be reached (a staged table).

    Each round takes the least root among the neighbours and then follows the roots once (pointer
    jumping), so chains shorten geometrically; the labels are staged between rounds, until none changes."""
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    step = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("new"), F.col("node").alias("root")))
    while not step.where("new <> root").isEmpty():
        labels = step.select("node", F.col("new").alias("root"))
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        after = labels.join(near, "node").select("node", "root", F.least("root", "m").alias("next"))
        after = staged(after.join(jump, "next", "left").select("node", F.least("next", "far").alias("new"), "root"))
        dropped(step)
        step = after
    dropped(both)
    return step.select("node", F.col("new").alias("root"))
