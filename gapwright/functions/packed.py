"""Arrays of bases inside tasks: runs of a letter, tandem units, packed k-mers and minimizers of whole Arrow batches at once."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: 2-bit codes of bases, so that packed words sort like text; 4 for all else.
CODE = np.full(256, 4, np.uint8)
for _k, _b in enumerate(b"ACGT"):
    CODE[_b] = CODE[_b + 32] = _k


#: Bytes of a batch that a task's arrays are made of at a time (they take some ten longs a base).
SLICE = 2 << 20


def importable(spark: SparkSession) -> None:
    """Have the workers import this package also if the driver found it outside their path."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def sliced(batches, size: int = SLICE):
    """The batches' rows in batches of about `size` bytes, one row at least: a batch of Spark's has up to 10,000 rows of any length."""
    for batch in batches:
        step = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for at in range(0, max(batch.num_rows, 1), step):
            yield batch.slice(at, step)


def arrow_map(df: DataFrame, f, schema: str) -> DataFrame:
    """df.mapInArrow over slices of batches, on workers that can import this package."""
    importable(df.sparkSession)
    return df.mapInArrow(lambda batches: f(sliced(batches)), schema)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end, and where each row's begin (and the end)."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[at[0] : at[-1]], at - at[0]


def runs(mask: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True, cut where a row begins."""
    if not len(mask):
        z = np.zeros(0, np.int64)
        return z, z
    first = np.zeros(len(mask) + 1, bool)
    first[at] = True
    begin = mask.copy()
    begin[1:] &= ~mask[:-1] | first[1:-1]
    end = mask.copy()
    end[:-1] &= ~mask[1:] | first[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def occurrences(buf: np.ndarray, unit: bytes) -> np.ndarray:
    """Where a unit stands in the buffer."""
    n = len(buf) - len(unit) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hit = buf[:n] == unit[0]
    for k in range(1, len(unit)):
        hit &= buf[k : n + k] == unit[k]
    return np.flatnonzero(hit)


def words(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed words of k bases at every place (2 bits a base), their reverse complements, and which are free of other letters."""
    n = max(0, len(codes) - k + 1)
    ahead, back, bad = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    for i in range(k):
        c = codes[i : n + i].astype(np.int64)
        bad |= c > 3
        ahead = ahead << 2 | c & 3
        back |= (3 - (c & 3)) << 2 * i
    return ahead, back, ~bad


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them (nonnegative: the upper 63 bits)."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        for shift, by in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)


def window_least(x: np.ndarray, size: int) -> np.ndarray:
    """Least of each `size` consecutive values, by doubling."""
    out, done = x, 1
    while done < size:
        step = min(done, size - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def minimizers(codes: np.ndarray, k: int, m: int, both: bool = True) -> np.ndarray:
    """At every place the least scattered m-mer within the word of k bases; of both strands alike if `both`."""
    ahead, back, good = words(codes, m)
    value = mixed(np.minimum(ahead, back) if both else ahead)
    value[~good] = np.iinfo(np.int64).max
    return window_least(value, k - m + 1) if len(value) >= k - m + 1 else value[:0]


def packed(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[bytes]:
    """Stretches of bases at four a byte, after a byte that says how many stand in the last."""
    out = []
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        c = np.zeros(-(-(b - a) // 4) * 4, np.uint8)
        c[: b - a] = codes[a:b]
        c = c.reshape(-1, 4)
        out.append(bytes([(b - a) % 4]) + (c[:, 0] << 6 | c[:, 1] << 4 | c[:, 2] << 2 | c[:, 3]).tobytes())
    return out


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of packed stretches end to end, and where each begins (and the end)."""
    buf, at = texts(column)
    if not len(buf):
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    rest = buf[at[:-1]].astype(np.int64)
    size = 4 * (np.diff(at) - 1) - np.where(rest, 4 - rest, 0)
    body = np.ones(len(buf), bool)
    body[at[:-1]] = False
    c = buf[body]
    full = np.stack([c >> 6, c >> 4 & 3, c >> 2 & 3, c & 3], axis=1).ravel()
    room = 4 * (np.diff(at) - 1)
    ends = np.cumsum(size)
    keep = np.arange(len(full)) - np.repeat(np.cumsum(room) - room, room) < np.repeat(size, room)
    return full[keep], np.concatenate([[0], ends])
