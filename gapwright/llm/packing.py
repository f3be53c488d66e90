"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Documents are encoded once; one longer than a sequence is cut into full pieces from its end, so that
only its first piece may be shorter. Pieces are dealt by hash to pools of about `pool_docs` documents;
each pool fills one bin after another greedily (largest piece that fits), then replaces the bin's
smallest piece by the two unpacked pieces that fill its expanded gap most tightly, until that gains
nothing. Full pieces need no packing. A pool holds its short pieces only, so memory is bounded by
pool_docs sequences; a pool's loss is at most its last bins.

Nulls: a null text is an empty document (its end id alone); a null id is kept. Repeated rows are packed
as often as they occur. Ties go to the piece first by (id, piece). An empty table gives no rows. Other
columns are not read, so their names cannot clash."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, slices
from .tokens import default_path, encoder

PIECES = "doc_id long, piece int, start long, length long, ids binary"
PACKED = PIECES + ", sequence_id long, offset long"


def best_two_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (all within 1..room)."""
    left = np.bincount(lengths, minlength=room + 1).tolist()
    sizes = [s for s in range(1, room + 1) if left[s]]
    queue: dict[int, list[int]] = {}
    for i in np.argsort(lengths, kind="stable")[::-1].tolist():
        queue.setdefault(int(lengths[i]), []).append(i)

    def take(s: int) -> None:
        left[s] -= 1
        if not left[s]:
            del sizes[bisect_right(sizes, s) - 1]

    def give(s: int) -> None:
        left[s] += 1
        if left[s] == 1:
            sizes.insert(bisect_right(sizes, s), s)

    def pair(most: int, least: int) -> tuple[int, int] | None:
        """The two unpacked sizes of the largest sum in (least, most]."""
        have = np.array(sizes[: bisect_right(sizes, most - 1)])
        if not len(have):
            return None
        at = np.searchsorted(have, np.minimum(most - have, have), side="right") - 1
        other = have[np.maximum(at, 0)]
        single = np.array([left[s] == 1 for s in have.tolist()]) & (other == have)
        other = np.where(single, have[np.maximum(at - 1, 0)], other)
        total = np.where((at < 0) | (single & (at < 1)), 0, have + other)
        best = int(total.argmax())
        return (int(have[best]), int(other[best])) if total[best] > least else None

    bins, offsets, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    while sizes:
        gap, held = room, []
        while (k := bisect_right(sizes, gap)) and gap:
            s = sizes[k - 1]
            take(s)
            held.append(s)
            gap -= s
        while gap and sizes and (two := pair(gap + min(held), min(held))):
            small = min(held)
            held.remove(small)
            for s in two:
                take(s)
            held += two
            give(small)
            gap += small - sum(two)
        at = 0
        for s in held:
            i = queue[s].pop()
            bins[i], offsets[i] = n, at
            at += s
        n += 1
    return bins, offsets


def tokenised_pieces(docs: DataFrame, tokenizer: str, room: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece, start (its document's ids before it), length, ids (little-endian uint32)."""

    def run(batches):
        enc = encoder(tokenizer)
        for part in slices(batches):
            ids, at = enc.encode([x or "" for x in part.column("text").to_pylist()])
            rows: list[tuple] = []
            for key, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = np.append(ids[a:b], np.array([end_id], ids.dtype)).astype("<u4")
                cut = len(own) % room or room
                for k, s in enumerate([0, *range(cut, len(own), room)]):
                    e = cut if not s else s + room
                    rows.append((key, k, s, e - s, own[s:e].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "piece", "start", "length", "ids"])

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, room: int = 1024, end_id: int = 2, pool_docs: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence_id and offset."""
    pools = max(1, -(-docs.count() // pool_docs))
    pieces = tokenised_pieces(docs, tokenizer or default_path(), room, end_id, id_col, text_col)
    dealt = pieces.repartition(pools, F.xxhash64("doc_id", "piece", "ids")).sortWithinPartitions("doc_id", "piece", "ids")

    def run(batches):
        n, held = TaskContext.get().partitionId() << 40, []

        def out(batch, seq, off):
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(seq, pa.int64()), pa.array(off, pa.int64())], names=[*batch.schema.names, "sequence_id", "offset"])

        for batch in batches:
            full = pc.equal(batch.column("length"), room)
            whole = batch.filter(full)
            if whole.num_rows:
                yield out(whole, n + np.arange(whole.num_rows), np.zeros(whole.num_rows, np.int64))
                n += whole.num_rows
            held.append(batch.filter(pc.invert(full)))
        held = [x for x in held if x.num_rows]
        if held:
            bins, offsets = best_two_fit(np.concatenate([x.column("length").to_numpy() for x in held]), room)
            at = 0
            for x in held:
                yield out(x, n + bins[at : at + x.num_rows], offsets[at : at + x.num_rows])
                at += x.num_rows

    return arrow_map(dealt, run, PACKED)


def op3_best_two_fit(spark, sf_dir: str) -> DataFrame:
    """Query: every piece of every document with the place it was packed to."""
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
