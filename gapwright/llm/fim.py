"""Fill-in-middle by displacement scatter.

A task takes the texts of a batch as one byte buffer. A scan finds every token's first byte and with it the two cuts of each
text. Where a prefix, middle or suffix begins, a difference array gets by how much more its bytes move than those before;
its running sum is the shift of every byte, and one numpy scatter puts all of them into the batch's output. `restored`
finds the three sentinels of each output, builds the shifts back in the same way and gathers the text. Both walk the buffer
in blocks of `STEP` bytes, so that besides a text and its output only a block's arrays are held.

What a row draws comes from the SHA-256 of seed and id alone: it doesn't depend on partitions and survives lost executors.

Nulls: a null text is empty and so plain; a null id draws as an empty one. Rows of one id draw alike, and repeated rows give
repeated outputs; nothing is ordered, so there are no ties. A text that holds a sentinel stays plain. A very long text is alone in
its batch. An empty table gives none. Other columns pass through whatever their names; null bytes are ordinary characters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import _BLANK, arrow_map, buffer_of, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Bytes that one step of a scatter or gather moves.
STEP = 1 << 20


def token_starts(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First bytes of the tokens of concatenated texts: each text's first, and each blank after a character that is none."""
    first = np.zeros(len(buf), bool)
    blank = _BLANK[buf]
    first[1:] = blank[1:] & ~blank[:-1]
    first[at[:-1][at[:-1] < at[1:]]] = True
    return np.flatnonzero(first)


def moved(buf: np.ndarray, begins: np.ndarray, shifts: np.ndarray, out: np.ndarray, gather: bool = False) -> None:
    """Move bytes into out: byte i goes to i + shift (gather: comes from there). Segments begin at `begins` (ascending; of
    those that begin together the last holds) and move by `shifts`; the first begins at 0."""
    n = len(out) if gather else len(buf)
    change = np.diff(shifts, prepend=0)
    for lo in range(0, n, STEP):
        hi = min(n, lo + STEP)
        a, b = np.searchsorted(begins, (lo, hi))
        delta = np.zeros(hi - lo, np.int64)
        delta[0] = shifts[a - 1] if a else 0
        np.add.at(delta, begins[a:b] - lo, change[a:b])
        place = np.cumsum(delta) + np.arange(lo, hi)
        if gather:
            out[lo:hi] = buf[place]
        else:
            out[place] = buf[lo:hi]


def rearranged(buf: np.ndarray, at: np.ndarray, cuts: np.ndarray, spm: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outputs of concatenated texts and where each begins (and the end). cuts: first bytes of middle and suffix of each text."""
    size = np.diff(at)
    out_at = np.concatenate([[0], np.cumsum(size + np.where(plain, 0, sum(map(len, MARKS))))])
    a, b = cuts[:, 0], cuts[:, 1]
    prefix, middle, suffix = a - at[:-1], b - a, at[1:] - b
    base, w = out_at[:-1] - at[:-1], len(PREFIX)
    # by how much prefix, middle and suffix of each text move beyond its base
    by = np.stack([np.where(spm, 2 * w + suffix, w), 3 * w + suffix, np.where(spm, w - prefix - middle, 2 * w - middle)], axis=1)
    by[plain] = 0
    begins = np.stack([at[:-1], a, b], axis=1)
    out = np.empty(int(out_at[-1]), np.uint8)
    moved(buf, begins.ravel(), (by + base[:, None]).ravel(), out)
    # the sentinels stand before the first byte of their segment
    o = out_at[:-1]
    where = {PREFIX: np.where(spm, o + w + suffix, o), SUFFIX: np.where(spm, o, o + w + prefix), MIDDLE: o + 2 * w + prefix + suffix}
    for mark, place in where.items():
        for k, byte in enumerate(mark):
            out[place[~plain] + k] = byte
    return out, out_at


def put_back(buf: np.ndarray, at: np.ndarray, spm: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of concatenated outputs and where each begins (and the end), from outputs and forms alone."""
    w, n = len(PREFIX), len(plain)
    text_at = np.concatenate([[0], np.cumsum(np.diff(at) - np.where(plain, 0, 3 * w))])
    inside = np.zeros((n, 3), np.int64)  # places of the sentinels <P>, <S>, <M>
    for k, mark in enumerate(MARKS):
        hit = np.flatnonzero((buf[:-2] == mark[0]) & (buf[1:-1] == mark[1]) & (buf[2:] == mark[2])) if len(buf) > 2 else np.zeros(0, np.int64)
        row = np.searchsorted(at, hit, side="right") - 1
        hit, row = hit[~plain[row]], row[~plain[row]]
        hit, row = hit[hit + w <= at[row + 1]], row[hit + w <= at[row + 1]]
        if not np.array_equal(row, np.flatnonzero(~plain)):
            raise ValueError(f"an output that isn't plain lacks {mark.decode()} or has it twice")
        inside[row, k] = hit
    p, s, m = inside.T
    prefix = np.where(plain, 0, np.where(spm, m, s) - p - w)
    suffix = np.where(plain, 0, np.where(spm, p, m) - s - w)
    middle = np.where(plain, np.diff(at), at[1:] - m - w)
    begins = np.stack([text_at[:-1], text_at[:-1] + prefix, text_at[:-1] + prefix + middle], axis=1)
    begins[plain, 1:] = text_at[1:][plain, None]
    source = np.stack([np.where(plain, at[:-1], p + w), np.where(plain, at[1:], m + w), np.where(plain, at[1:], s + w)], axis=1)
    if (suffix < 0).any() or (prefix < 0).any() or (middle < 0).any():
        raise ValueError("the sentinels of an output aren't in the order of its form")
    out = np.empty(int(text_at[-1]), np.uint8)
    moved(buf, begins.ravel(), (source - begins).ravel(), out, gather=True)
    return out, text_at


def draws(key: Column, seed: int) -> list[Column]:
    """h1 to h4: the first four groups of eight hex digits of the SHA-256 of `seed:key`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _texts(buf: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(buf)]).cast(pa.string())


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row of docs without its text as struct `row`, with n (tokens), form (plain, psm or spm), output, prefix_chars and middle_chars.

    rate: of 100 texts, how many are rearranged; spm_rate: of 100 of these, how many have the suffix first."""
    h1, h2, h3, h4 = draws(F.col(id_col), seed)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    given = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), h1.alias("h1"), h2.alias("h2"), (h3 % 100 >= rate).alias("plain"), (h4 % 100 < spm_rate).alias("spm"))
    schema = T.StructType([given.schema["row"], *(T.StructField(c, T.StringType() if c in ("form", "output") else T.LongType()) for c in ("n", "form", "output", "prefix_chars", "middle_chars"))])

    def run(batches):
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            h1, h2, plain, spm = (part.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "plain", "spm"))
            starts = token_starts(buf, at)
            first = np.searchsorted(starts, at)
            n = np.diff(first)
            held = np.array([not t or any(m in t for m in MARKS) for t in (buf[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True))], bool)
            plain = plain | held
            draw = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)], axis=1), axis=1)
            bounds = np.append(starts, len(buf))
            cuts = np.where(draw == n[:, None], at[1:, None], bounds[np.minimum(first[:-1, None] + draw, len(starts))])
            out, out_at = rearranged(buf, at, cuts, spm, plain)
            chars = np.concatenate([[0], np.cumsum(buf & 0xC0 != 0x80)])
            prefix, middle = chars[cuts[:, 0]] - chars[at[:-1]], chars[cuts[:, 1]] - chars[cuts[:, 0]]
            form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), _texts(out, out_at), pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain)], names=schema.names)

    return arrow_map(given, run, schema)


def restored(made: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """The columns of made (outputs and their forms) with `restored`: the text of each output, from output and form alone."""
    given = made.select(F.struct("*").alias("row"), F.coalesce(F.col(output_col), F.lit("")).alias("text"), F.col(form_col).alias("form"))
    schema = T.StructType([given.schema["row"], T.StructField("restored", T.StringType())])

    def run(batches):
        for part in slices(batches):
            buf, at = buffer_of(part.column("text"))
            form = np.array(part.column("form").to_pylist(), object)
            out, text_at = put_back(buf, at, form == "spm", ~np.isin(form, ("spm", "psm")))
            yield pa.RecordBatch.from_arrays([part.column("row"), _texts(out, text_at)], names=["row", "restored"])

    return arrow_map(given, run, schema).select("row.*", "restored")


def op13_displacement_scatter(spark, sf_dir: str) -> DataFrame:
    """Query: every document's form, cuts, and digests of its output and of the text put back."""
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    lean = made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), "output")
    back = restored(lean)
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(cast(doc_id AS varchar), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tok
  FROM documents),
drawn AS (
  SELECT *, cast(len(tok) AS bigint) AS n,
         cast('0x' || h[1:8] AS bigint) % (len(tok) + 1) AS c1, cast('0x' || h[9:16] AS bigint) % (len(tok) + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR cast('0x' || h[17:24] AS bigint) % 100 >= 50 THEN 'plain'
              WHEN cast('0x' || h[25:32] AS bigint) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(tok[1:least(c1, c2)], '') AS p,
         array_to_string(tok[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(tok[greatest(c1, c2) + 1:n], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""
