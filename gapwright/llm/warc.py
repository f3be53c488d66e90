"""Derivatives of WARC responses: linked metadata (WAT-like) and plain-text conversion (WET-like) records.

A record is a row: record_id, warc_type, refers_to, target_uri, warc_date, content_type, headers (as they stand
in the file), block, block_digest, payload_digest (sha1, base32), content_length. `responses` builds response
records from a table of pages; `read_warc` reads .warc and .warc.gz files; `derive` makes two records of each
response; `serialised` gives a record's bytes. A derived id is a name-based UUID of the response's id and the kind,
so a repeated run gives the same ids; the source's date, URI, payload digest and headers are kept.

Headers are kept as ordered pairs of name and value, repeated ones too, and are looked up whatever their case. The
metadata record describes, and the conversion record converts, the body after its transfer (chunked) and content
(gzip, deflate) encodings are undone; digests and lengths are those of the payload as it was sent.

Nulls: a null id, URL or block counts as empty text; a block without an HTTP head is all payload; a page
without text gives a conversion record of an empty block. Repeated rows give repeated records. Records of other types
pass by. An empty table gives no rows. A very long page is a row of its own slice; line breaks in a URL become
blanks, as they would end its header. There are no ties. Other columns of the pages are
not read, so their names cannot clash; `carried` ones must not bear a record column's name."""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_map, slices

RECORD = "record_id string, warc_type string, refers_to string, target_uri string, warc_date string, content_type string, headers string, block binary, block_digest string, payload_digest string, content_length long"
COLUMNS = [x.split()[0] for x in RECORD.split(", ")]
_TYPES = [pa.string()] * 7 + [pa.binary(), pa.string(), pa.string(), pa.int64()]
_UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|article|section|header|footer|nav|title|head|body|html|blockquote|pre)\b[^>]*>", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_SPACE = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_LINE_ENDS = re.compile(r"[\r\n]+")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_META = re.compile(r"<meta\b([^>]*)>", re.I)
_LINK = re.compile(r"<(a|area|link|img|iframe|script)\b[^>]*?\s(?:href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ATTR = re.compile(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain_text(page: str) -> str:
    """Visible text: no comments, scripts or styles; block tags end lines; entities decoded; blanks collapsed."""
    text = _TAG.sub("", _BREAK.sub("\n", _UNSEEN.sub(" ", page)))
    return _LINES.sub("\n", _SPACE.sub(" ", html.unescape(text))).strip()


def described(page: str) -> dict:
    """Title, metas and links of a page."""
    attrs = lambda s: {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(s)}
    seen = _UNSEEN.sub(lambda m: m.group(0)[: m.group(0).find(">") + 1] if m.group(1) else " ", page)
    title = _TITLE.search(seen)
    return {
        "Title": html.unescape(title.group(1)).strip() if title else None,
        "Metas": [attrs(m) for m in _META.findall(seen)],
        "Links": [{"path": f"{t.lower()}@/{'src' if t.lower() in ('img', 'iframe', 'script') else 'href'}", "url": html.unescape(a or b or c)} for t, a, b, c in _LINK.findall(seen)],
    }


def _pairs(head: str) -> list[tuple[str, str]]:
    """Names and values of header lines, in order; a line that begins with a blank goes on with the one before."""
    out: list[tuple[str, str]] = []
    for line in head.split("\n"):
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip(), value.strip()))
    return out


def _value(pairs: list[tuple[str, str]], name: str) -> str | None:
    """The first value of a header, whatever the case of its name."""
    return next((v for k, v in pairs if k.lower() == name), None)


def _http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of a response block."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    end = re.search(rb"\r?\n\r?\n", block)
    head, payload = (block[: end.start()], block[end.end() :]) if end else (block, b"")
    status, _, rest = head.decode("utf-8", "replace").partition("\n")
    return status.rstrip("\r"), _pairs(rest), payload


def _unchunked(data: bytes) -> bytes:
    """The body of a chunked transfer, as far as it goes."""
    out, at = [], 0
    while found := re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r?\n").match(data, at):
        n = int(found.group(1), 16)
        out.append(data[found.end() : found.end() + n])
        at = found.end() + n
        at += 2 if data[at : at + 2] == b"\r\n" else 1
        if not n:
            break
    return b"".join(out) if out else data


def _body(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """The payload without its transfer and content encodings; as it is where they don't fit it."""
    if "chunked" in (_value(headers, "transfer-encoding") or "").lower():
        payload = _unchunked(payload)
    for kind in reversed((_value(headers, "content-encoding") or "").lower().replace(" ", "").split(",")):
        for bits in {"gzip": (47,), "x-gzip": (47,), "deflate": (15, -15)}.get(kind, ()):
            try:
                payload = _inflated(payload, bits)
                break
            except zlib.error:
                continue
    return payload


def _inflated(payload: bytes, bits: int) -> bytes:
    """All members of a compressed payload; what follows the last is left out."""
    out, rest = [], payload
    while rest:
        d = zlib.decompressobj(bits)
        try:
            out.append(d.decompress(rest))
        except zlib.error:
            if not out:
                raise
            break
        rest = d.unused_data
    return b"".join(out)


def _charset(headers: list[tuple[str, str]]) -> str:
    found = re.search(r"charset=[\"']?([\w-]+)", _value(headers, "content-type") or "", re.I)
    try:
        return codecs.lookup(found.group(1)).name if found else "utf-8"
    except LookupError:
        return "utf-8"


def _urn(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(names))}>"


def _record(rid: str, kind: str, refers: str | None, uri: str, date: str, ctype: str, block: bytes, payload: str) -> tuple:
    own, uri = digest(block), _LINE_ENDS.sub(" ", uri)
    named = [("WARC-Type", kind), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Record-ID", rid), ("WARC-Refers-To", refers), ("Content-Type", ctype), ("WARC-Block-Digest", own), ("WARC-Payload-Digest", payload), ("Content-Length", str(len(block)))]
    return rid, kind, refers, uri, date, ctype, "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named if v), block, own, payload, len(block)


def _batch(rows: list[tuple], more: dict | None = None) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in COLUMNS]
    more = more or {}
    return pa.RecordBatch.from_arrays([*more.values(), *(pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True))], names=[*more, *COLUMNS])


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of a table of pages, with page_id."""
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def run(batches):
        for part in slices(batches, "html", 4 << 20):
            rows = []
            for key, url, page in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = page.encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                rows.append(_record(_urn("response", str(key), url), "response", None, url, date, "application/http; msgtype=response", head.encode() + payload, digest(payload)))
            yield _batch(rows, {"page_id": part.column("page_id")})

    return arrow_map(source, run, f"page_id long, {RECORD}")


def derive(records: DataFrame, *carried: str) -> DataFrame:
    """Metadata and conversion records of the response records; `carried` long columns pass through."""

    def run(batches):
        for part in slices(batches, "block", 4 << 20):
            rows, at = [], []
            for k, r in enumerate(part.select(["record_id", "target_uri", "warc_date", "headers", "block", "payload_digest"]).to_pylist()):
                rid, uri, date = r["record_id"] or "", r["target_uri"] or "", r["warc_date"] or ""
                status, headers, payload = _http(r["block"] or b"")
                page, source = _body(headers, payload).decode(_charset(headers), "replace"), r["payload_digest"] or digest(payload)
                warc = _pairs((r["headers"] or "").partition("\n")[2])
                about = {"Envelope": {"WARC-Header-Metadata": warc, "Payload-Metadata": {"HTTP-Response-Metadata": {"Response-Message": status, "Headers": headers, "HTML-Metadata": described(page), "Entity-Digest": source, "Entity-Length": len(payload)}}}}
                rows.append(_record(_urn("metadata", rid), "metadata", rid, uri, date, "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True).encode(), source))
                rows.append(_record(_urn("conversion", rid), "conversion", rid, uri, date, "text/plain", plain_text(page).encode(), source))
                at += [k, k]
            yield _batch(rows, {c: part.column(c).take(pa.array(at, pa.int64())) for c in carried})

    kept = records.where("warc_type = 'response'").select(*carried, "record_id", "target_uri", "warc_date", "headers", "block", "payload_digest")
    return arrow_map(kept, run, ", ".join([*(f"{c} long" for c in carried), RECORD]))


def serialised(records: DataFrame) -> DataFrame:
    """Adds `warc`: the record's bytes as they stand in a WARC file."""
    crlf = F.lit(b"\r\n\r\n")
    return records.withColumn("warc", F.concat(F.encode("headers", "utf-8"), F.lit(b"\r\n"), F.col("block"), crlf))


def write_warc(records: DataFrame, path: str) -> None:
    """Gzipped WARC files of the records below path, by Spark's own writer (bytes pass a string column unchanged)."""
    made = serialised(records).select(F.expr("substring(warc, 1, octet_length(warc) - 2)").cast("string").alias("value"))
    made.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


#: What stands between two records, and may stand in a block too.
_BETWEEN = b"\r\n\r\nWARC/1.0\r\n"


def _parsed(head: bytes, block: bytes, pairs: list[tuple[str, str]]) -> tuple:
    get = lambda k: _value(pairs, k)
    text = head.decode("utf-8", "replace")
    return get("warc-record-id") or "", get("warc-type") or "", get("warc-refers-to"), get("warc-target-uri") or "", get("warc-date") or "", get("content-type") or "", f"WARC/1.0\r\n{text}\r\n", block, get("warc-block-digest") or digest(block), get("warc-payload-digest"), len(block)


def _records(pieces):
    """Rows of records from (file, piece) in file order. Pieces are joined until the Content-Length that a record's head names is met, so a
    block may hold whole records; only the open record is held."""
    held, size, file = [], 0, None
    for name, piece in pieces:
        if held and name != file:
            raise ValueError(f"{file} ends within a record")
        file = name
        if not held:
            piece = piece.removeprefix(b"WARC/1.0\r\n")
            if not piece.strip():
                continue
            held, size = [piece], len(piece)
        else:
            held += [_BETWEEN, piece]
            size += len(_BETWEEN) + len(piece)
        if len(held) <= 3:  # the head ends in the first piece, or with it
            first = b"".join(held)
            head, blank, rest = first.partition(b"\r\n\r\n")
            pairs = _pairs(head.decode("utf-8", "replace"))
            n, before = int(_value(pairs, "content-length") or 0), len(head) + 4
        if size < before + n and not (n == 0 and not blank):
            continue
        data = b"".join(held)
        block, rest = data[before : before + n], data[before + n :]
        if rest.strip(b"\r\n"):
            raise ValueError(f"record {_value(pairs, 'warc-record-id')} of {file}: its length isn't that of its header")
        held = []
        yield _parsed(head, block, pairs)
    if held:
        raise ValueError(f"{file} ends within a record")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC/1.0 files, plain or gzipped, streamed record by record by Spark's reader.

    What "WARC/1.0" begins on a line after a blank one is a piece; a record takes as many pieces as its Content-Length asks for. A gzipped
    file is one task's stream; the pieces of a plain file, read in splits, are sorted by place into one stream a file."""

    def run(batches):
        rows, size = [], 0
        pieces = (x for part in slices(batches, "value", 4 << 20) for x in zip(part.column("file").to_pylist(), part.column("value").to_pylist(), strict=True))
        for row in _records(pieces):
            rows.append(row)
            size += len(row[7])
            if size > 4 << 20:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    lines = spark.read.option("lineSep", _BETWEEN.decode()).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    packed = F.col("file").endswith(".gz")
    plain = lines.where(~packed).repartition("file").sortWithinPartitions("file", "block", "at")
    return arrow_map(lines.where(packed).select("file", "value"), run, RECORD).unionByName(arrow_map(plain.select("file", "value"), run, RECORD))


def op5_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    """Query: the metadata and conversion records of every page's response; blocks as their digests and lengths."""
    made = derive(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")), "page_id")
    return made.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "block_digest", "payload_digest", "content_length")
