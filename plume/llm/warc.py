"""WARC archives: records, segments, chunked transfer framing, revisits.

Writing: one record per page. A response block is an HTTP message whose body is sent in
chunks; a block above ``segment_bytes`` becomes a first segment plus continuation records.
Later copies of a payload become revisit records. Files go to any folder Spark can write,
through Spark's own text writer, so tasks commit atomically.

Reading: archives of WARC/1.0 and 1.1 are cut at the version mark by Spark's text reader, so no
file is ever held whole. A record whose declared length reaches beyond the next mark (its block
holds one) takes in the pieces that follow. Continuations are grouped by origin id, ordered by
segment number, checked against the total length, and the chunks are decoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.llm.common import scratch, stored

VERSION = b"WARC/1.1"
MARK = b"WARC/1."
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing. A chunk also ends inside every version mark that the
    payload holds, so that the mark between records never occurs in a block."""
    cuts = set(range(0, len(payload), size)) | {m.start() + 4 for m in re.finditer(re.escape(MARK), payload)}
    cuts = [*sorted(cuts - {0}), len(payload)] if payload else []
    out, start = [], 0
    for end in cuts:
        out.append(b"%x\r\n%s\r\n" % (end - start, payload[start:end]))
        start = end
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """Undo chunked framing; chunk extensions and trailers are skipped. Raises ValueError if it is cut short
    or a chunk size is not a hexadecimal number."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = re.fullmatch(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(?:;.*)?", body[at:end], re.S)
        if not size:
            raise ValueError("no chunk size")
        n = int(size[1], 16)
        if n == 0:
            return b"".join(out)
        chunk = body[end + 2:end + 2 + n]
        if len(chunk) < n or body[end + 2 + n:end + 4 + n] != b"\r\n":
            raise ValueError("cut short")
        out.append(chunk)
        at = end + 4 + n


def _head(fields: list[tuple[str, object]], length: int) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None] + [f"Content-Length: {length}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n"


def _uri(url: str | None) -> str | None:
    """Control characters, and a slash that would complete the version line, are percent-encoded."""
    if url is None:
        return None
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url).replace("WARC/1.", "WARC%2F1.")


def records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
            segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> list[bytes]:
    """The records of one page, without the blank lines that end a record."""
    digest = base32_sha1(payload)
    name = f"urn:x-page:{'none' if page_id is None else page_id}:{digest}"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", _uri(url)), ("X-Page-ID", page_id),
              ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        return [_head([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}:revisit>"), *common,
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("WARC-Refers-To", f"<urn:x-page:{refers_to}:{digest}>"),
                       ("Content-Type", "application/http; msgtype=response")], len(block)) + block]
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
             + chunked(payload, chunk_bytes))
    first = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common,
             ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= segment_bytes:
        return [_head(first, len(block)) + block]
    parts = _segments(block, segment_bytes)
    out = [_head([*first, ("WARC-Segment-Number", 1)], len(parts[0])) + parts[0]]
    for i, part in enumerate(parts[1:], 2):
        out.append(_head([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{i}>"), ("WARC-Date", DATE),
                          ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", i),
                          ("WARC-Segment-Total-Length", len(block) if i == len(parts) else None)], len(part)) + part)
    return out


def _segments(block: bytes, size: int) -> list[bytes]:
    return [block[i:i + size] for i in range(0, len(block), size)]


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES,
                   chunk_bytes: int = CHUNK_BYTES, compression: str = "gzip") -> None:
    """Write one record per row of ``pages`` (``page_id, url, html``; other columns are not read).

    Of the rows with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the
    largest page_id is the response and the others are revisits of it; rows that repeat that
    page_id are responses too. Null html is an empty payload; rows with a null page_id revisit
    like any other, and where no copy has an id all copies are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("key", F.sha1(F.col("html").cast("binary")))
    copies = stored(keyed.where(F.octet_length("html") >= min_revisit_bytes).groupBy("key")
                    .agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").select("key", "kept"),
                    "warc-copies")
    marked = keyed.join(copies, "key", "left").select(
        "page_id", "url", F.col("html").cast("binary").alias("html"),
        F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            for page, url, html, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                made = records(page, url, html, refers_to, segment_bytes, chunk_bytes)
                out += made
                size += sum(map(len, made))
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (marked.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path))


_FIELDS = ("page_id long, target_uri string, record_id string, kind string, segment int, origin string, total long, "
           "payload_bytes long, payload_digest string, refers_to long, status string, block binary")
_ARROW = pa.schema([("page_id", pa.int64()), ("target_uri", pa.string()), ("record_id", pa.string()), ("kind", pa.string()),
                    ("segment", pa.int32()), ("origin", pa.string()), ("total", pa.int64()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("status", pa.string()), ("block", pa.binary())])


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n"))
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def _page_of(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?\d+):[^>]*>", urn or "")
    return int(m[1]) if m else None


def _payload(block: bytes, declared: str | None) -> tuple[bytes | None, str]:
    """Body of an HTTP message, decoded, and how it compares to the declared digest."""
    head, _, body = block.partition(b"\r\n\r\n")
    if "chunked" in _fields(head).get("transfer-encoding", ""):
        try:
            body = dechunked(body)
        except ValueError:
            return None, "bad chunks"
    return body, "ok" if declared in (None, "sha1:" + base32_sha1(body)) else "bad digest"


def _parse(keep_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((v.as_py(), where) for b in batches for v, where in
                  zip(b.column(0), zip(b.column(1).to_pylist(), b.column(2).to_pylist())))
        rows, size = [], 0
        for raw in whole_records(pieces):
            rows.append(parse_record(raw, keep_payload))
            size += len(raw)
            if len(rows) >= 2000 or size > 8 << 20:
                yield _batch(rows)
                rows, size = [], 0
        yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _ARROW)] if rows
                                      else [pa.array([], f.type) for f in _ARROW], schema=_ARROW)


def whole_records(pieces: Iterator[tuple[bytes, object]]) -> Iterator[bytes]:
    """Records from what lies between version marks, each with the split it was read from, in order.

    A record begins with the rest of its version line. While its block is shorter than its head
    declares it takes in the pieces of its split that follow, with the marks between them; where that
    ends in nothing but line ends, the length was right and the marks were part of the block. Else
    the record was cut short: it stands alone, and the pieces are looked at again. A piece that begins
    no record (text before the first one, padding) is skipped. No more than a declared length, or one
    split, is held.
    """
    def settled(held: list[bytes], need: int) -> tuple[bytes, list[bytes]]:
        """The first record of ``held``, and the pieces that are not part of it."""
        whole = MARK.join(held)
        if len(whole) >= need and not whole[need:].strip(b"\r\n"):
            return whole, []
        return held[0], held[1:]

    def starts(piece: bytes) -> bool:
        return re.match(rb"\d\r?\n", piece) is not None

    def taken(held: list[bytes], last: bool) -> Iterator[bytes]:
        """Records that can be told from ``held``; what is left stays in it."""
        while held:
            if not starts(held[0]):
                del held[0]
                continue
            need = _declared(held[0])
            if len(held[0]) < need and not last and sum(map(len, held)) + len(MARK) * (len(held) - 1) < need:
                return
            upto, have = 1, len(held[0])
            while have < need and upto < len(held):
                have += len(MARK) + len(held[upto])
                upto += 1
            record, rest = settled(held[:upto], need)
            yield record
            held[:upto] = rest

    held: list[bytes] = []
    of = None
    for piece, where in pieces:
        if where != of:
            yield from taken(held, True)
            of = where
        held.append(piece or b"")
        yield from taken(held, False)
    yield from taken(held, True)


def _declared(piece: bytes) -> int:
    """How long a record is by its head; as long as it is where the head does not say."""
    head, end, _ = piece.partition(b"\r\n\r\n")
    n = _number(_fields(head).get("content-length"))
    return len(head) + len(end) + n if end and n and n > 0 else 0


def _number(text: str | None) -> int | None:
    """A plain decimal number of up to 18 digits; None for anything else."""
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,18}", text) else None


def parse_record(raw: bytes, keep_payload: bool) -> tuple:
    """One row of ``_FIELDS`` from a record, from the rest of its version line on."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    f = _fields(head)
    numbers = {k: _number(f.get(k)) for k in ("content-length", "x-page-id", "warc-segment-number", "warc-segment-total-length")}
    n = numbers["content-length"]
    bad = any(k in f and (v is None or v < 0 and k != "x-page-id") for k, v in numbers.items())
    block, kind, declared = rest[:n or 0], f.get("warc-type"), f.get("warc-payload-digest")
    segment = numbers["warc-segment-number"]
    row = [numbers["x-page-id"], f.get("warc-target-uri"), f.get("warc-record-id"), kind, None, None, None, None,
           declared.removeprefix("sha1:") if declared else None, None, "ok" if len(block) == (n or 0) else "truncated", None]
    if bad:
        row[10] = "bad head"
    elif segment is not None:
        row[4] = segment
        row[5] = f.get("warc-segment-origin-id", row[2])
        row[6] = numbers["warc-segment-total-length"]
        row[11] = block
    elif kind == "revisit":
        row[9] = _page_of(f.get("warc-refers-to"))
        row[7] = _number(_fields(block.partition(b"\r\n\r\n")[0]).get("content-length"))
    elif kind == "response" and row[10] == "ok":
        body, row[10] = _payload(block, declared)
        if body is not None:
            row[7], row[8] = len(body), base32_sha1(body)
            row[11] = body if keep_payload else None
    return tuple(row)


def _assemble(keep_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {k: b.column(i).to_pylist() for i, k in enumerate(b.schema.names)}
            out = []
            for i in range(b.num_rows):
                parts, total, n = cols["blocks"][i], cols["total"][i], cols["last"][i]
                block, declared = b"".join(parts), cols["payload_digest"][i]
                body, status = None, "truncated"
                if len(parts) == n and total == len(block) and cols["damaged"][i] == 0:
                    body, status = _payload(block, f"sha1:{declared}" if declared else None)
                out.append((cols["page_id"][i], cols["target_uri"][i], cols["origin"][i], cols["kind"][i], None, None, total,
                            None if body is None else len(body), declared if body is None else base32_sha1(body), None,
                            status, body if keep_payload else None))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _ARROW)] if out
                                             else [pa.array([], f.type) for f in _ARROW], schema=_ARROW)
    return run


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row per page record of the archives below ``path`` (plain or compressed).

    Columns: page_id, target_uri, record_type (response or revisit), payload_bytes,
    payload_digest, refers_to, status, payload. Status is ``ok``, ``truncated`` (a block or a
    reassembled record is shorter than declared, or a segment is missing), ``bad head`` (a length, page id
    or segment number that is no number), ``bad chunks`` or
    ``bad digest``; such rows stay, with null length and payload. A block that holds a version mark is
    read whole within its split of the file; where a plain file is split inside such a block, the
    record comes out as ``truncated`` (compressed files are not split). A revisit's length and
    digest are those of the payload it stands for. Identical records that occur more than
    once come out as often. An archive without records gives no rows.
    """
    raw = (spark.read.option("lineSep", MARK.decode()).text(path)
           .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("start")).mapInArrow(_parse(keep_payload), _FIELDS))
    whole = raw.where("segment IS NULL AND (kind IN ('response', 'revisit') OR status = 'bad head')")
    parts = raw.where("segment IS NOT NULL")
    # copies of one segment collapse before its record is gathered: the group is one record
    single = parts.groupBy("origin", "segment").agg(
        F.first("block").alias("block"), F.max("total").alias("total"), F.count("*").alias("copies"),
        F.max("page_id").alias("page_id"), F.max("target_uri").alias("target_uri"),
        F.max("payload_digest").alias("payload_digest"),
        F.max(F.when(F.col("segment") == 1, F.col("kind"))).alias("kind"),
        F.sum((F.col("status") != "ok").cast("int")).alias("damaged"))
    joined = single.groupBy("origin").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("segment", "block"))), lambda x: x["block"]).alias("blocks"),
        F.max("segment").alias("last"), F.max("total").alias("total"), F.sum("damaged").alias("damaged"),
        F.max(F.when(F.col("segment") == 1, F.col("copies"))).alias("copies"),
        F.max("page_id").alias("page_id"), F.max("target_uri").alias("target_uri"),
        F.max("payload_digest").alias("payload_digest"), F.max("kind").alias("kind"))
    order = ["origin", "blocks", "last", "total", "damaged", "page_id", "target_uri", "payload_digest", "kind"]
    # a record whose first segment is missing has no copies: it still comes out once, as truncated
    rebuilt = joined.select(F.explode(F.sequence(F.lit(1), F.coalesce(F.col("copies"), F.lit(1)))), *order).select(*order)
    return whole.unionByName(rebuilt.mapInArrow(_assemble(keep_payload), _FIELDS)).select(
        "page_id", "target_uri", F.coalesce("kind", F.lit("response")).alias("record_type"), "payload_bytes",
        "payload_digest", "refers_to", "status", F.col("block").alias("payload"))


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write the archives to the shared folder and read them back, without the payloads."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, **how)
    return read_archives(pages.sparkSession, path, keep_payload=False).drop("payload")
