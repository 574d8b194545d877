import base64
import hashlib

import pytest

from plume.llm import warc
from plume.llm.common import scratch
from tests.conftest import SF001

SCHEMA = "page_id long, url string, html string, payload string, kind string, key long, kept int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash", 1, 2) for i, u, h in rows], SCHEMA)


def expected(rows, least=0):
    groups = {}
    for i, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        ids = [x for x in groups[body] if x is not None]
        kept = max(ids) if ids and len(groups[body]) > 1 and len(body) >= least else i
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "response" if i == kept else "revisit", None if i == kept else kept, "ok"))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.status) for r in df.collect()], key=str)


HARD = ["", None, "plain", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "WARC/1.1\r\n" * 9, "é" * 70_000, "x" * 99_999,
        "0\r\n\r\n", "WARC/1.1", "\r\n\r\n", "z" * 8192, "y" * 16384]


def test_round_trip_of_hard_payloads(spark):
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(HARD)]
    rows += [(100 + i, None, h) for i, h in enumerate(HARD)] + [(200, "http://x/WARC/1.1", "own"), (201, "http://x/\r\nWARC-Type: x", "own2")]
    for how in ({}, {"segment_bytes": 100, "chunk_bytes": 7}, {"compression": "none"}):
        if "segment_bytes" in how:
            cut = [r for r in rows if len(r[2] or "") < 500]
            assert result(warc.round_trip(pages_of(spark, cut), **how)) == expected(cut)
        else:
            assert result(warc.round_trip(pages_of(spark, rows), **how)) == expected(rows)


def test_payload_comes_back(spark):
    path = scratch(spark, "t")
    warc.write_archives(pages_of(spark, [(i, "u", h) for i, h in enumerate(HARD)]), path, segment_bytes=1000, min_revisit_bytes=10 ** 9)
    got = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, path).collect()}
    assert got == {i: (h or "").encode() for i, h in enumerate(HARD)}


def test_nulls_repeats_and_least_size(spark):
    rows = [(None, None, "same"), (5, "a", "same"), (9, "b", "same"), (9, "b", "same"), (None, None, "only nulls"),
            (None, None, "only nulls"), (1, "c", "tiny"), (2, "d", "tiny"), (3, "e", "big" * 20_000), (3, "e", "big" * 20_000)]
    got = result(warc.round_trip(pages_of(spark, rows)))
    assert got == expected(rows)
    assert result(warc.round_trip(pages_of(spark, rows), min_revisit_bytes=5)) == expected(rows, 5)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    assert result(warc.round_trip(pages)) == expected([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_empty_table(spark):
    assert warc.round_trip(pages_of(spark, [])).collect() == []


def _archive(spark, recs):
    path = scratch(spark, "t")
    (spark.createDataFrame([(r,) for r in recs], "v binary").selectExpr("cast(v as string) v").coalesce(1)
     .write.option("lineSep", "\r\n\r\n").text(path))
    return [(r.page_id, r.status, r.payload_bytes) for r in warc.read_archives(spark, path).collect()]


def test_damage_is_reported(spark):
    recs = warc.records(1, "u", b"p" * 1000, None, segment_bytes=300)
    assert len(recs) > 3
    assert _archive(spark, recs) == [(1, "ok", 1000)]
    assert _archive(spark, recs[::-1]) == [(1, "ok", 1000)]                       # any order
    assert _archive(spark, recs[:-1]) == [(1, "truncated", None)]                 # last segment lost
    assert _archive(spark, recs[:1] + recs[2:]) == [(1, "truncated", None)]       # one in the middle lost
    assert [x[1:] for x in _archive(spark, recs[1:])] == [("truncated", None)]    # first one lost
    whole = warc.records(2, "u", b"q" * 50, None)[0]
    assert _archive(spark, [whole.replace(b"qqqq", b"rrrr", 1)]) == [(2, "bad digest", 50)]
    assert _archive(spark, [whole[:-20]]) == [(2, "truncated", None)]
    assert _archive(spark, [whole.replace(b"\r\n32\r\n", b"\r\nff\r\n")]) == [(2, "bad chunks", None)]


@pytest.mark.parametrize("size", [1, 3, 8192])
def test_chunk_framing(size):
    for p in (b"", b"a", b"WARC/1.1\r\n" * 3, bytes(range(256)) * 5):
        framed = warc.chunked(p, size)
        assert warc.dechunked(framed) == p
        assert b"WARC/1.1" not in framed
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nab")


def _foreign(spark, version, records, compression="none"):
    path = scratch(spark, "t")
    raw = b"".join(version + b"\r\n" + r + b"\r\n\r\n" for r in records)
    spark.createDataFrame([(raw,)], "v binary").selectExpr("cast(v as string) v").coalesce(1).write.option(
        "lineSep", "\n").option("compression", compression).text(path)
    return sorted(((r.page_id, r.status, r.payload_bytes) for r in warc.read_archives(spark, path).collect()),
                  key=lambda r: (r[0] is None, r))


def _response(page, body, length=None, **extra):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + body
    head = {"WARC-Type": "response", "X-Page-ID": page, "Content-Length": len(block) if length is None else length} | extra
    return "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block


@pytest.mark.parametrize("compression", ["none", "gzip"])
@pytest.mark.parametrize("version", [b"WARC/1.0", b"WARC/1.1"])
def test_archives_of_either_version(spark, version, compression):
    inner = b"\r\n\r\n".join([b"WARC/1.0\r\n" + _response(9, b"inner"), b"WARC/1.", b"WARC/1.1\r\n", b"end"])
    recs = [_response(1, b"one"), _response(2, inner), _response(3, b"x WARC/1.1\r\n y"), _response(4, b"")]
    assert _foreign(spark, version, recs, compression) == [(1, "ok", 3), (2, "ok", len(inner)), (3, "ok", 14), (4, "ok", 0)]


def test_damage_loses_no_other_record(spark):
    good = [_response(i, b"body %d" % i) for i in (1, 9)]
    cut = [_response(2, b"short", 4000), _response(3, b"longer than said", 25)]
    got = _foreign(spark, b"WARC/1.0", [good[0], *cut, good[1]])
    assert got == [(1, "ok", 6), (2, "truncated", None), (3, "ok", 6), (9, "ok", 6)]
    heads = [_response(2, b"a", "many"), _response(3, b"b", -5), _response("x7", b"c"), _response(4, b"d", **{"WARC-Segment-Number": "one"}),
             _response(5, b"e", "9" * 5000)]
    got = _foreign(spark, b"WARC/1.1", [good[0], *heads, good[1]])
    assert got == [(1, "ok", 6), *[(i, "bad head", None) for i in (2, 3, 4, 5)], (9, "ok", 6), (None, "bad head", None)]
    frames = [b"-6\r\nab\r\n0\r\n\r\n", b"1_0\r\n", b"+3\r\nabc\r\n0\r\n\r\n", b"\r\n", b"fffffffffffffff\r\nab", b"zz"]
    recs = []
    for i, f in enumerate(frames):
        block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + f
        recs.append(b"WARC-Type: response\r\nX-Page-ID: %d\r\nContent-Length: %d\r\n\r\n" % (i, len(block)) + block)
    assert _foreign(spark, b"WARC/1.1", recs) == [(i, "bad chunks", None) for i in range(len(frames))]


def test_pieces_of_other_splits_stay_apart():
    whole = _response(1, b"ab")
    pieces = [(b"junk", 0), (b"1\r\n" + _response(1, b"ab", 5000), 0), (b"1\r\n" + whole, 1), (b"no start", 1), (None, 1)]
    assert [r[:3] for r in warc.whole_records(iter(pieces))] == [b"1\r\n"] * 2
