"""Benchmark decontamination by q-gram lemma filtering.

A benchmark item of m characters that occurs in a document with at most e edits shares at
least ``m + 1 - q * (e + 1)`` character q-grams with it, all within e + 1 neighbouring
diagonals (text place minus item place). Shared q-grams are counted in overlapping bands of
diagonals; bands that reach the bound are kept and verified by a banded alignment. Both
sides are compared lower-cased with white space collapsed.

With ``window``, regions of that many characters are sought besides whole items, each with its
own bound and edit budget, so a document that holds only an excerpt is found too. Regions start
at every ``window // 3`` characters of the item and of each of its lines, and end with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import text_slices

Q = 16                       # a power of two: q-gram hashes are built by doubling
RATE = 0.05                  # edits per character of the item
EXCERPT = 48                 # characters of the regions that the query and the pipeline seek
BLOCK_BYTES = 1 << 20        # benchmark text that one pass over the documents carries
_TABLE_BITS = 22
_HITS = 1 << 20              # bands that are expanded at a time
_DIAGONALS = 1 << 15         # diagonals of a run of bands
_CELLS = 1 << 18             # diagonals of the alignments that are made at a time
_GAP = np.uint64(0x110000)   # no character has this code
_BASE = 0x9E3779B97F4A7C15


def normalised(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text with single spaces."""
    return np.frombuffer(" ".join((text or "").lower().split()).encode("utf-32-le"), "<u4")


def qgrams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every run of q codes; its high bits are mixed."""
    h, width, base = codes.astype(np.uint64) + np.uint64(1), 1, _BASE
    while width < q:
        if len(h) <= width:
            return np.empty(0, np.uint64)
        h = h[:-width] * np.uint64(base) + h[width:]
        base, width = base * base % (1 << 64) | 1, 2 * width
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


@dataclass
class Items:
    """Benchmark items with their q-grams, sorted by hash. Pieces are the items, then their regions:
    ``item``, ``start`` and ``length`` say what a piece is of its item. An entry is a run of places that
    a q-gram has in a ``piece``, from ``first`` to ``last`` and never further apart than the piece's band is
    wide: at any text place it hits every band between the two, so a gram that repeats costs bands, not places.
    ``short`` items have fewer than q characters; their numbers follow those of the others in ``keys``."""
    keys: list
    short: list[str]
    codes: list[np.ndarray]
    item: np.ndarray
    start: np.ndarray
    length: np.ndarray
    edits: np.ndarray
    need: np.ndarray
    band: np.ndarray
    table: np.ndarray
    grams: np.ndarray
    piece: np.ndarray
    first: np.ndarray
    last: np.ndarray
    cost: np.ndarray

    def code(self, piece: int) -> np.ndarray:
        return self.codes[self.item[piece]][self.start[piece]:self.start[piece] + self.length[piece]]


def region_starts(text: str, window: int) -> list[int]:
    """Where the regions of an item longer than ``window`` start: in the whole of it and in each line."""
    lines = [n for n in (len(normalised(x)) for x in text.split("\n")) if n]
    m = sum(lines) + len(lines) - 1
    if m <= window:
        return []
    spans, at = [(0, m)], 0
    for n in lines:
        spans.append((at, at + n))
        at += n + 1
    return sorted({x for a, b in spans if b - a >= window for x in (*range(a, b - window + 1, max(1, window // 3)), b - window)})


def index(items: list[tuple], q: int = Q, rate: float = RATE, window: int | None = None) -> Items:
    """Items shorter than ``q`` characters have no q-grams; they are kept apart."""
    every = [(k, normalised(t), t) for k, t in items]
    kept = [x for x in every if len(x[1]) >= q]
    short = [(k, _flat(t)) for k, c, t in every if 0 < len(c) < q]
    starts = [region_starts(t, window) if window else [] for *_, t in kept]
    item = np.r_[np.arange(len(kept)), np.repeat(np.arange(len(kept)), [len(x) for x in starts])].astype(np.int64)
    start = np.r_[np.zeros(len(kept)), [x for xs in starts for x in xs]].astype(np.int64)
    m = np.r_[[len(c) for _, c, _ in kept], np.full(len(item) - len(kept), window or 0)].astype(np.int64)
    edits = np.minimum(np.floor(m * rate).astype(np.int64), (m - q) // q)
    band = np.maximum(32, edits)
    grams = [qgrams(c, q) for _, c, _ in kept]
    sizes = np.array([len(g) for g in grams], np.int64)
    owner = np.repeat(np.arange(len(kept)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    h = np.concatenate(grams) if grams else np.empty(0, np.uint64)
    # each q-gram place counts for its item and for the regions that hold it
    regions = (item << 32 | start)[len(kept):]
    lo = np.searchsorted(regions, (owner << 32) + np.maximum(place + q - (window or 0), 0))
    n = np.maximum(np.searchsorted(regions, (owner << 32) + place, "right") - lo, 0)
    inside = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()) + len(kept)
    piece, h = np.r_[owner, inside].astype(np.int64), np.r_[h, np.repeat(h, n)]
    place = np.r_[place, np.repeat(place, n) - start[inside]]
    order = np.lexsort((place, piece, h))
    h, piece, place = h[order], piece[order], place[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (piece[1:] != piece[:-1]) | (place[1:] - place[:-1] > band[piece[1:]])
    begin = np.flatnonzero(new)
    first, last, piece = place[begin], place[np.r_[begin[1:], len(h)] - 1] if len(h) else place, piece[begin]
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
    return Items([k for k, *_ in kept] + [k for k, _ in short], [t for _, t in short], [c for _, c, _ in kept], item, start, m,
                 edits, m + 1 - q * (edits + 1), band, table, h[begin], piece, first, last,
                 np.r_[0, np.cumsum((last - first) // band[piece] + 3)])


def _flat(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _candidates(whole: np.ndarray, ends: np.ndarray, it: Items, q: int) -> tuple[np.ndarray, ...]:
    """Text, piece, first and last band of every run of bands in which enough places of the text share a
    q-gram with the piece, in that order. Hits are expanded a bounded number at a time and counted."""
    h = qgrams(whole, q)
    at = np.flatnonzero(it.table[h >> np.uint64(64 - _TABLE_BITS)])
    lo, hi = np.searchsorted(it.grams, h[at]), np.searchsorted(it.grams, h[at], "right")
    at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
    total = np.cumsum(it.cost[hi] - it.cost[lo])
    cuts = np.r_[0, np.searchsorted(total, np.arange(_HITS, total[-1] if len(total) else 0, _HITS)), len(at)]
    counted: list[np.ndarray] = []
    for x, y in zip(cuts[:-1], cuts[1:]):
        n = hi[x:y] - lo[x:y]
        entry = np.repeat(lo[x:y] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        place, piece = np.repeat(at[x:y], n), it.piece[entry]
        # a band of width w + e starts at every multiple of w; a hit in the overlap counts for both bands
        w = it.band[piece]
        low = np.floor_divide(place - it.last[entry] - it.edits[piece] - 1, w)
        n = np.floor_divide(place - it.first[entry], w) - low + 1
        band = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        counted.append(_counted(np.repeat(np.searchsorted(ends, place, "right"), n), np.repeat(piece, n), band,
                                np.ones(len(band), np.int64)))
        if len(counted) == 16:
            counted = [_counted(*np.concatenate(counted, axis=1))]
    if not counted:
        return (np.empty(0, np.int64),) * 4
    doc, piece, band, count = _counted(*np.concatenate(counted, axis=1))
    keep = count >= it.need[piece]
    doc, piece, band = doc[keep], piece[keep], band[keep]
    # neighbouring bands overlap: they are verified together, up to a bounded number of diagonals
    alone = np.ones(len(doc), bool)
    alone[1:] = (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1]) | (band[1:] != band[:-1] + 1)
    run = np.flatnonzero(alone)
    place = np.arange(len(doc)) - np.repeat(run, np.diff(np.r_[run, len(doc)]))
    first = np.flatnonzero(place % np.maximum(1, _DIAGONALS // it.band[piece]) == 0)
    last = np.r_[first[1:], len(doc)] - 1 if len(first) else first
    return doc[first], piece[first], band[first], band[last]


def _counted(doc: np.ndarray, piece: np.ndarray, band: np.ndarray, count: np.ndarray) -> np.ndarray:
    order = np.lexsort((band, piece, doc))
    doc, piece, band, count = doc[order], piece[order], band[order], count[order]
    new = np.ones(len(doc), bool)
    new[1:] = (band[1:] != band[:-1]) | (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return np.stack([doc[first], piece[first], band[first], np.add.reduceat(count, first) if len(first) else count])


def matches(texts: list[str | None], it: Items, q: int = Q) -> list[tuple[int, int, int, int, int, int]]:
    """``(text number, item number, edits, end, start, length)`` of each item's best place in each
    text: that of the whole item, or else that of the region with the fewest edits."""
    if not it.keys:
        return []
    out = []
    if it.short:
        for x, t in enumerate(texts):
            t = f" {_flat(t)} "
            for y, item in enumerate(it.short, len(it.codes)):
                place = t.find(f" {item} ")
                if place >= 0:
                    out.append((x, y, 0, place + len(item), 0, len(item)))
    codes = [normalised(t) for t in texts]
    gap = np.array([_GAP], "<u4")
    sizes = np.array([len(c) + 1 for c in codes])
    ends = np.cumsum(sizes)
    whole = np.concatenate([x for c in codes for x in (c, gap)])
    doc, piece, band, upto = _candidates(whole, ends, it, q)
    width = (upto - band + 1) * it.band[piece] + 3 * it.edits[piece]
    # candidates are verified in order; a piece found without edits needs none of its later bands in that text,
    # and an item found whole none of its regions
    group = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1])]) - 1 if len(doc) else doc
    done = np.zeros(group[-1] + 1 if len(doc) else 0, bool)
    best: dict[tuple[int, int], tuple] = {}
    s = 0
    while s < len(doc):
        near = s + np.flatnonzero(~done[group[s:s + 65536]])
        near = [k for k in near[:1024].tolist()
                if piece[k] < len(it.codes) or best.get((int(doc[k]), int(it.item[piece[k]])), (True,))[0]]
        if not near:
            s += 65536 if done[group[s:s + 65536]].all() else 1024
            continue
        near = np.array(near)
        near = near[:int(np.argmin(np.r_[it.length[piece[near]] == it.length[piece[near[0]]], False]))]    # of one length
        cells = np.arange(1, len(near) + 1) * np.maximum.accumulate(width[near])
        near = near[:max(1, int(np.searchsorted(cells, _CELLS)))]
        b, i, d = band[near], piece[near], doc[near]
        edits, end = align(whole, b * it.band[i] - it.edits[i], width[near], i, it,
                           ends[d] - sizes[d], ends[d] - 1)
        for x, y, e, z, g in zip(d.tolist(), i.tolist(), edits.tolist(), end.tolist(), group[near].tolist()):
            if e <= it.edits[y]:
                k, found = (x, int(it.item[y])), (y >= len(it.codes), e, z, y)
                best[k] = min(best.get(k, found), found)
                done[g] |= e == 0
        s = int(near[-1]) + 1
    start = ends - sizes
    return out + [(x, y, e, z - int(start[x]), int(it.start[p]), int(it.length[p])) for (x, y), (_, e, z, p) in best.items()]


def align(text: np.ndarray, low: np.ndarray, width: np.ndarray, item: np.ndarray, it: Items, start: np.ndarray,
          stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each item against a stretch of the text, over the diagonals from ``low`` on
    (``width`` + 1 of them), and where the best stretch ends. Stretches stay within
    ``start``..``stop``. All candidates advance together, one item character a row."""
    m = it.length[item]
    most, cols = int(m.max()), np.arange(int(width.max()) + 1)
    pattern = np.zeros((len(item), most), np.uint32)
    for r, i in enumerate(item):
        pattern[r, :m[r]] = it.code(i)
    far = np.int32(1 << 20)
    off = (cols[None, :] > width[:, None])
    at = low[:, None] + cols[None, :]                   # text place after 0 item characters
    v = np.where(off | (at < start[:, None]) | (at > stop[:, None]), far, 0).astype(np.int32)
    edits, end = np.full(len(item), far), np.zeros(len(item), np.int64)
    for row in range(1, most + 1):
        at += 1                                         # each diagonal has moved one place on
        valid = (at > start[:, None]) & (at <= stop[:, None])
        chars = text[np.clip(at - 1, 0, len(text) - 1)]
        new = np.where(valid, v + (chars != pattern[:, row - 1:row]), far)
        new[:, :-1] = np.minimum(new[:, :-1], v[:, 1:] + 1)            # item character without a partner
        new[off | (at < start[:, None]) | (at > stop[:, None])] = far
        new = np.minimum.accumulate(new - cols, axis=1) + cols         # text characters without a partner
        new = np.where(off | (at < start[:, None]) | (at > stop[:, None]), far, new)
        v = np.minimum(new, far).astype(np.int32)
        done = np.flatnonzero(m == row)
        if len(done):
            c = v[done].argmin(axis=1)
            edits[done], end[done] = v[done, c], at[done, c]
    return edits, end


def _blocks(benchmark: DataFrame, id_col: str | None, text_col: str, block_bytes: int) -> list[list[tuple]]:
    """Distinct items, in blocks of bounded size, each for one pass over the documents. Without an id column
    items are told apart by their texts."""
    key = F.lit(0) if id_col is None else F.col(id_col)
    rows = (benchmark.select(key.cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
            .where("item_id IS NOT NULL AND text IS NOT NULL").distinct().orderBy("item_id", "text"))
    blocks: list[list[tuple]] = [[]]
    size = 0
    for r in rows.toLocalIterator():
        if size and size + len(r.text) > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((r.item_id, r.text))
        size += len(r.text)
    return blocks


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, id_col: str = "doc_id",
                 text_col: str = "text", block_bytes: int = BLOCK_BYTES, window: int | None = None) -> DataFrame:
    """``doc_id, item_id, edits, end, start, length`` for each item found in each row of ``docs``.

    An item is found where a stretch of the document lies within ``floor(rate * m)`` edits of
    it, and no more than the lemma can see: ``(m - q) // q``. ``end`` is the place after the
    stretch in the normalised text. With ``window`` (at least ``q``), an item also is found where
    one of its regions of that length lies within the edits that this length allows; a whole
    item goes before regions. ``start`` and ``length`` say what part of the normalised item was
    found. Any unedited excerpt of ``window + window // 3 - 1`` characters holds a region, and so
    does a whole line of ``window`` characters. Items shorter than ``q`` characters are found only where
    they occur unedited, as whole words. Null and blank items, items with a null id and null texts match nothing. Rows with a null id, and repeated rows, are judged like any other.
    Benchmarks above ``block_bytes`` of text take one pass over the documents per block.
    """
    if q < 1 or q & (q - 1):
        raise ValueError("q must be a power of two")
    if window is not None and window < q:
        raise ValueError("window must be at least q")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block in _blocks(benchmark, "item_id", "text", block_bytes):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            it = index(block, q, rate, window)
            for batch in batches:
                for b in text_slices(batch, 1):
                    found = matches(b.column(1).to_pylist(), it, q)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array([x for x, *_ in found], pa.int64())),
                         pa.array([it.keys[y] for _, y, *_ in found], pa.int64()),
                         pa.array([f[2] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.int64()),
                         pa.array([f[4] for f in found], pa.int32()), pa.array([f[5] for f in found], pa.int32())],
                        ["doc_id", "item_id", "edits", "end", "start", "length"])

        part = src.mapInArrow(run, "doc_id long, item_id long, edits int, end long, start int, length int")
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, text_col: str = "text",
                      block_bytes: int = BLOCK_BYTES, window: int | None = None) -> DataFrame:
    """``docs``, all columns, without the documents that hold an item, or with ``window`` a region of one. Map only.
    Items need no id."""
    if window is not None and window < q:
        raise ValueError("window must be at least q")
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, None, "text", block_bytes):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            it = index(block, q, rate, window)
            for batch in batches:
                for b in text_slices(batch, at):
                    hit = {x for x, *_ in matches(b.column(at).to_pylist(), it, q)}
                    yield b.filter(pa.array([i not in hit for i in range(b.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
