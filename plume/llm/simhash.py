"""SimHash near-duplicates through a Gray-order hierarchical index.

1. ``fingerprints``: one 64-bit SimHash per document, whole texts, map only.
2. ``links``: distinct fingerprints meet wherever some of their bit bands agree (within
   ``max_bits`` differing bits at least one choice of agreeing bands must exist, so no
   link is lost), and each such bucket is searched by a hierarchical index: codes sorted
   by Gray rank, runs of them factored into nodes that hold the bits all members share,
   node pairs expanded from the top with accumulated differences, and whole groups
   pruned as soon as these pass ``max_bits``. A bucket returns a spanning forest, never
   all pairs.
3. ``components`` joins the forests.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import fresh, stored
from plume.llm.components import components

SEED = 42
FAN = 8
BUCKET = 4096          # mean bucket size above which finer bands are taken
CELL = 20_000          # codes of one bucket that one search cell takes
_LANES = np.uint64(0x0101010101010101)


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text: a bit is set if it is set in over half of the shingles' XXH64."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    n = len(words) - shingle + 1
    h = np.fromiter((xxhash.xxh64_intdigest(whole[s:e - 1], SEED) for s, e in zip(starts, ends[shingle - 1:])),
                    np.uint64, n)
    return _majority(h)


def _majority(h: np.ndarray) -> int:
    """Eight byte lanes are counted at a time; 255 rows cannot overflow a lane."""
    n = len(h)
    h = np.concatenate([h, np.zeros(-n % 255, np.uint64)]).reshape(-1, 255)
    out = 0
    for j in range(8):
        lanes = ((h >> np.uint64(j)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for b in np.nonzero(counts * 2 > n)[0].tolist():
            out |= 1 << (8 * b + j)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", extra: dict | None = None) -> DataFrame:
    """``doc_id, fp`` (the unsigned fingerprint's bits as a long) and the long columns ``extra``, by name.
    A null text has no words."""
    names = list(extra or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], ["doc_id", "fp", *names])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        *[c.alias(n) for n, c in (extra or {}).items()])
            .mapInArrow(run, ", ".join(f"{n} long" for n in ["doc_id", "fp", *names])))


# ------------------------------------------------------------------ the index

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def forest(cell: np.ndarray, codes: np.ndarray, max_bits: int, slice_pairs: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (two arrays of codes) of the links within each cell's codes."""
    order = np.lexsort((gray_rank(codes), cell))
    cell, codes = cell[order], codes[order]
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    # levels[0] are the codes; a node of a higher level holds FAN consecutive nodes of one cell
    levels = [(codes, np.full(len(codes), full), np.arange(len(codes) + 1), cell)]
    while True:
        value, mask, _, owner = levels[-1]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[first, len(owner)])
        if sizes.max() == 1:
            break
        rank = np.arange(len(owner)) - np.repeat(first, sizes)
        start = np.flatnonzero(rank % FAN == 0)
        ones = np.bitwise_and.reduceat(value & mask, start)
        some = np.bitwise_or.reduceat(value | ~mask, start)
        levels.append((ones, ~(ones ^ some), np.r_[start, len(owner)], owner[start]))
    label = np.arange(len(codes))
    top = len(levels) - 1
    nodes = np.arange(len(levels[top][0]))
    stack = [(top, nodes, nodes, np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.uint64))]
    while stack:
        at, a, b, gone, common = stack.pop()
        if len(a) > slice_pairs:
            stack.append((at, *(x[slice_pairs:] for x in (a, b, gone, common))))
            a, b, gone, common = (x[:slice_pairs] for x in (a, b, gone, common))
        if at == 0:
            keep = a < b
            _unite(label, a[keep], b[keep])
            continue
        if at == 1 and len(levels) > 3:      # groups that are joined already need no pair test
            low = np.minimum.reduceat(label, levels[1][2][:-1])
            high = np.maximum.reduceat(label, levels[1][2][:-1])
            keep = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
            a, b, gone, common = a[keep], b[keep], gone[keep], common[keep]
        value, mask, _, _ = levels[at - 1]
        bounds = levels[at][2]
        na, nb = bounds[a + 1] - bounds[a], bounds[b + 1] - bounds[b]
        of = np.repeat(np.arange(len(a)), na * nb)
        k = np.arange(len(of)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
        ca, cb = bounds[a][of] + k // nb[of], bounds[b][of] + k % nb[of]
        keep = ca <= cb
        of, ca, cb = of[keep], ca[keep], cb[keep]
        both = mask[ca] & mask[cb]
        gone = gone[of] + np.bitwise_count((value[ca] ^ value[cb]) & both & ~common[of])
        keep = gone <= max_bits
        if keep.any():
            stack.append((at - 1, ca[keep], cb[keep], gone[keep], both[keep]))
    child = np.flatnonzero(label != np.arange(len(codes)))
    return codes[child], codes[label[child]]


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Hook larger roots below smaller ones, in place, until every pair shares its label."""
    while True:
        a, b = label[i], label[j]
        m = a != b
        if not m.any():
            return
        i, j, a, b = i[m], j[m], a[m], b[m]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _search(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cell, code):
            a, b = forest(cell, code.view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held, size = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= 1 << 17:
                cell, code = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(cell, cell[-1]))   # rows come sorted by cell
                if cut:
                    yield found(cell[:cut], code[:cut])
                held, size = [(cell[cut:], code[cut:])], len(cell) - cut
        if size:
            yield found(*(np.concatenate(x) for x in zip(*held)))
    return run


def band_masks(max_bits: int, bands: int) -> list[int]:
    """Masks of the bits that agree, one for each choice of ``bands - max_bits`` bands."""
    cuts = [64 * i // bands for i in range(bands + 1)]
    of = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]
    return [sum(pick) for pick in itertools.combinations(of, bands - max_bits)]


def links(codes: DataFrame, max_bits: int = 4, bucket: int = BUCKET, cell: int = CELL) -> DataFrame:
    """Spanning edges ``a, b`` of the graph that links codes (distinct longs ``fp``) at
    ``max_bits`` or fewer differing bits.

    Bands are chosen so that evenly spread codes leave at most ``bucket`` codes in a
    bucket; the choice changes the work, not the links. A bucket of over ``cell`` codes is
    dealt at random over parts, and each pair of parts is a cell of its own, so a task holds
    a bounded number of codes however many near-copies share a bucket.
    """
    if not 0 <= max_bits < 16:
        raise ValueError("max_bits must be from 0 to 15")
    n = codes.count()
    bands = next((b for b in range(max_bits + 1, max_bits + 4)
                  if n >> (64 * (b - max_bits) // b) <= bucket), max_bits + 4)
    signed = [m - (1 << 64) if m >> 63 else m for m in band_masks(max_bits, bands)]
    keyed = codes.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(signed)])).alias("bucket"))
    large = keyed.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > cell)
    part = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts"))
    cells = (keyed.join(large, "bucket", "left")
             .select("fp", "bucket", F.ceil(F.coalesce("size", F.lit(1)) / cell).alias("parts"))
             .select("fp", "bucket", part.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
             .select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "fp"))
    return (cells.repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(_search(max_bits), "a long, b long"))


# ------------------------------------------------------------------ the operator

def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits``
    differing bits. Rows with empty, blank or null text have fingerprint zero and link like
    any other. A null id keeps its row and lends its fingerprint to the links, but names no
    component; where a whole component has none, ``component_id`` is null. Repeated rows
    come out as often as they went in. An empty table gives an empty result.
    """
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    rooted = _rooted(fps, max_bits)
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = stored(rooted.join(least, "root").select("fp", "component_id"), "named")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp, root, least``: each fingerprint's component, named by a fingerprint, and its smallest id."""
    codes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "codes")
    comps = components(links(codes.select("fp"), max_bits))
    return stored(codes.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
                  .select("fp", F.coalesce("root", "fp").alias("root"), "least"), "rooted")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each component: that with the smallest id, rows without an id last.

    Of rows that share that id one stays, by the hash of their columns; rows that are equal in all
    columns count as one. Column names may clash with none of ours.
    """
    parts = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string"))]
    hashes = {"row_a": F.xxhash64(*parts), "row_b": F.xxhash64(F.lit(1), *parts)}
    fps = stored(fingerprints(docs, shingle, id_col, text_col, hashes), "fingerprints")
    key = ["doc_id", "row_a", "row_b"]
    rows = fps.join(_rooted(fps, max_bits).select("fp", "root"), "fp").groupBy("root", *key).agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull(), *key)
    rows = stored(rows.select("root", *key, "n", order.alias("place")), "rows")
    first = rows.groupBy("root").agg(F.min("place").alias("first"))
    marked = stored(rows.join(first, "root").select(*key, (F.col("place") != F.col("first")).alias("goes"), "n"), "verdicts")
    names = {k: fresh(docs, k) for k in ["row_id", "row_a", "row_b"]}
    out = docs.withColumns({names["row_id"]: F.col(id_col).cast("long"), names["row_a"]: hashes["row_a"], names["row_b"]: hashes["row_b"]})

    theirs = {k: fresh(out, f"kept_{k}") for k in names}

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(*[F.col(c).alias(theirs[k]) for k, c in zip(names, key)])
        return left.join(right, [F.col(names[k]).eqNullSafe(F.col(theirs[k])) for k in names], how)

    out = joined(out, marked.where("goes"), "left_anti")
    again = marked.where("NOT goes AND n > 1")
    if not again.isEmpty():                       # equal rows: only these meet by their key
        out = joined(out, again, "left_anti").unionByName(joined(out, again, "left_semi").dropDuplicates(list(names.values())))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
