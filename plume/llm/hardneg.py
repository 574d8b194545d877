"""Hard-negative mining over exact scores from a residue-number-system matrix product.

Integer vectors are packed into blocks. A pair of blocks is multiplied once for each of a few
small primes, on balanced residues in float32, where every partial sum is exact; the signed
scores are put together again from the residues by Chinese remaindering. As many primes are
taken as the largest possible score of the pair needs. One pass over all pairs finds each
anchor's positives, a second one the negatives inside the score window of each positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plume.llm.blocks import paired
from plume.llm.common import stored
from plume.llm.topk import _tiles

TILE = 2048
ANCHOR_TILE = 512
#: odd primes below 256, largest first; balanced residues stay within 125
PRIMES = [p for p in range(251, 2, -2) if all(p % d for d in range(3, 16, 2) if d < p)]
_SECTION = (1 << 24) // 125 ** 2 - 1       # components whose products add up exactly in float32
_EMPTY = -(1 << 63)                        # no positive in this place


def quantised(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
              label_col: str = "label") -> DataFrame:
    """``vec_id, label, v``: every component as ``floor(scale * x)``. Rows with a null id or label, a null
    or empty vector, or a null or non-finite component take no part."""
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("x"))
            .where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(F.size("x") > 0).where(fine)
            .select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v")))


# ------------------------------------------------------------------ the residue number system

def balanced(v: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo the odd ``p`` between ``-(p // 2)`` and ``p // 2``."""
    r = v % p
    return r - p * (r > p // 2)


def moduli(bound: int) -> list[int]:
    """The first primes whose product is above twice ``bound``."""
    product = 1
    for i, p in enumerate(PRIMES, 1):
        product *= p
        if product > 2 * bound + 1:
            return PRIMES[:i]
    return PRIMES


def residues(q: np.ndarray, c: np.ndarray, p: int) -> np.ndarray:
    """``q @ c.T`` modulo ``p``, balanced, by float32 products of exact partial sums."""
    a, b = balanced(q, p).astype(np.float32), balanced(c, p).astype(np.float32)
    out = np.zeros((len(q), len(c)), np.int32)
    for s in range(0, q.shape[1], _SECTION):
        out += balanced((a[:, s:s + _SECTION] @ b[:, s:s + _SECTION].T).astype(np.int32), p)
    return balanced(out, p)


def reconstructed(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers of smallest size with these residues, by balanced mixed-radix digits."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        known, radix = np.zeros_like(parts[0]), 1            # what the digits so far make modulo p
        for t, prime in zip(digits, primes):
            known = (known + t * radix) % p
            radix = radix * prime % p
        digits.append(balanced((parts[k] - known) * (pow(radix, -1, p) if k else 1), p).astype(np.int32))
    value = digits[-1].astype(np.int64)
    for t, p in zip(digits[-2::-1], primes[-2::-1]):
        value = value * p + t
    return value


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two long matrices (wrapping beyond 64 bits, as a long does)."""
    def reach(m):
        return float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)).max())

    primes = moduli(int(reach(q) * reach(c) * (1 + 1e-9)) + 1)
    return reconstructed([residues(q, c, p) for p in primes], primes)


# ------------------------------------------------------------------ the passes

def _matrix(row: dict, name: str, dim: int) -> np.ndarray:
    return np.frombuffer(row[name], np.int64).reshape(-1, dim)


def _long(row: dict, name: str) -> np.ndarray:
    return np.frombuffer(row[name], np.int64)


def _first(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties to the smaller ids."""
    pick = np.arange(len(score))
    if len(score) > n:
        pick = np.flatnonzero(score >= np.partition(score, len(score) - n)[len(score) - n])
    order = np.lexsort((ids[pick], -score[pick]))[:n]
    return pick[order]


def _positives(n: int):
    """Of each anchor in a pair of blocks: the first ``n`` other rows of its label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                s = products(_matrix(row, "q_matrix", row["dim"]), _matrix(row, "matrix", row["dim"]))
                ids, label, key = _long(row, "ids"), _long(row, "label"), _long(row, "q_key")
                out = []
                for i, (own, of) in enumerate(zip(_long(row, "q_ids"), _long(row, "q_label"))):
                    same = np.flatnonzero((label == of) & (ids != own))
                    pick = same[_first(s[i, same], ids[same], n)]
                    out.append((np.full(len(pick), key[i]), ids[pick], s[i, pick]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                 ["key", "positive_id", "positive_score"])
    return run


def _negatives(n: int, places: int, low: int, high: int):
    """Of each anchor and positive in a pair of blocks: the first ``n`` rows of other labels in the window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                s = products(_matrix(row, "q_matrix", row["dim"]), _matrix(row, "matrix", row["dim"]))
                ids, label, key = _long(row, "ids"), _long(row, "label"), _long(row, "q_key")
                of, goals = _long(row, "q_label"), [_long(row, f"q_s{j}") for j in range(places)]
                out = [(np.empty(0, np.int64),) * 4]
                for i in range(len(key)):
                    windows = [(j, -(-low * int(g[i]) // 100), high * int(g[i]) // 100)
                               for j, g in enumerate(goals) if g[i] != _EMPTY]
                    if not windows:
                        continue
                    least, most = min(a for _, a, _ in windows), max(z for *_, z in windows)
                    pick = np.flatnonzero((label != of[i]) & (s[i] >= least) & (s[i] <= most))
                    pick = pick[np.lexsort((ids[pick], -s[i, pick]))]
                    falling = -s[i, pick]
                    for j, least, most in windows:
                        at = np.searchsorted(falling, -most)
                        here = pick[at:min(at + n, np.searchsorted(falling, -least, "right"))]
                        out.append((np.full(len(here), key[i]), np.full(len(here), j), ids[here], s[i, here]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                 ["key", "place", "negative_id", "negative_score"])
    return run


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         tile: int = TILE, anchor_tile: int = ANCHOR_TILE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Both inputs come from :func:`quantised`; anchors meet all vectors of their dimension. An
    anchor's positives are its first ``positives`` rows of the same label with another id. For each
    of them the first ``negatives`` rows of other labels come out whose score lies within
    ``low`` to ``high`` per cent of the positive's; a positive without any has no row here. First
    means the higher score, then the smaller id. Anchor rows that repeat an id, a label and a
    vector are answered once; repeated candidates each take a place. Empty inputs, and anchors
    without positives, give no rows.
    """
    spark = vectors.sparkSession
    parts = 4 * max(1, spark.sparkContext.defaultParallelism)
    candidates = stored(_tiles(vectors.repartition(parts), tile, ["label"]), "vector-blocks")
    asked = stored(anchors.distinct().withColumn("key", F.xxhash64("vec_id", "label", "v")), "anchors")
    groups = max(1, -(-asked.count() // anchor_tile))
    first = stored(_tiles(asked.repartition(groups), anchor_tile, ["key", "label"]), "anchor-blocks")
    found = (paired(first, candidates, parts, "ids", ("dim",))
             .mapInArrow(_positives(positives), "key long, positive_id long, positive_score long"))
    order = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    best = stored(found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
                  .select("key", (F.col("n") - 1).alias("place"), "positive_id", "positive_score"), "positives")
    goals = best.groupBy("key").agg(*[F.max(F.when(F.col("place") == j, F.col("positive_score"))).alias(f"s{j}")
                                      for j in range(positives)])
    goal = [f"s{j}" for j in range(positives)]
    ready = asked.join(goals, "key").select("vec_id", "v", "key", "label",
                                            *[F.coalesce(c, F.lit(_EMPTY)).alias(c) for c in goal])
    second = stored(_tiles(ready.repartition(groups), anchor_tile, ["key", "label", *goal]), "anchor-blocks")
    hits = (paired(second, candidates, parts, "ids", ("dim",))
            .mapInArrow(_negatives(negatives, positives, low, high),
                        "key long, place long, negative_id long, negative_score long"))
    order = Window.partitionBy("key", "place").orderBy(F.desc("negative_score"), "negative_id")
    kept = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return (kept.join(best, ["key", "place"]).join(asked.select("key", F.col("vec_id").alias("anchor_id")), "key")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
