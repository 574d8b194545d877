"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, in blocks of packed vectors. No score is
kept: a pass counts scores into each query's global histogram, the bin that holds the kth
value is cut finer by the next pass, and once that bin is one score wide the last pass
returns the rows above it plus, of the rows that tie at it, those with the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plume.llm.blocks import paired
from plume.llm.common import stored

TILE = 2048        # candidate vectors a block
QUERY_TILE = 512
BINS = 4096


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``vec_id, v``: every component as ``floor(scale * x)``. Rows with a null id, a null vector,
    an empty one, or a null or non-finite component take no part."""
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(F.size("x") > 0).where(fine)
            .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v")))


def _tiles(rows: DataFrame, size: int, extra: list[str]) -> DataFrame:
    """Pack rows into blocks: ids, the matrix (row-major longs) and one array per extra column."""
    names = ["ids", "matrix", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            cols = [b.column(0).to_numpy(), *(b.column(i).to_numpy() for i in range(2, b.num_columns))]
            counts = pc.list_value_length(b.column(1)).to_numpy()
            flat = b.column(1).flatten().to_numpy()
            at = np.cumsum(counts) - counts
            for dim in np.unique(counts).tolist():
                pick = np.flatnonzero(counts == dim)
                matrix = flat[at[pick][:, None] + np.arange(dim)]
                rest = held.setdefault(dim, [])
                rest.append((matrix, [c[pick] for c in cols]))
                while sum(len(m) for m, _ in rest) >= size:
                    rest = held[dim] = list(emit_cut(rest, size))
                    yield rest.pop(0)
        for dim, rest in held.items():
            if rest:
                yield block(np.concatenate([m for m, _ in rest]), [np.concatenate(c) for c in zip(*(c for _, c in rest))])

    def emit_cut(rest, size):
        matrix = np.concatenate([m for m, _ in rest])
        cols = [np.concatenate(c) for c in zip(*(c for _, c in rest))]
        yield block(matrix[:size], [c[:size] for c in cols])
        if len(matrix) > size:
            yield matrix[size:], [c[size:] for c in cols]

    def block(matrix, cols):
        arrays = [pa.array([cols[0].tobytes()], pa.binary()), pa.array([matrix.astype(np.int64).tobytes()], pa.binary()),
                  *(pa.array([c.tobytes()], pa.binary()) for c in cols[1:]), pa.array([matrix.shape[1]], pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, [*names, "dim"])

    return rows.select("vec_id", "v", *extra).mapInArrow(run, ", ".join(f"{n} binary" for n in names) + ", dim int")


def _scores(row: dict, extra: list[str]):
    """Scores (queries x candidates) with each query's own rows masked, ids, and the extra columns."""
    dim = row["dim"]
    ids, qids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
    c = np.frombuffer(row["matrix"], np.int64).reshape(-1, dim)
    q = np.frombuffer(row["q_matrix"], np.int64).reshape(-1, dim)
    if float(np.abs(q).max()) * float(np.abs(c).max()) * dim < 2 ** 53:      # products and sums are exact in doubles
        s = (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        s = q @ c.T
    return s, qids[:, None] != ids[None, :], ids, qids, [np.frombuffer(row[f"q_{e}"], np.int64) for e in extra]


def _histograms(k: int, bins: int):
    """Per query: counts by bin of the scores at or above ``lo``, cut after a block's k highest,
    which no result can lie below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                s, use, _, qids, (lo, width) = _scores(row, ["lo", "width"])
                out_q, out_b, out_n = [], [], []
                for i in range(len(qids)):
                    v = s[i][use[i]]
                    v = v[v >= lo[i]]
                    if len(v) > k:
                        kth = np.partition(v, len(v) - k)[len(v) - k]
                        v = v[v >= kth]
                    bin_, n = np.unique(np.minimum((v - lo[i]) // width[i], bins), return_counts=True)
                    out_q.append(np.full(len(bin_), qids[i]))
                    out_b.append(bin_)
                    out_n.append(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_b, out_n)],
                                                 ["vec_id", "bin", "n"])
    return run


def _survivors(k: int):
    """Per query: scores above the kth value, and of those equal to it the k smallest ids of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                s, use, ids, qids, (kth,) = _scores(row, ["lo"])
                out = [[], [], []]
                for i in range(len(qids)):
                    over = np.flatnonzero(use[i] & (s[i] > kth[i]))
                    ties = np.flatnonzero(use[i] & (s[i] == kth[i]))
                    if len(ties) > k:
                        ties = ties[np.argpartition(ids[ties], k - 1)[:k]]
                    pick = np.r_[over, ties]
                    out[0].append(np.full(len(pick), qids[i]))
                    out[1].append(ids[pick])
                    out[2].append(s[i][pick])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out],
                                                 ["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, tile: int = TILE, query_tile: int = QUERY_TILE,
          bins: int = BINS) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer inner products.

    Both inputs come from :func:`quantised`. Candidates are all vectors of the query's
    dimension but those with the query's own id; ties go to the smaller id; a query with fewer
    candidates returns them all. A query row that repeats an id and vector is answered once;
    repeated candidates each take a place. Empty inputs give an empty result.
    """
    spark = vectors.sparkSession
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    state = stored(queries.distinct(), "queries")
    # scores of a query lie within its norm times the largest norm
    reach = vectors.agg(F.max(size)).first()[0]
    asked, widest = state.agg(F.count("*"), F.max(size)).first()
    if reach is None or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    bound = int(reach * widest) + 2
    parts = 4 * max(1, spark.sparkContext.defaultParallelism)
    blocks = stored(_tiles(vectors, tile, []), "vector-blocks")
    asked = -(-asked // query_tile)
    # the kth value lies in [lo, lo + width * bins); both are the same for all queries at first
    width = -(-(2 * bound + 1) // bins)
    state = state.select("vec_id", "v", F.lit(-bound).cast("long").alias("lo"))
    while True:
        tiles = _tiles(state.repartition(asked).withColumn("width", F.lit(width).cast("long")), query_tile, ["lo", "width"])
        hist = (paired(tiles, blocks, parts, "ids", ("dim",))
                .mapInArrow(_histograms(k, bins), "vec_id long, bin long, n long")
                .groupBy("vec_id", "bin").agg(F.sum("n").alias("n")))
        over = F.sum("n").over(Window.partitionBy("vec_id").orderBy(F.desc("bin")))
        # the highest bin with k or more scores at or above it; without one, all scores are wanted
        cut = (hist.withColumn("over", over).groupBy("vec_id")
               .agg(F.coalesce(F.max(F.when(F.col("over") >= k, F.col("bin"))), F.min("bin")).alias("bin")))
        state = stored(state.join(cut, "vec_id", "left").select(
            "vec_id", "v", (F.col("lo") + F.coalesce("bin", F.lit(0)) * width).alias("lo")), "bounds")
        if width == 1:
            break
        width = -(-width // bins)
    tiles = _tiles(state.repartition(asked), query_tile, ["lo"])
    found = (paired(tiles, blocks, parts, "ids", ("dim",))
             .mapInArrow(_survivors(k), "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
