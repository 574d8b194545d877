"""Ranked lexical search: Block-Max MaxScore over a document-partitioned inverted index.

Indexing is map-only: each task packs its documents into shards of bounded text size, one row a
shard. A posting list is cut into blocks of 128; a block holds gaps and term frequencies in the
fewest whole bytes, its last document, and the (frequency, length) pairs that no other posting of
the block beats, from which its score maximum follows once the corpus statistics are known.

Searching takes the queries in blocks. A first pass reads vocabularies only and sums document
frequencies and score bounds over all shards; the second one ranks. For each query the global
bounds tell which lists are essential: documents in none of them cannot reach the kth score.
Candidates from the essential lists are then checked against the block maxima of the others, and
only blocks that still hold a candidate are decompressed. Tasks keep one heap per query over all
their shards; the heaps are merged by score and id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plume.llm.blocks import paired
from plume.llm.common import stored, text_slices

SHARD_BYTES = 4 << 20        # text of one shard; a longer document is a shard of its own
BLOCK = 128                  # postings a block
QUERY_BLOCK = 256            # queries a block, of at most QUERY_BYTES of text unless one alone is longer
QUERY_BYTES = 1 << 20
BROADCAST_BYTES = 32 << 20   # query blocks up to this size are broadcast; beyond it they are joined
HEAPS = 1 << 18              # queries a task keeps heaps for before it emits them

_FOLD = np.zeros(256, np.uint8)      # 0: not part of a term
_FOLD[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLD[ord("a"):ord("z") + 1] = _FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)

INDEX = ("shard long, docs long, tokens long, unnamed long, ids binary, lengths binary, terms binary, term_sizes binary, "
         "df binary, last binary, widths binary, front_sizes binary, front_tf binary, front_n binary, payload binary")
_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All terms of the texts: their bytes, lower-cased and laid end to end, their sizes, and each one's text number."""
    arr = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if not len(arr) or ends[-1] == ends[0]:
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    data = _FOLD[np.frombuffer(arr.buffers()[2], np.uint8)[ends[0]:ends[-1]]]
    inside = data > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = (ends[:-1] - ends[0])[np.diff(ends) > 0]          # a text's first byte may start a term
    first[edge] = inside[edge]
    start = np.flatnonzero(first)
    place = np.cumsum(inside)[start] - 1
    return (data[inside], np.diff(np.r_[place, int(inside.sum())]),
            np.searchsorted(ends - ends[0], start, "right") - 1)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


# ------------------------------------------------------------------ building

def _width(v: np.ndarray) -> np.ndarray:
    """Bytes that each number needs: 1, 2 or 4."""
    return np.where(v < 1 << 8, 1, np.where(v < 1 << 16, 2, 4))


def shard_of(ids: np.ndarray, named: np.ndarray, data: np.ndarray, sizes: np.ndarray, doc: np.ndarray) -> dict | None:
    """The index of some documents: ``ids`` and whether they are ``named`` (not null) by document,
    and the terms of all documents with the document of each. None without any term."""
    n = np.bincount(doc, minlength=len(ids))
    order = np.lexsort((ids, ~named))
    order = order[n[order] > 0]
    if not len(order):
        return None
    rank = np.zeros(len(ids), np.int64)
    rank[order] = np.arange(len(order))
    coded = _binary(data, sizes).dictionary_encode()
    pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(order) + rank[doc], return_counts=True)
    code, at = pair // len(order), pair % len(order)
    df = np.bincount(code)
    first = np.repeat(np.cumsum(df) - df, df)
    place = np.arange(len(pair)) - first
    begin = np.flatnonzero(place % BLOCK == 0)
    count = np.diff(np.r_[begin, len(pair)])
    block = np.repeat(np.arange(len(begin)), count)
    gap = at - np.r_[0, at[:-1]] - 1
    gap[place == 0] = at[place == 0]
    wide, deep = _width(np.maximum.reduceat(gap, begin)), _width(np.maximum.reduceat(tf - 1, begin))
    size = count * (wide + deep)
    home = np.cumsum(size) - size
    payload = np.zeros(int(size.sum()), np.uint8)
    inner = np.arange(len(pair)) - begin[block]
    for values, width, base in ((gap, wide, home), (tf - 1, deep, home + count * wide)):
        to = base[block] + inner * width[block]
        for byte in range(4):
            some = width[block] > byte
            payload[to[some] + byte] = (values[some] >> (8 * byte)) & 255
    # of a block, the postings that none with a higher frequency matches in shortness
    length = n[order][at]
    by = np.lexsort((length, -tf, block))
    fall = length[by] + (len(begin) - block[by]) * (int(length.max()) + 1)
    least = np.minimum.accumulate(fall)
    keep = by[np.r_[True, fall[1:] < least[:-1]]]
    terms = coded.dictionary
    term_ends = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset:terms.offset + len(terms) + 1]
    return {"docs": len(order), "tokens": int(n.sum()), "unnamed": int((~named[order]).sum()),
            "ids": np.where(named, ids, 0)[order].astype(np.int64), "lengths": n[order].astype(np.uint32),
            "terms": np.frombuffer(terms.buffers()[2], np.uint8)[term_ends[0]:term_ends[-1]],
            "term_sizes": np.diff(term_ends).astype(np.uint32), "df": df.astype(np.uint32),
            "last": at[begin + count - 1].astype(np.uint32), "widths": (wide * 8 + deep).astype(np.uint8),
            "front_sizes": np.bincount(block[keep], minlength=len(begin)).astype(np.uint8),
            "front_tf": tf[keep].astype(np.uint32), "front_n": length[keep].astype(np.uint32), "payload": payload}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all rows of ``docs``, written to the shared folder. Map only.

    Every row is a document, rows that repeat an id among them; a null id is kept and ranks after
    all others. Rows without a term (null, empty or blank texts) are in no shard.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, total = 0, [], 0

        def close():
            nonlocal made
            base = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
            s = shard_of(*(np.concatenate([h[i] for h in held]) for i in range(4)),
                         np.concatenate([h[4] + b for h, b in zip(held, base)]))
            made += 1
            if s:
                s["shard"] = (TaskContext.get().partitionId() << 32) + made
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s[c].tobytes() if isinstance(s[c], np.ndarray) else s[c]]) for c in _NAMES], _NAMES)

        for batch in batches:
            for b in text_slices(batch, 1):
                ids = b.column(0)
                part = terms_of(b.column(1))
                held.append((pc.fill_null(ids, 0).to_numpy(), pc.is_valid(ids).to_numpy(zero_copy_only=False), *part))
                total += len(part[0])
                if total >= shard_bytes:
                    yield from close()
                    held, total = [], 0
        if held:
            yield from close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(run, INDEX), "lexical-index")


# ------------------------------------------------------------------ searching

class Shard:
    """One shard's row, opened. Lists are found by term, blocks decoded once."""

    def __init__(self, row: dict, corpus: tuple[int, int]):
        self.n_docs, (self.total_docs, self.total_tokens) = row["docs"], corpus
        self.terms = _binary(np.frombuffer(row["terms"], np.uint8), np.frombuffer(row["term_sizes"], np.uint32))
        self.df = np.frombuffer(row["df"], np.uint32).astype(np.int64)
        blocks = -(-self.df // BLOCK)
        self.blocks = np.r_[0, np.cumsum(blocks)]
        fronts = np.frombuffer(row["front_sizes"], np.uint8).astype(np.int64)
        self.fronts = np.r_[0, np.cumsum(fronts)]
        self.front_tf, self.front_n = (np.frombuffer(row[c], np.uint32) for c in ("front_tf", "front_n"))
        self.tops: dict[int, np.ndarray] = {}
        if row.get("payload") is None:                       # vocabulary only
            return
        self.ids, self.named = np.frombuffer(row["ids"], np.int64), self.n_docs - row["unnamed"]
        self.norms = self.norm(np.frombuffer(row["lengths"], np.uint32))
        self.last = np.frombuffer(row["last"], np.uint32).astype(np.int64)
        widths = np.frombuffer(row["widths"], np.uint8).astype(np.int64)
        self.wide, self.deep = widths >> 3, widths & 7
        self.count = np.full(int(self.blocks[-1]), BLOCK)
        self.count[self.blocks[1:] - 1] = self.df - (blocks - 1) * BLOCK
        self.home = np.r_[0, np.cumsum(self.count * (self.wide + self.deep))]
        self.payload = row["payload"]
        self.decoded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def find(self, terms: pa.Array) -> list[int | None]:
        return pc.index_in(terms, value_set=self.terms).to_pylist()

    def norm(self, n: np.ndarray) -> np.ndarray:
        """12 m, where m = 75 + (25 n N) div L."""
        if len(n) and 25 * int(n.max()) * self.total_docs >= 1 << 62:
            return np.array([12 * (75 + 25 * int(x) * self.total_docs // self.total_tokens) for x in n], np.int64)
        return 12 * (75 + 25 * n.astype(np.int64) * self.total_docs // self.total_tokens)

    def maxima(self, i: int) -> np.ndarray:
        """The largest impact in each block of a list."""
        if i not in self.tops:
            a, z = self.blocks[i], self.blocks[i + 1]
            lo, hi = self.fronts[a], self.fronts[z]
            impact = impacts(self.front_tf[lo:hi].astype(np.int64), self.norm(self.front_n[lo:hi]))
            self.tops[i] = np.maximum.reduceat(impact, self.fronts[a:z] - lo)
        return self.tops[i]

    def block(self, b: int, before: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block whose list has ``before`` as the document ahead of it."""
        if b not in self.decoded:
            n, at = int(self.count[b]), int(self.home[b])
            gaps = np.frombuffer(self.payload, f"<u{self.wide[b]}", n, at)
            tf = np.frombuffer(self.payload, f"<u{self.deep[b]}", n, at + n * int(self.wide[b])).astype(np.int64) + 1
            docs = np.cumsum(gaps.astype(np.int64) + 1) + before
            self.decoded[b] = docs, impacts(tf, self.norms[docs])
        return self.decoded[b]

    def postings(self, i: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a list, or of its blocks ``wanted`` (numbers within the list, ascending)."""
        a = int(self.blocks[i])
        wanted = range(int(self.blocks[i + 1]) - a) if wanted is None else wanted.tolist()
        parts = [self.block(a + w, int(self.last[a + w - 1]) if w else -1) for w in wanted]
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + norm)


def ranked(shard: Shard, lists: list[tuple[int, int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the shard that may be among the ``k`` best, and their scores, all at least ``floor``.

    ``lists`` holds a list's number, its weight in the query and its largest impact in the whole
    index. Every document of the shard that scores above the kth of those returned is among them,
    and those that tie with it, too.
    """
    none = np.empty(0, np.int64)
    lists = sorted(lists, key=lambda x: x[1] * x[2])
    sums = np.cumsum([0, *(w * top for _, w, top in lists)])
    split = int(np.searchsorted(sums[1:], floor))            # so many lists together stay below the floor
    if split == len(lists):
        return none, none
    score = np.zeros(shard.n_docs, np.int64)
    for j in range(len(lists) - 1, split - 1, -1):           # essential
        i, weight, top = lists[j]
        wanted = None
        if floor > 1:
            wanted = np.flatnonzero(weight * shard.maxima(i) + (sums[-1] - weight * top) >= floor)
            if not len(wanted):
                continue
        docs, impact = shard.postings(i, wanted)
        score[docs] += weight * impact
    found = np.flatnonzero(score)
    for j in range(split - 1, -1, -1):
        if len(found) >= k:
            floor = max(floor, int(np.partition(score[found], len(found) - k)[len(found) - k]))
        i, weight, _ = lists[j]
        found = found[score[found] + sums[j + 1] >= floor]
        if not len(found):
            return none, none
        last = shard.last[shard.blocks[i]:shard.blocks[i + 1]]
        home = np.searchsorted(last, found)
        there = home < len(last)
        best = np.zeros(len(found), np.int64)
        best[there] = weight * shard.maxima(i)[home[there]]
        stay = score[found] + best + sums[j] >= floor        # by the block's maximum, before it is decompressed
        found, home, there = found[stay], home[stay], there[stay]
        if there.any():
            docs, impact = shard.postings(i, np.unique(home[there]))
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            hit = docs[at] == found
            score[found[hit]] += weight * impact[at[hit]]
    found = found[score[found] >= floor]
    if len(found) > k:
        kth = np.partition(score[found], len(found) - k)[len(found) - k]
        over, ties = found[score[found] > kth], found[score[found] == kth]
        found = np.r_[over, ties[:k - len(over)]]            # documents are in the order of their ids
    return found, score[found]


def _query_blocks(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``block, items``: the distinct queries with their terms, repeats included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size = 0, [], 0

        def close():
            nonlocal made
            made += 1
            return pa.RecordBatch.from_pylist(
                [{"block": (TaskContext.get().partitionId() << 32) + made, "items": held}], schema=schema)

        for batch in batches:
            for key, ident, text in zip(*(c.to_pylist() for c in batch.columns)):
                data, sizes, _ = terms_of(pa.array([text], pa.string()))
                if held and (len(held) == QUERY_BLOCK or size + len(data) > QUERY_BYTES):
                    yield close()
                    held, size = [], 0
                held.append({"query": key, "id": ident, "terms": _binary(data, sizes).to_pylist()})
                size += len(data)
        if held:
            yield close()

    item = pa.struct([("query", pa.int64()), ("id", pa.int64()), ("terms", pa.list_(pa.binary()))])
    schema = pa.schema([("block", pa.int64()), ("items", pa.list_(item))])
    rows = stored(queries.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
                  .where("text IS NOT NULL").distinct()
                  .select(F.xxhash64("id", "text").alias("query"), "id", "text"), "query-rows")
    few = max(1, -(-rows.count() // QUERY_BLOCK))            # full blocks: a shard is sent to Python once for each
    return stored(rows.repartition(few).mapInArrow(run, "block long, items array<struct<query:long,id:long,terms:array<binary>>>"), "queries")


def _beside(index: DataFrame, blocks: DataFrame, small: bool) -> DataFrame:
    """Every shard beside every query block: a stated query set against all rows, in blocks."""
    if small:
        return index.crossJoin(F.broadcast(blocks.select(*[F.col(c).alias(f"q_{c}") for c in blocks.columns])))
    return paired(blocks, index, 4 * max(1, index.sparkSession.sparkContext.defaultParallelism), "shard")


def _statistics(corpus: tuple[int, int]):
    """Per term of a query block: its document frequency and largest impact in a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                shard = Shard(row, corpus)
                at = [(t, i) for t, i in zip(row["q_terms"], shard.find(pa.array(row["q_terms"], pa.large_binary())))
                      if i is not None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["q_block"]] * len(at), pa.int64()), pa.array([t for t, _ in at], pa.binary()),
                     pa.array([int(shard.df[i]) for _, i in at], pa.int64()),
                     pa.array([int(shard.maxima(i).max()) for _, i in at], pa.int64())], ["block", "term", "df", "top"])
    return run


def _search(corpus: tuple[int, int], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}     # by query: scores, nameless, ids

        def emit():
            rows = [np.concatenate(x) for x in zip(*((np.full(len(s), q), s, u, i) for q, (s, u, i) in heaps.items()))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(rows[3], mask=rows[2])],
                                                 ["query", "score", "doc_id"])
            heaps.clear()

        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                shard = Shard(row, corpus)
                terms = row["q_terms"]
                known = {t["term"]: (at, t["weight"], t["top"])
                         for t, at in zip(terms, shard.find(pa.array([t["term"] for t in terms], pa.large_binary())))
                         if at is not None and t["weight"] > 0}
                for item in row["q_items"]:
                    times: dict[bytes, int] = {}
                    for t in item["terms"]:
                        times[t] = times.get(t, 0) + 1
                    lists = [(at, n * weight, top) for t, n in times.items() if t in known
                             for at, weight, top in (known[t],)]
                    if not lists:
                        continue
                    held = heaps.get(item["query"])
                    full = held is not None and len(held[0]) == k
                    docs, scores = ranked(shard, lists, k, max(1, int(held[0][-1])) if full else 1)
                    if len(docs):
                        new = scores, docs >= shard.named, shard.ids[docs]
                        s, u, d = new if held is None else (np.concatenate(x) for x in zip(held, new))
                        best = np.lexsort((d, u, -s))[:k]
                        heaps[item["query"]] = s[best], u[best], d[best]
                if len(heaps) >= HEAPS:
                    yield from emit()
        yield from emit()
    return run


def search(index: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text",
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of :func:`build_index` that score highest, above 0, per query.

    Equal scores go by ascending id, null ids last. Repeated query rows are answered once; rows that
    share an id but not a text are answered each, with ranks of their own. Null and blank queries,
    queries without a term of the corpus, and an empty index give no rows.
    """
    spark = index.sparkSession
    n, total = index.agg(F.sum("docs"), F.sum("tokens")).first()
    blocks = _query_blocks(queries, id_col, text_col)
    size = blocks.agg(F.sum(F.aggregate("items", F.lit(0), lambda a, x: a + F.aggregate(
        x["terms"], F.lit(16), lambda b, t: b + F.octet_length(t) + 24)).cast("long"))).first()[0]
    if not n or not size:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    small, corpus = size <= broadcast_bytes, (n, total)
    words = blocks.select("block", F.array_distinct(F.flatten("items.terms")).alias("terms"))
    vocabulary = index.select("shard", "docs", "terms", "term_sizes", "df", "front_sizes", "front_tf", "front_n")
    stats = (_beside(vocabulary, words, small).mapInArrow(_statistics(corpus), "block long, term binary, df long, top long")
             .groupBy("block", "term").agg(F.sum("df").alias("df"), F.max("top").alias("top")))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1)))
    weighed = stats.groupBy("block").agg(F.collect_list(F.struct("term", weight.alias("weight"), "top")).alias("terms"))
    ready = stored(blocks.join(weighed, "block"), "weighed-queries")       # a block's own terms, bounded like its text
    found = _beside(index, ready, small).mapInArrow(_search(corpus, k), "query long, score long, doc_id long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = ready.select(F.explode("items").alias("x")).select(F.col("x.query").alias("query"), F.col("x.id").alias("item_id"))
    return best.join(names, "query").select("item_id", "rank", "doc_id", "score")
