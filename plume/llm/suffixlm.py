"""Language-model scoring with a probabilistic suffix tree over words.

The tree's nodes are contexts of one or more preceding words. A context is considered where it
occurs often enough in the training documents, its own suffix is a node and it extends a considered
context; it is kept where its next-word distribution diverges from its suffix's by more than its
extra parameters cost. Each node's distribution keeps the words seen often enough, discounted, and
leaves the rest to its suffix, down to the smoothed word frequencies at the root. A word is scored
at the longest suffix of what precedes it that is a node.

Neither counts nor model ever meet in one place. Documents are tokenised once into chunks of
bounded size. Words, and then the (context, word) pairs of each depth, are dealt over buckets; each
chunk sends every bucket its own aggregated counts as one compressed run of sorted keys, the bucket
adds them up, numbers what it keeps and answers the chunk's run in the same order. What a pair adds
to its context is worked out by one of the chunks that have it, which knows the context's count and
the suffix's chance of the word already; contexts are then dealt over buckets likewise, which add up
the chunks' sums, choose the nodes and answer every chunk that has the context. Nothing is sent
twice. Chunks and answers are stored bucketed by chunk, so putting them together moves nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.llm.common import scratch, text_slices
from plume.session import remove

BUCKET_KEYS = 1 << 20     # keys of all chunks that a bucket gets
SALT_CHUNKS = 1 << 18     # chunks whose keys meet in one group
CHUNK_BYTES = 8 << 20     # text of one chunk; a longer document is a chunk of its own
DEPTH = 2                 # words of the longest context
MIN_COUNT = 128           # training occurrences of a context
CUT = 2                   # training occurrences of a next word that a node keeps
DISCOUNT = 0.75           # taken off each kept count
COST = 4.0                # nats that each kept next word has to gain

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9))


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts: their bytes, with A-Z lower-cased, end to end; their sizes; each one's text number."""
    arr = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if not len(arr) or ends[-1] == ends[0]:
        return np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = (ends[:-1] - ends[0])[np.diff(ends) > 0]
    first[edge] = inside[edge]
    start = np.flatnonzero(first)
    place = np.cumsum(inside)[start] - 1
    return (_FOLD[data[inside]], np.diff(np.r_[place, int(inside.sum())]),
            np.searchsorted(ends - ends[0], start, "right") - 1)


def bucket_of(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Buckets of (context, word) keys: a context's words of neighbouring numbers stay together."""
    k = keys.view(np.uint64)
    h = (k >> np.uint64(bits)) * _A + ((k & np.uint64((1 << bits) - 1)) >> np.uint64(16)) * _B
    h ^= h >> np.uint64(31)
    h *= _C
    return ((h ^ (h >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def planes(a: np.ndarray) -> bytes:
    """Compressed: all first bytes, then all second ones and so on, as the high ones are mostly equal."""
    return zstandard.compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def unplaned(b: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.frombuffer(zstandard.decompress(b), np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).ravel()


def packed(a: np.ndarray) -> bytes:
    """Non-negative whole numbers in the narrowest type, compressed."""
    a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
    return a.dtype.char.encode() + planes(a)


def unpacked(b: bytes) -> np.ndarray:
    return unplaned(b[1:], chr(b[0])).astype(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=0))


def unpacked_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b))


def packed_pairs(keys: np.ndarray, bits: int) -> bytes:
    """Sorted (context, word) keys: steps from context to context, and from word to word within one."""
    context, word = keys >> bits, keys & ((1 << bits) - 1)
    step = np.diff(context, prepend=0)
    steps = packed(step)
    return len(steps).to_bytes(4, "little") + steps + packed(np.where(step > 0, word, np.diff(word, prepend=0)))


def unpacked_pairs(b: bytes, bits: int) -> np.ndarray:
    size = 4 + int.from_bytes(b[:4], "little")
    step, word = unpacked(b[4:size]), unpacked(b[size:])
    total, start = np.cumsum(word), np.maximum.accumulate(np.where(step > 0, np.arange(len(step)), 0))
    return (np.cumsum(step) << bits) | (total - total[start] + word[start])


def distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, a place of each, each place's value number, and how often each occurs."""
    order = np.argsort(a)
    v = a[order]
    new = np.r_[np.ones(min(len(v), 1), bool), v[1:] != v[:-1]]
    number = np.empty(len(v), np.int32)
    number[order] = np.cumsum(new) - 1
    return v[new], order[new], number, np.diff(np.r_[np.flatnonzero(new), len(v)])


def by_bucket(at: np.ndarray, buckets: int) -> np.ndarray:
    """Stable order by bucket."""
    return np.argsort(at.astype(np.min_scalar_type(buckets)), kind="stable")


# ------------------------------------------------------------------ chunks

_CHUNK = ("chunk long, n_words long, n_tokens long, n_train long, ids binary, named binary, train binary, sizes binary, codes binary,"
          " words binary, part string")
_REMOVE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_COLUMNS = [c.split()[0] for c in _CHUNK.split(", ")]


def _by_chunk(df: DataFrame, tag: str, path: str | None = None, part: tuple[str, ...] = ()) -> DataFrame:
    """As ``stored``, bucketed by chunk: tables of the same session join without an exchange."""
    spark, name = df.sparkSession, f"plume_llm_{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        (df.write.partitionBy(*part).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")
         .option("path", path or scratch(spark, tag)).saveAsTable(name, format="parquet"))
    return spark.table(name)


def _for_now(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, for a table that nothing reads after the next one is written."""
    spark, path = df.sparkSession, scratch(df.sparkSession, tag)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _told(df: DataFrame, **columns):
    """Of a table, sums or largest values of columns, 0 without a row."""
    with _shuffles_removed(df.sparkSession):
        return df.agg(*[F.coalesce(f(c), F.lit(0)) for c, f in columns.items()]).first()


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs here leaves no shuffle files: Spark removes them as a job ends, not when the driver collects its garbage."""
    before = spark.conf.get(_REMOVE, None)
    spark.conf.set(_REMOVE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE)
        else:
            spark.conf.set(_REMOVE, before)


def _chunks(docs: DataFrame, chunk_bytes: int, path: str) -> DataFrame:
    """Documents as runs of word numbers, each ended by the number after the last word's; in a part of their own, which
    goes before the rest does, the words. Map only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, total = 0, [], 0
        kinds = [{"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[c.split()[1]] for c in _CHUNK.split(", ")]

        def close():
            nonlocal made
            made += 1
            base = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
            ids, named, train, data, sizes = (np.concatenate([h[i] for h in held]) for i in range(5))
            doc = np.concatenate([h[5] + b for h, b in zip(held, base)])
            n = np.bincount(doc, minlength=len(ids))
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [
                None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
            of = coded.indices.to_numpy()
            table = pa.table({"n": np.bincount(of, minlength=len(coded.dictionary)), "word": coded.dictionary})
            order = pc.sort_indices(table, [("n", "descending"), ("word", "ascending")])
            code = np.empty(len(order), np.uint32)
            code[order.to_numpy()] = np.arange(len(order))   # frequent words first, the many rare ones by text: both compress
            words = coded.dictionary.take(order).to_pylist()  # they hold no white space, so a blank can part them
            codes = np.full(len(doc) + len(ids), len(words), np.uint32)
            codes[np.arange(len(doc)) + doc] = code[of]
            chunk = (TaskContext.get().partitionId() << 32) + made
            row = [chunk, len(words) + 1, len(codes), int(n[train].sum() + train.sum()), ids.tobytes(), named.tobytes(), train.tobytes(),
                   (n + 1).astype(np.int64).tobytes(), planes(codes), None, "codes"]
            text = [chunk, *[None] * 8, _texts(words), "words"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(row, text), kinds)], _COLUMNS)

        for batch in batches:
            for b in text_slices(batch, 1):
                part = words_of(b.column(1))
                held.append((pc.fill_null(b.column(0), 0).to_numpy(), pc.is_valid(b.column(0)).to_numpy(zero_copy_only=False),
                             b.column(2).to_numpy(zero_copy_only=False), *part))
                total += len(part[0]) + b.num_rows
                if total >= chunk_bytes:
                    yield close()
                    held, total = [], 0
        if held:
            yield close()

    rows = docs.select(F.col("doc_id"), F.col("text"), ~F.col("held_out"))
    return _by_chunk(rows.mapInArrow(run, _CHUNK), "word-chunks", path, ("part",))


class Chunk:
    """One chunk's row with the answers it has got so far."""

    def __init__(self, row: dict):
        self.id = row["chunk"]
        self.codes = unplaned(row["codes"], np.uint32)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(np.frombuffer(row["train"], bool), self.sizes)

    def know(self, row: dict, how: How) -> None:
        """Counts and numbers of the words; the state at depth 1: contexts of one word, 0 at the start of a document."""
        count = unpacked(row["counts"])
        self.count, self.word = count[self.codes], unpacked(row["numbers"])[self.codes]
        self.base = ((count + 0.5) / (how.n + 0.5 * (how.v + 1)))[self.codes]
        self.context = np.r_[0, self.word[:-1]]
        self.context[self.first] = 0
        self.seen = np.r_[0, self.count[:-1]]
        self.seen[self.first] = count[-1]                    # as many starts as ends
        self.chance, self.known = self.base, np.ones(len(self.codes), bool)
        self.own = self.count                                # of the word after the context of the depth before
        self.inside = np.ones(len(self.codes), bool)         # whether so many words precede

    def asked(self, how: How) -> tuple[np.ndarray, np.ndarray]:
        """Places whose context may be a node, and those of them whose word may be a next word of it."""
        asked = self.known & self.inside & (self.seen >= how.min_count)
        return asked, asked & (self.own >= how.cut)          # a word follows no context more often than that one's suffix

    def keys(self, at: np.ndarray, bits: int) -> np.ndarray:
        return (self.context[at] << bits) | self.word[at]

    def pairs(self, how: How) -> tuple[np.ndarray, ...]:
        """The pairs this chunk asks for, by bucket and key, and their buckets; the places that ask, and the pair of each."""
        at = np.flatnonzero(self.asked(how)[1]).astype(np.int32)
        keys, _, of, _ = distinct(self.keys(at, how.bits))
        return _dealt(keys, bucket_of(keys, how.bits, how.buckets), how.buckets, at, of)

    def contexts(self, how: How, depth: int) -> tuple[np.ndarray, ...]:
        """Likewise the contexts."""
        at, homes = np.flatnonzero(self.asked(how)[0]).astype(np.int32), how.homes[depth - 1]
        keys, _, of, _ = distinct(self.context[at])
        return _dealt(keys, bucket_of(keys << how.bits, how.bits, homes), homes, at, of)

    def counted(self, answers: list[dict], how: How) -> tuple[np.ndarray, ...]:
        """What the buckets say of the pairs: counts, numbers as contexts of the next depth, which this chunk adds up; and as ``pairs``."""
        keys, to, at, of = self.pairs(how)
        n, number, own = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        start = np.searchsorted(to, np.arange(how.buckets + 1))
        for x in answers:
            part = slice(start[x["bucket"]], start[x["bucket"] + 1])
            n[part] = unpacked(x["n"])
            own[part] = np.unpackbits(unpacked(x["own"]).astype(np.uint8), count=len(n[part]))
            if x["number"] is not None:
                number[part][n[part] >= how.least] = unpacked_keys(x["number"]) * how.buckets + x["bucket"] + 1
        return n, number, own, keys, at, of

    def advance(self, row: dict, depth: int, how: How) -> None:
        """Take in the answers of one depth; the state moves on to the next one."""
        own, nxt = np.zeros(len(self.codes), np.int64), np.zeros(len(self.codes), np.int64)
        n, number, _, _, at, of = self.counted(row[f"pairs{depth}"] or [], how)
        own[at], nxt[at] = n[of], number[of]
        keys, to, at, of = self.contexts(how, depth)
        kept, s = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        start = np.searchsorted(to, np.arange(how.homes[depth - 1] + 1))
        for x in row[f"nodes{depth}"] or []:
            part = slice(start[x["bucket"]], start[x["bucket"] + 1])
            kept[part] = unpacked(x["kept"])
            s[part][kept[part] > 0] = unpacked(x["s"])
        node = np.zeros(len(self.codes), bool)
        node[at] = kept[of] > 0
        left = np.ones(len(self.codes))
        left[at] = (self.seen[at] - s[of] + how.discount * kept[of]) / self.seen[at]
        share = np.maximum(own - how.discount, 0) / np.maximum(self.seen, 1)
        self.chance = np.where(node, share + left * self.chance, self.chance)
        self.known = node
        inside = np.r_[False, self.inside[:-1]]
        inside[self.first] = False
        self.inside = inside
        self.context, self.seen, self.own = np.r_[0, nxt[:-1]], np.r_[0, own[:-1]], own


def _dealt(keys: np.ndarray, to: np.ndarray, buckets: int, at: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted keys and their buckets by bucket; the places, and the key of each in the new order."""
    order = by_bucket(to, buckets)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    return keys[order], to[order], at, place[of]


@dataclass(frozen=True)
class How:
    """The model's parameters, and what the corpus says of itself."""

    min_count: int
    cut: int
    discount: float
    cost: float
    n: int = 0
    v: int = 0
    word_buckets: int = 1
    bits: int = 1                          # of a word's number
    buckets: int = 1                       # of pairs
    homes: tuple[int, ...] = ()            # buckets of contexts, by depth

    @property
    def least(self) -> int:
        """Training occurrences of a pair that may be a context."""
        return max(self.min_count, self.cut)


def _opened(row: dict, how: How, depth: int) -> Chunk:
    c = Chunk(row)
    c.know(row, how)
    for d in range(1, depth):
        c.advance(row, d, how)
    return c


def _rows(f, schema: str):
    """``f`` on each row of a chunk table, one batch of columns a row."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                made = [pa.array(c) for c in f(b.slice(i, 1).to_pylist()[0])]
                if len(made[0]):
                    yield pa.RecordBatch.from_arrays(made, names)
    return run


def _split(at: np.ndarray, buckets: int):
    """Runs of equal buckets in a sorted array, the empty ones left out."""
    edge = np.searchsorted(at, np.arange(buckets + 1))
    return [(b, slice(edge[b], edge[b + 1])) for b in np.unique(at).tolist()]


_ASK = "bucket long, chunk long, keys binary, n binary, own binary, contexts long"
_SUMS = "bucket long, chunk long, keys binary, kept binary, s binary, total binary, p binary, gain binary"


def _words_by_bucket(row: dict, buckets: int) -> tuple[list[bytes], list[np.ndarray]]:
    """The chunk's words by code, and the codes of each bucket. The end is the word without a byte."""
    words = zstandard.decompress(row["words"])
    words = [*(words.split(b" ") if words else []), b""]
    at = (np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) % np.uint64(buckets)).astype(np.int64)
    order = by_bucket(at, buckets)
    return words, np.split(order, np.searchsorted(at[order], np.arange(1, buckets)))


def _word_asks(buckets: int):
    def f(row):
        c = Chunk(row)
        words, parts = _words_by_bucket(row, buckets)
        n = np.bincount(c.codes[c.train], minlength=len(words))
        parts = [(b, p) for b, p in enumerate(parts) if len(p)]
        return ([b for b, _ in parts], [c.id] * len(parts), [_texts([words[i] for i in p.tolist()]) for _, p in parts],
                [packed(n[p]) for _, p in parts], pa.array([None] * len(parts), pa.binary()), [0] * len(parts))
    return f


def _word_order(words: list[bytes], n: np.ndarray) -> np.ndarray:
    """Words by the bits of their counts, frequent ones first, then by text: a chunk can tell the order of those it has."""
    return pc.sort_indices(pa.table({"n": np.frexp(n)[1], "word": pa.array(words, pa.binary())}), [("n", "descending"), ("word", "ascending")]).to_numpy()


def _by_code(buckets: int, least: int):
    """The answers about a chunk's words in the order of their codes: counts, and numbers from 1 that no two buckets give, 0 for words
    rarer than ``least``; how many words are this chunk's to count, and the largest number."""
    def f(row):
        words, parts = _words_by_bucket(row, buckets)
        count, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for x in row["known"]:
            part, n = parts[x["bucket"]], unpacked(x["n"])
            count[part], keep = n, part[n >= least]
            number[keep[_word_order([words[i] for i in keep.tolist()], count[keep])]] = unpacked_keys(x["number"]) * buckets + x["bucket"] + 1
        return [row["chunk"]], [packed(count)], [packed(number)], [sum(x["types"] for x in row["known"])], [int(number.max(initial=0))]
    return f


def _asks(how: How, depth: int):
    """A chunk's pairs with their counts in its training documents, and how many contexts it will ask for."""
    def f(row):
        c = _opened(row, how, depth)
        keys, to, at, of = c.pairs(how)
        n = np.bincount(of[c.train[at]], minlength=len(keys))
        runs = _split(to, how.buckets)
        contexts = [len(np.unique(c.context[c.asked(how)[0]])), *[0] * len(runs)][:len(runs)]
        return ([b for b, _ in runs], [c.id] * len(runs), [packed_pairs(keys[s], how.bits) for _, s in runs], [packed(n[s]) for _, s in runs],
                pa.array([None] * len(runs), pa.binary()), contexts)
    return f


def _sums(how: How, depth: int):
    """A chunk's contexts, and what the pairs that it adds up say of them: how many, their counts, the suffix's chances, the gain."""
    def f(row):
        c = _opened(row, how, depth)
        n, _, own, _, at, of = c.counted(row[f"pairs{depth}"] or [], how)
        keys, to, asked, home = c.contexts(how, depth)
        place, of_place = np.empty(len(n), np.int32), np.zeros(len(c.codes), np.int32)
        place[of], of_place[asked] = at, home
        own &= n >= how.cut
        n, place = n[own], place[own]
        total, chance = c.seen[place], c.chance[place].astype(np.float32).astype(np.float64)

        def added(x):
            return np.bincount(of_place[place], weights=x, minlength=len(keys))
        kept, s, p, gain = added(np.ones(len(n))), added(n), added(chance), added(n * np.log(n / total / chance))
        most = np.zeros(len(keys), np.int64)
        most[of_place[place]] = total
        runs = _split(to, how.homes[depth - 1])
        some = [kept[r] > 0 for _, r in runs]
        return ([b for b, _ in runs], [c.id] * len(runs), [packed_keys(keys[r]) for _, r in runs], [packed(kept[r].astype(np.int64)) for _, r in runs],
                *[[packed(x[r][m].astype(np.int64)) for m, (_, r) in zip(some, runs)] for x in (s, most)],
                *[[planes(x[r][m]) for m, (_, r) in zip(some, runs)] for x in (p, gain)])
    return f


def _scores(how: How, depth: int):
    def f(row):
        c = _opened(row, how, depth)
        ids, named = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["named"], bool)

        def total(v):
            return np.add.reduceat(v, c.first)
        return (pa.array(ids, mask=~named), ~np.frombuffer(row["train"], bool), c.sizes, total((c.count > 0).astype(np.int64)),
                total(np.log10(c.base)), total(np.log10(c.chance)))
    return f


# ------------------------------------------------------------------ buckets

def _texts(words: list[bytes]) -> bytes:
    return zstandard.compress(b" ".join(words), 6)


def _words(blob: bytes) -> list[bytes]:
    return zstandard.decompress(blob).split(b" ")


def _first(of: np.ndarray, n: int) -> np.ndarray:
    """The first place of each of ``n`` numbers."""
    first = np.empty(n, np.int64)
    first[of[::-1]] = np.arange(len(of))[::-1]
    return first


def _owners(rows: pd.DataFrame, sizes: list[int]) -> np.ndarray:
    """The chunk that has each key, or what is packed of it where groups of chunks are added up."""
    return np.concatenate([np.full(n, c) if own is None else unpacked(own) for c, own, n in zip(rows["chunk"], rows["own"], sizes)])


def _one(rows: pd.DataFrame, **columns) -> pd.DataFrame:
    return pd.DataFrame({"bucket": rows["bucket"].iloc[:1].to_numpy(), "chunk": [int(rows["chunk"].iloc[0])], **{k: [v] for k, v in columns.items()}})


def _merged_words(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    words = [_words(b) for b in rows["keys"]]
    coded = pa.array([w for x in words for w in x], pa.binary()).dictionary_encode()
    of, k = coded.indices.to_numpy(), len(coded.dictionary)
    n = np.bincount(of, weights=np.concatenate([unpacked(x) for x in rows["n"]]), minlength=k).astype(np.int64)
    return _one(rows, keys=_texts(coded.dictionary.to_pylist()), n=packed(n),
                own=packed(_owners(rows, [len(x) for x in words])[_first(of, k)]), contexts=0)


def _merged_pairs(bits: int):
    def f(rows):
        rows = rows.sort_values("chunk")
        runs = [unpacked_pairs(x, bits) for x in rows["keys"]]
        keys, _, of, _ = distinct(np.concatenate(runs))
        n = np.bincount(of, weights=np.concatenate([unpacked(x) for x in rows["n"]]), minlength=len(keys)).astype(np.int64)
        return _one(rows, keys=packed_pairs(keys, bits), n=packed(n), own=packed(_owners(rows, [len(x) for x in runs])[_first(of, len(keys))]), contexts=0)
    return f


def _merged_sums(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    keys, _, of, _ = distinct(np.concatenate([unpacked_keys(x) for x in rows["keys"]]))
    some = np.concatenate([unpacked(x) for x in rows["kept"]])
    of, some = of[some > 0], some[some > 0]                  # the other sums are of these only

    def added(x):
        return np.bincount(of, weights=x, minlength=len(keys))
    s, total = (np.concatenate([unpacked(x) for x in rows[c]]) for c in ("s", "total"))
    p, gain = (added(np.concatenate([unplaned(x, np.float64) for x in rows[c]])) for c in ("p", "gain"))
    kept, s, most = added(some).astype(np.int64), added(s).astype(np.int64), np.zeros(len(keys), np.int64)
    most[of] = total                                         # the same in every chunk
    m = kept > 0
    return _one(rows, keys=packed_keys(keys), kept=packed(kept), s=packed(s[m]), total=packed(most[m]), p=planes(p[m]), gain=planes(gain[m]))


_ANSWER = "chunk long, bucket long, n binary, number binary, own binary, types long, top long, contexts long"
_NODES = "chunk long, bucket long, kept binary, s binary"


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _word_answers(least: int):
    """Counts, and the places in ``_word_order`` of the words that occur ``least`` times or more, in that order."""
    def f(asks, model):
        out = []
        for m in model.to_dict("records"):
            words, n, own = _words(m["keys"]), unpacked(m["n"]), unpacked(m["own"])
            keep = np.flatnonzero(n >= least)
            number = np.zeros(len(n), np.int64)
            number[keep[_word_order([words[i] for i in keep.tolist()], n[keep])]] = np.arange(len(keep))
            asked = [_words(x) for x in asks["keys"]]
            place = pc.index_in(pa.array([w for x in asked for w in x], pa.binary()), value_set=pa.array(words, pa.binary())).to_numpy()
            for chunk, at in zip(asks["chunk"], np.split(place, np.cumsum([len(x) for x in asked])[:-1])):
                out.append((chunk, m["bucket"], packed(n[at]), packed_keys(np.sort(number[at[n[at] >= least]])), None, int(((own[at] == chunk) & (n[at] > 0)).sum()), 0, 0))
        return _frame(out, _ANSWER)
    return f


def _pair_answers(how: How, last: bool):
    """Counts of the pairs that are frequent enough, 0 for the others; which of them the chunk adds up; the places in the bucket's order,
    which make their numbers, of those that may be contexts."""
    def f(asks, model):
        out = []
        for m in model.to_dict("records"):
            keys, n, own = unpacked_pairs(m["keys"], how.bits), unpacked(m["n"]), unpacked(m["own"])
            n[n < how.cut] = 0
            number = np.cumsum(n >= how.least) - 1
            top = int((number[-1] * how.buckets + m["bucket"] + 1) if len(number) and number[-1] >= 0 else 0)
            for chunk, blob, contexts in zip(asks["chunk"], asks["keys"], asks["contexts"]):
                at = np.searchsorted(keys, unpacked_pairs(blob, how.bits))
                out.append((chunk, m["bucket"], packed(n[at]), None if last else packed_keys(number[at[n[at] >= how.least]]),
                            packed(np.packbits((own[at] == chunk) & (n[at] > 0))), 0, top, contexts))
        return _frame(out, _ANSWER)
    return f


def _node_answers(how: How):
    """How many next words each context keeps, 0 where it is no node, and how often it is followed by them."""
    def f(asks, model):
        out = []
        for m in model.to_dict("records"):
            keys, kept, follow, total = unpacked_keys(m["keys"]), *(unpacked(m[c]) for c in ("kept", "s", "total"))
            p, gain = (unplaned(m[c], np.float64) for c in ("p", "gain"))
            rest, some, s = total - follow, total > follow, np.zeros(len(keys), np.int64)
            gain[some] += rest[some] * np.log(rest[some] / total[some] / np.maximum(1 - p[some], 1e-12))
            s[kept > 0] = follow
            kept[kept > 0] *= gain >= how.cost * (kept[kept > 0] + 1)
            for chunk, blob in zip(asks["chunk"], asks["keys"]):
                at = np.searchsorted(keys, unpacked_keys(blob))
                out.append((chunk, m["bucket"], packed(kept[at]), packed(s[at][kept[at] > 0])))
        return _frame(out, _NODES)
    return f


def _answered(asks: DataFrame, schema: str, merge, answer, answers: str, salts: int, tag: str) -> tuple[DataFrame, str]:
    """A bucket adds up what its chunks send and answers each. Where there are very many chunks, groups of them are added up
    first, and the sums go to each group. Written, with the folder: what was sent goes before the answers are dealt by chunk."""
    if salts == 1:
        return _for_now(asks.groupBy("bucket").applyInPandas(lambda rows: answer(rows, merge(rows)), answers), tag)
    asks = asks.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)))
    model = (asks.groupBy("bucket", "salt").applyInPandas(merge, schema).groupBy("bucket").applyInPandas(merge, schema)
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("salt", F.col("salt").cast("long")))
    return _for_now(asks.groupBy("bucket", "salt").cogroup(model.groupBy("bucket", "salt")).applyInPandas(answer, answers), tag)


def score(docs: DataFrame, fold: int = 5, held: int = 1, depth: int = DEPTH, min_count: int = MIN_COUNT, cut: int = CUT,
          discount: float = DISCOUNT, cost: float = COST, id_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = CHUNK_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    The model learns from the rows whose crc32 of the id as text, modulo ``fold``, is not ``held``;
    rows with a null id are learned from. ``base_score`` is the log10 probability under the root
    alone, ``score`` that under the tree. A null, empty or blank text is its end mark only. Repeated
    rows are counted and scored as often as they occur. Without training rows every probability is
    the root's (one). An empty table gives an empty result. Words and contexts are told apart exactly;
    a corpus whose numbers of frequent words and contexts take over 63 bits together raises OverflowError.
    A bucket gets about ``bucket_keys`` keys; more chunks than ``SALT_CHUNKS`` are added up in groups first.
    """
    out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % fold == held, F.lit(False))
    spark = docs.sparkSession
    chunks_at = scratch(spark, "word-chunks")
    stored = _chunks(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                                 out.alias("held_out")), chunk_bytes, chunks_at)
    chunks, texts = stored.where("part = 'codes'").drop("part", "words"), stored.where("part = 'words'").select("chunk", "words")
    n_chunks, n_words, n_tokens, n = _told(chunks, chunk=F.count, n_words=F.sum, n_tokens=F.sum, n_train=F.sum)
    salts, word_buckets = -(-max(n_chunks, 1) // SALT_CHUNKS), -(-max(n_words, 1) // bucket_keys)
    least = min(cut, min_count)
    buckets = -(-max(n_tokens, 1) // (2 * bucket_keys))             # at most every other place is its chunk's first of a key
    how = How(min_count, cut, discount, cost, n, word_buckets=word_buckets, buckets=buckets)
    # ---- words
    asks = chunks.select("chunk", "sizes", "train", "codes").join(texts, "chunk").mapInArrow(_rows(_word_asks(word_buckets), _ASK), _ASK)
    answers, answers_at = _answered(asks, _ASK, _merged_words, _word_answers(least), _ANSWER, salts, "word-answers")
    known = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "n", "number", "types")).alias("known"))
    columns = "chunk long, counts binary, numbers binary, types long, top long"
    words = _by_chunk(texts.join(known, "chunk").mapInArrow(_rows(_by_code(word_buckets, least), columns), columns), "words")
    v, top = _told(words, types=F.sum, top=F.max)
    how = replace(how, v=v, bits=max(top.bit_length(), 1))
    state = chunks.join(words.drop("types", "top"), "chunk")
    remove(spark, answers_at)
    remove(spark, f"{chunks_at}/part=words")
    # ---- the tree, one depth after the other
    for d in range(1, depth + 1):
        if top.bit_length() + how.bits > 63:
            raise OverflowError(f"{top} contexts and words of {how.bits} bits do not fit a key")
        asks = state.mapInArrow(_rows(_asks(how, d), _ASK), _ASK)
        answers, answers_at = _answered(asks, _ASK, _merged_pairs(how.bits), _pair_answers(how, d == depth), _ANSWER, salts, "pair-answers")
        pairs = _by_chunk(answers.groupBy("chunk").agg(
            F.collect_list(F.struct("bucket", "n", "number", "own")).alias(f"pairs{d}"), F.max("top").alias("top"),
            F.sum("contexts").alias("contexts")), f"pairs{d}")
        top, contexts = _told(pairs, top=F.max, contexts=F.sum)
        how = replace(how, homes=(*how.homes, -(-max(contexts, 1) // bucket_keys)))
        remove(spark, answers_at)
        state = state.join(pairs.drop("top", "contexts"), "chunk", "left")
        sums = state.mapInArrow(_rows(_sums(how, d), _SUMS), _SUMS)
        answers, answers_at = _answered(sums, _SUMS, _merged_sums, _node_answers(how), _NODES, salts, "node-answers")
        nodes = _by_chunk(answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "kept", "s")).alias(f"nodes{d}")), f"nodes{d}")
        remove(spark, answers_at)
        state = state.join(nodes, "chunk", "left")
    columns = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return (state.mapInArrow(_rows(_scores(how, depth + 1), columns), columns)
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"))
