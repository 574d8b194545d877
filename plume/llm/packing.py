"""Best-fit packing by hierarchical residual packing.

Partitions pack their pieces by best fit. Nearly full bins leave at once; underfull bins
become items themselves, meet in fewer partitions and are packed again by best fit, level
by level, until one partition is left or bins no longer combine. A level's task takes at
most ``level_items`` bins, and a bin has at most ``capacity`` members.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm import tokens
from plume.llm.common import stored

CAPACITY = 2048
FULL = 2040               # a bin this full leaves its level
LEVEL_ITEMS = 50_000
FAN_IN = 8


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, name: str = tokens.VOCABULARY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: a document's ids and then ``end_id``; longer
    ones are cut into ``capacity`` tokens, with the shorter piece first. Null text: the end id alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for key, text in zip(b.column(0), b.column(1)):
                all_ids = np.append(tokens.ids(text.as_py(), name), np.uint32(end_id)).astype("<u4")
                n, key = len(all_ids), key.as_py()
                at = [0, *range(n % capacity or capacity, n, capacity), n]
                for i, (s, e) in enumerate(zip(at, at[1:])):
                    doc.append(key)
                    piece.append(i)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(all_ids[s:e].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()),
                                              *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"))


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: items from large to small, each into the fullest bin that takes it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0                         # bit r: some bin has room r
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        n = sizes[i]
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
            bins[at].append(i)
        else:
            at, room = len(bins), capacity
            bins.append([i])
        left = room - n
        if left:
            by_room[left].append(at)
            open_rooms |= 1 << left
    return bins


_MEMBER = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>"
_BIN = f"bin long, used long, done boolean, members array<{_MEMBER}>"


def _placed(members: pa.StructArray, ends: np.ndarray) -> pa.StructArray:
    """Members of consecutive bins, each with its offset in its bin."""
    names = [f.name for f in members.type]
    before = np.r_[0, np.cumsum(members.field("length").to_numpy())]
    offset = before[:-1] - np.repeat(before[ends[:-1]], np.diff(ends))
    return pa.StructArray.from_arrays([pa.array(offset) if n == "offset" else members.field(n) for n in names], names)


def _level(level: int, capacity: int, full: int, items: int):
    """Pack the bins of a partition; at most ``items`` are held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        schema = pa.schema([("bin", pa.int64()), ("used", pa.int64()), ("done", pa.bool_())])

        def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            t = pa.Table.from_batches(held).combine_chunks()
            used = t.column("used").to_pylist()
            bins = best_fit(used, capacity)
            order = pa.array([i for x in bins for i in x], pa.int64())
            members = t.column("members").take(order).combine_chunks()
            members = members.chunk(0) if isinstance(members, pa.ChunkedArray) else members
            ends = np.cumsum(pc.list_value_length(members).to_numpy(zero_copy_only=False))
            ends = np.r_[0, ends[np.cumsum([len(x) for x in bins]) - 1]]
            merged = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _placed(members.flatten(), ends))
            total = [sum(used[i] for i in x) for x in bins]
            ids = [(level << 56) | (part << 32) | (made + k) for k in range(len(bins))]
            made += len(bins)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total, pa.int64()),
                                              pa.array([x >= full for x in total], pa.bool_()), merged],
                                             schema=schema.append(pa.field("members", merged.type)))

        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= items:
                yield from packed(held)
                held, n = [], 0
        if n:
            yield from packed(held)
    return run


def pack(items: DataFrame, capacity: int = CAPACITY, full: int = FULL, level_items: int = LEVEL_ITEMS,
         fan_in: int = FAN_IN) -> DataFrame:
    """``sequence_id, offset`` for every row of ``items`` (the columns of :func:`pieces`).

    Lengths are from 1 to ``capacity``. Pieces of the full capacity are sequences of their own.
    """
    spark = items.sparkSession
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    bins = items.select(F.lit(0).cast("long").alias("bin"), F.col("length").alias("used"), F.lit(False).alias("done"),
                        F.array(member).alias("members"))
    done, level, before = [], 0, None
    parts = max(1, spark.sparkContext.defaultParallelism)
    while True:
        packed = stored(bins.mapInArrow(_level(level, capacity, full, level_items), _BIN), f"bins-{level}")
        done.append(packed.where("done"))
        rest = packed.where("NOT done")
        left, level = rest.count(), level + 1
        last = parts == 1 and level > 1
        # bins over half full cannot take one another: a level that joins under one in fifty ends the tree
        stuck = before is not None and left > 0.98 * before and left > level_items
        if left == 0 or last or stuck:
            done.append(rest)
            break
        parts = min(max(1, parts // fan_in), -(-left // 100)) if left <= level_items * max(1, parts // fan_in) \
            else -(-left // level_items)
        before = left
        bins = rest.repartition(parts, F.xxhash64("bin"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.select(F.col("bin").alias("sequence_id"), F.explode("members").alias("m")).select(
        "m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, name: str = tokens.VOCABULARY, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pack every row of ``docs`` into sequences of at most ``capacity`` tokens, one row per piece.

    Null and empty texts give one piece that holds the end id. Rows with a null id, and
    repeated rows, are packed like any other. An empty table gives no rows.
    """
    return pack(stored(pieces(docs, capacity, 0, name, id_col, text_col), "pieces"), capacity)
