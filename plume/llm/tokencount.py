"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plume.llm import tokens
from plume.llm.common import stored

SPAN = 256     # lengths per block of the two-level prefix sums


def lengths(docs: DataFrame, name: str = tokens.VOCABULARY, text_col: str = "text") -> DataFrame:
    """``length, n``: partial histograms, one set of rows per Arrow batch. Null texts have length 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = Counter(len(tokens.ids(t.as_py(), name)) for t in b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                             ["length", "n"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "length long, n long")


def histogram(docs: DataFrame, name: str = tokens.VOCABULARY, text_col: str = "text") -> DataFrame:
    """``length, documents`` over all rows. Repeated rows count as often as they occur; an
    empty table gives no rows."""
    return lengths(docs, name, text_col).groupBy("length").agg(F.sum("n").alias("documents"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per distinct length, exactly: documents and tokens at or above it, documents and tokens
    in all, the share of documents that are no longer (``quantile``), and the tokens left if
    every document were cut at that length (``truncated_tokens``).

    Sums run in two levels, blocks of lengths and then lengths within a block, so no task
    holds more than a block. Between two lengths the answers follow from the next longer row
    (see :func:`at_limits`), so these rows answer every context limit.
    """
    h = hist.select(F.col("length").cast("long").alias("length"), F.col("documents").cast("decimal(38,0)").alias("d"))
    h = h.withColumn("t", (F.col("length").cast("decimal(19,0)") * F.col("d").cast("decimal(19,0)")).cast("decimal(38,0)"))
    h = h.withColumn("block", F.floor(F.col("length") / SPAN))
    inside = Window.partitionBy("block").orderBy(F.desc("length"))
    blocks = h.groupBy("block").agg(F.sum("d").alias("bd"), F.sum("t").alias("bt"))
    above = Window.orderBy(F.desc("block"))          # one row per block of lengths, each already summed
    blocks = blocks.select("block", (F.sum("bd").over(above) - F.col("bd")).alias("over_d"),
                           (F.sum("bt").over(above) - F.col("bt")).alias("over_t"),
                           F.sum("bd").over(Window.partitionBy()).alias("all_d"),
                           F.sum("bt").over(Window.partitionBy()).alias("all_t"))
    s = (h.withColumn("sd", F.sum("d").over(inside)).withColumn("st", F.sum("t").over(inside))
         .join(blocks, "block"))
    ge_d, ge_t = F.col("sd") + F.col("over_d"), F.col("st") + F.col("over_t")
    long = lambda c, n: c.cast("long").alias(n)
    return s.select(
        "length", long(F.col("d"), "documents"), long(ge_d, "documents_at_least"), long(ge_t, "tokens_at_least"),
        long(F.col("all_d"), "all_documents"), long(F.col("all_t"), "all_tokens"),
        ((F.col("all_d") - ge_d + F.col("d")).cast("double") / F.col("all_d").cast("double")).alias("quantile"),
        long(F.col("all_t") - ge_t + (ge_d.cast("decimal(19,0)") * F.col("length").cast("decimal(19,0)")), "truncated_tokens"))


def at_limits(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """Answers for any context limits (a column ``context`` of ``limits``): documents longer
    than it and the tokens left when every document is cut there. A null limit has no answer."""
    row = F.struct("length", "documents_at_least", "tokens_at_least", "all_documents", "all_tokens")
    nxt = (limits.select(F.col("context").cast("long").alias("context")).where("context IS NOT NULL").distinct()
           .join(sums.select(row.alias("s")), F.col("s.length") > F.col("context"), "left")
           .groupBy("context").agg(F.min("s").alias("s")))
    total = sums.agg(F.max("all_tokens").alias("tokens"))
    return nxt.join(total, F.lit(True), "left").select(
        "context", F.coalesce("s.documents_at_least", F.lit(0)).alias("documents_cut"),
        (F.col("tokens") - F.coalesce("s.tokens_at_least", F.lit(0))
         + F.coalesce("s.documents_at_least", F.lit(0)) * F.col("context")).alias("truncated_tokens"))


def count_tokens(docs: DataFrame, name: str = tokens.VOCABULARY, text_col: str = "text") -> DataFrame:
    return suffix_sums(stored(histogram(docs, name, text_col), "lengths"))     # texts are encoded once
