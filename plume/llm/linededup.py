"""Line dedup by a deletion-neighbourhood join.

A line is its sequence of tokens (words, or characters). Lines with equal tokens are copies.
Two lines of at least ``min_tokens`` tokens are also near-copies at one token edit (insert,
delete or substitute). Each line emits all variants with one token deleted, as hashed keys:

* an insertion or deletion makes one line a variant of the other;
* a substitution makes both lose the same place and leave the same variant.

So lines that share a variant key (with its place) are near-copies, and what a key has to
say about its members is one number, its earliest line. Keys are aggregated, never expanded
into pairs. Before variants are emitted, lines without any possible partner are set aside
exactly: at one edit, two lines agree on the half that the edit is not in, so only lines
that share a half with another line have variants to emit. Found neighbours are verified on
their tokens, and the earliest line (document id, then place) is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.llm.common import fresh, stored, text_slices

MIN_TOKENS = 8


def tokens_of(line: str, unit: str) -> list[bytes]:
    """Words (runs without ASCII white space), or the characters of these words joined by single spaces."""
    words = line.encode().split()
    if unit == "word":
        return words
    return [c.encode() for c in b" ".join(words).decode()]


def _digest(tokens: list[bytes], seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(b"\x00".join(tokens), seed)


def half_keys(tokens: list[bytes]) -> list[int]:
    """Keys of which two lines at one edit share at least one: about half of the tokens from
    either end. An edit cannot lie in both ends, so one end is equal in both lines. Ends come
    in steps of two tokens and follow the shorter line of a pair, which this line may be (its own
    length) or be one token above; mostly that is the same end, and one key serves both."""
    n, out = len(tokens), []
    for shorter in {n, n - 1}:
        h = 2 * (shorter // 4) if shorter >= 4 else shorter // 2
        out += [_digest(tokens[:h], 2 * h), _digest(tokens[n - h:], 2 * h + 1)]
    return list(dict.fromkeys(out))


def variant_keys(tokens: list[bytes]) -> np.ndarray:
    """Digest of the tokens without each place in turn; the whole line's digest comes last.

    A digest is a sum of token hashes times powers of their places, so all variants follow
    from one prefix and one suffix sum.
    """
    n = len(tokens)
    h = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in tokens), np.uint64, n)
    power = np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64))
    prefix = np.cumsum(h * power, dtype=np.uint64)
    # one place earlier: all terms after the gap move down by one power
    moved = np.r_[h[1:] * power[:-1], np.uint64(0)]
    suffix = np.cumsum(moved[::-1], dtype=np.uint64)[::-1]
    keys = np.r_[np.r_[np.uint64(0), prefix[:-1]] + suffix, prefix[-1:]]
    lengths = np.r_[np.full(n, n - 1, np.uint64), np.uint64(n)]
    keys ^= lengths * np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(32)
    return keys * np.uint64(0xBF58476D1CE4E5B9)


def within_one(a: list[bytes], b: list[bytes]) -> int | None:
    """Edits between token sequences if 0 or 1, else None."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return None
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    if len(a) == len(b):
        return 0 if p == len(a) else 1 if a[p + 1:] == b[p + 1:] else None
    return 1 if a[p + 1:] == b[p:] else None


def _scan(unit: str, min_tokens: int):
    """Every line with a token: where it is, its digest, and its half keys if it may have near-copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, 1):
                doc, at, low, high, halves = [], [], [], [], []
                for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for i, line in enumerate((text or "").split("\n")):
                        tokens = tokens_of(line, unit)
                        if not tokens:
                            continue
                        d = xxhash.xxh3_128_intdigest(b"\x00".join(tokens))
                        doc.append(key)
                        at.append(i)
                        low.append(d & 0xFFFFFFFFFFFFFFFF)
                        high.append(d >> 64)
                        halves.append(half_keys(tokens) if len(tokens) >= min_tokens else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(at, pa.int32()), _signed(low), _signed(high),
                     pa.array([None if h is None else np.array(h, np.uint64).view(np.int64) for h in halves],
                              pa.list_(pa.int64()))], ["doc_id", "line", "low", "high", "halves"])
    return run


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _pick(unit: str):
    """Text of the wanted lines of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, 1):
                doc, at, text = [], [], []
                for key, whole, wanted in zip(*(c.to_pylist() for c in b.columns)):
                    lines = (whole or "").split("\n")
                    for i in wanted:
                        if i < len(lines):
                            doc.append(key)
                            at.append(i)
                            text.append(lines[i])
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at, pa.int32()),
                                                  pa.array(text, pa.string())], ["doc_id", "line", "text"])
    return run


def _variants(unit: str):
    """One row per variant. ``place`` is the deleted place; -1 marks the line itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, 2, 1 << 20):
                keys = [variant_keys(tokens_of(t, unit)) for t in b.column(2).to_pylist()]
                n = np.array([len(k) for k in keys])
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                place[np.cumsum(n) - 1] = -1
                rows = pa.array(np.repeat(np.arange(len(n)), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(place.astype(np.int32)),
                     b.column(0).take(rows), b.column(1).take(rows)], ["key", "place", "doc_id", "line"])
    return run


def _verify(unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edits = [within_one(tokens_of(x, unit), tokens_of(y, unit))
                     for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())]
            ok = pa.array([e is not None for e in edits])
            yield pa.RecordBatch.from_arrays([c.filter(ok) for c in b.columns[:4]], ["doc_id", "line", "near_doc", "near_line"])
    return run


def duplicate_lines(docs: DataFrame, unit: str = "word", min_tokens: int = MIN_TOKENS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, line, kept_doc_id, kept_line, edits``: every line that an earlier line makes redundant.

    Lines are cut at newlines and counted from 0; "earlier" is by document id, then line. A line
    goes if an earlier line has equal tokens (``edits`` 0: the first such line is named), or if
    the first line of its tokens has an earlier line at one edit (``edits`` 1: the earliest is
    named). The earliest line of any group of neighbours always stays. Lines without tokens
    never go; lines under ``min_tokens`` tokens have no near-copies, only copies. Null and empty
    texts have no lines with tokens. Documents with a null id are not looked at: their lines
    could not be named. Rows that repeat an id share their places: a place comes out once for each
    row whose line there goes.
    """
    if unit not in ("word", "char"):
        raise ValueError("unit must be word or char")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                      ).where("doc_id IS NOT NULL")
    lines = stored(src.mapInArrow(_scan(unit, min_tokens), "doc_id long, line int, low long, high long, halves array<long>"),
                   "lines")
    # equal lines collapse to their first place, map side
    first = stored(lines.groupBy("low", "high").agg(
        F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves"))
        .select("low", "high", "first.doc_id", "first.line", "n", "halves"), "first-lines")
    keyed = first.where("halves IS NOT NULL").select(F.explode("halves").alias("half"), "doc_id", "line")
    shared = stored(keyed.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half"), "halves")
    wanted = (keyed.join(shared, "half", "left_semi").groupBy("doc_id")
              .agg(F.collect_set("line").alias("wanted")))          # at most a document's own lines
    # a merge join at every size: the side of the texts is never small, and the other one grows with it
    texts = stored(src.join(wanted.hint("merge"), "doc_id").mapInArrow(_pick(unit), "doc_id long, line int, text string")
                   .groupBy("doc_id", "line").agg(F.min("text").alias("text")), "line-texts")
    variants = stored(texts.mapInArrow(_variants(unit), "key long, place int, doc_id long, line int"), "variants")
    at = F.struct("doc_id", "line")
    per_place = variants.groupBy("key", "place").agg(F.min(at).alias("least"), F.count("*").alias("n"))
    itself = F.col("place") == -1
    per_key = stored(per_place.groupBy("key").agg(
        F.min(F.when(itself, F.col("least"))).alias("whole"), F.min(F.when(~itself, F.col("least"))).alias("cut"),
        F.sum("n").alias("n")).where("n > 1").select("key", "whole", "cut"), "variant-keys")
    same_place = stored(per_place.where("n > 1").select("key", "place", "least"), "variant-places")
    # a line itself meets the lines it is a variant of; a variant meets the line it equals and its own place
    by_edit = (variants.join(per_key, "key")
               .select("doc_id", "line", F.when(itself, F.col("cut")).otherwise(F.col("whole")).alias("near")))
    by_swap = variants.where(~itself).join(same_place, ["key", "place"]).select("doc_id", "line", F.col("least").alias("near"))
    near = (by_edit.unionByName(by_swap).where(F.col("near") < at)
            .groupBy("doc_id", "line").agg(F.min("near").alias("near")))
    pairs = (near.select("doc_id", "line", F.col("near.doc_id").alias("near_doc"), F.col("near.line").alias("near_line"))
             .join(texts, ["doc_id", "line"])
             .join(texts.select(F.col("doc_id").alias("near_doc"), F.col("line").alias("near_line"),
                                F.col("text").alias("near_text")), ["near_doc", "near_line"])
             .select("doc_id", "line", "near_doc", "near_line", "text", "near_text"))
    verified = pairs.mapInArrow(_verify(unit), "doc_id long, line int, near_doc long, near_line int")
    verdict = stored(first.join(verified, ["doc_id", "line"], "left").where("n > 1 OR near_doc IS NOT NULL").select(
        "low", "high", F.col("doc_id").alias("first_doc"), F.col("line").alias("first_line"), "near_doc", "near_line"), "verdicts")
    is_first = (F.col("doc_id") == F.col("first_doc")) & (F.col("line") == F.col("first_line"))
    return (lines.select("doc_id", "line", "low", "high").join(verdict, ["low", "high"])
            .where(~is_first | F.col("near_doc").isNotNull())
            .select("doc_id", "line", F.coalesce("near_doc", "first_doc").alias("kept_doc_id"),
                    F.coalesce("near_line", "first_line").alias("kept_line"),
                    F.when(F.col("near_doc").isNotNull(), 1).otherwise(0).alias("edits")))


def drop_duplicate_lines(docs: DataFrame, unit: str = "word", min_tokens: int = MIN_TOKENS, id_col: str = "doc_id",
                         text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """``docs``, all rows and columns, with redundant lines taken out of the text and, where the
    column exists, the character count renewed. A document may be left with an empty text."""
    doc, lines = fresh(docs, "gone_doc"), fresh(docs, "gone_lines")
    gone = stored(duplicate_lines(docs, unit, min_tokens, id_col, text_col).groupBy(F.col("doc_id").alias(doc))
                  .agg(F.collect_set("line").alias(lines)), "gone-lines")
    out = docs.join(gone.hint("merge"), F.col(id_col).cast("long") == F.col(doc), "left").drop(doc)
    at, counted = docs.columns.index(text_col), docs.columns.index(count_col) if count_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_slices(batch, at):
                cols = b.columns[:-1]
                texts = cols[at].to_pylist()
                for i, lines in enumerate(b.column(b.num_columns - 1).to_pylist()):
                    if lines:
                        lines = set(lines)
                        texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in lines)
                cols[at] = pa.array(texts, cols[at].type)
                if counted is not None:
                    n = [old if t is None else len(t) for t, old in zip(texts, cols[counted].to_pylist())]
                    cols[counted] = pa.array(n, cols[counted].type)
                yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1])

    return out.mapInArrow(run, docs.schema)
