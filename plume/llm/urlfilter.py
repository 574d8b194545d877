"""URL filters on a sorted digest array.

A list's rules are keyed by their 64-bit XXH64 digests, sorted and laid out in one flat file
image: lengths, digests, string offsets, verdicts, then the strings. Every worker memory-maps that
image, probes a batch of URLs with one vectorised binary search, and confirms each hit
against the stored string, so a digest collision cannot decide anything.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_IMAGE_BYTES = 64 << 20        # beyond this the list is not sent to the workers but joined
_MAGIC = b"URLDIGS1"


def pack_rules(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """File image of ``(verdict, host, path)`` rules; a rule that repeats keeps ``block`` over ``allow``."""
    verdicts: dict[str, str] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        key = _lower(host) + path
        verdicts[key] = max(verdict, verdicts.get(key, verdict))
    names = [k.encode() for k in verdicts]
    digest = np.array([xxhash.xxh64_intdigest(n) for n in names], np.uint64)
    order = np.lexsort((np.array(names, object), digest)) if names else np.empty(0, np.int64)
    names = [names[i] for i in order]
    offsets = np.cumsum([0, *map(len, names)]).astype("<u8")
    blocked = np.array([verdicts[n.decode()] == "block" for n in names], np.uint8)
    # the lengths worth probing, of hosts and of paths
    hosts = np.unique([len(h) for _, h, _ in rules]).astype("<u8")
    lengths = np.unique([len(p) for _, _, p in rules]).astype("<u8")
    return b"".join([_MAGIC, np.array([len(names), len(hosts), len(lengths)], "<u8").tobytes(), hosts.tobytes(), lengths.tobytes(),
                     digest[order].astype("<u8").tobytes(), offsets.tobytes(), blocked.tobytes(), *names])


class Rules:
    """A memory-mapped rule image."""

    def __init__(self, path: str):
        m = np.memmap(path, np.uint8, "r")
        if bytes(m[:8]) != _MAGIC:
            raise ValueError("not a rule image")
        n, h, k = (int(x) for x in m[8:32].view("<u8"))
        at = 32
        self.hosts = m[at:at + 8 * h].view("<u8").tolist()
        at += 8 * h
        self.lengths = m[at:at + 8 * k].view("<u8").tolist()
        at += 8 * k
        self.digests = m[at:at + 8 * n].view("<u8")
        at += 8 * n
        self.offsets = m[at:at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.blocked, self.strings = m[at:at + n], m[at + n:]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Rule number of each key, or -1. Rules that share a digest lie side by side and are all compared."""
        out = np.full(len(keys), -1)
        if not keys or not len(self.digests):
            return out
        d = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        lo, hi = np.searchsorted(self.digests, d), np.searchsorted(self.digests, d, "right")
        for i in np.flatnonzero(hi > lo).tolist():
            for j in range(lo[i], hi[i]):
                if bytes(self.strings[int(self.offsets[j]):int(self.offsets[j + 1])]) == keys[i]:
                    out[i] = j
        return out


@lru_cache(maxsize=4)
def _mapped(digest: str, image) -> Rules:
    """One file per worker process, in the folder Spark gives it; the broadcast can always rebuild it."""
    fd, path = tempfile.mkstemp(prefix=f"rules-{digest}-")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(image.value)
        return Rules(path)
    finally:
        os.unlink(path)           # the mapping keeps the pages, the folder keeps nothing


def _lower(host: str) -> str:
    return host.encode().lower().decode()


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path as written; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[end:]
    return _lower(rest[:end]), path[:next((i for i, c in enumerate(path) if c in "?#"), len(path))]


def candidates(host: str, path: str, hosts: list[int], lengths: list[int]) -> list[str]:
    """Keys of all rules that would fit: of the host and its parent domains those that have the length of
    some rule's host, with every prefix of the path that has the length of some rule's path. Longest
    first; ties in text order. As many as the rules have lengths, whatever the URL holds."""
    n = len(host)
    fit = [host[n - k:] for k in hosts if k == n or (k < n and host[n - k - 1] == ".")]
    keys = {h + path[:n] for h in fit for n in lengths if n <= len(path)}
    return sorted(keys, key=lambda k: (-len(k), k))


def _judge(image, digest: str, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = _mapped(digest, image)
        for b in batches:
            parts = [split_url(u.as_py()) for u in b.column(1)]
            keys, first = [], [0]
            for host, path in parts:
                keys += [k.encode() for k in candidates(host, path, rules.hosts, rules.lengths)]
                first.append(len(keys))
            at = rules.find(keys)
            rule, verdict = [], []
            for s, e in zip(first, first[1:]):
                hit = next((i for i in range(s, e) if at[i] >= 0), None)
                rule.append(None if hit is None else keys[hit].decode())
                verdict.append(default if hit is None else "block" if rules.blocked[at[hit]] else "allow")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
                 pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])
    return run


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", id_col: str = "page_id",
          url_col: str = "url", max_image_bytes: int = MAX_IMAGE_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` are ``(verdict, host, path)``. A rule fits its host and all subdomains if the
    URL's path starts with the rule's path; the longest rule (characters of host and path)
    wins. Without one, the digest array does not hold the URL and the verdict is ``default``.
    Null URLs and URLs without ``://`` have an empty host and path, which no rule with a host
    fits. An empty table gives no rows. A list whose image passes ``max_image_bytes`` must be
    given to :func:`judge_by_join`.
    """
    image = pack_rules(rules)
    if len(image) > max_image_bytes:
        raise ValueError(f"rule image of {len(image)} bytes is over {max_image_bytes}: use judge_by_join")
    shared = pages.sparkSession.sparkContext.broadcast(image)
    run = _judge(shared, xxhash.xxh64_hexdigest(image), default)
    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
            .mapInArrow(run, "page_id long, host string, path string, rule string, verdict string"))


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
                  url_col: str = "url") -> DataFrame:
    """As :func:`judge`, for lists of any size (``verdict, host, path``): distinct hosts and paths
    are expanded to candidate keys, and these join the list."""
    # few numbers: a host has at most 255 characters, a path some thousand
    hosts, lengths = ([r[0] for r in rules.select(F.length(c)).distinct().collect()] for c in ("host", "path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [split_url(u.as_py()) for u in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
                 pa.array([candidates(h, p, hosts, lengths) for h, p in parts], pa.list_(pa.string()))],
                ["page_id", "host", "path", "keys"])

    urls = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
            .mapInArrow(run, "page_id long, host string, path string, keys array<string>"))
    listed = (rules.select(F.concat(F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                    "path").alias("key"), "verdict").groupBy("key").agg(F.max("verdict").alias("verdict")))
    fits = (urls.select("host", "path", "keys").distinct().select("host", "path", F.explode("keys").alias("key"))
            .join(listed, "key").groupBy("host", "path")
            .agg(F.min(F.struct((-F.length("key")).alias("n"), F.col("key"), F.col("verdict"))).alias("won")))
    return urls.join(fits, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("won.key").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
