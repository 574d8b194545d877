import random

import numpy as np
import xxhash

from plume.llm import simhash
from plume.llm.components import components
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, fp string, component_id string, fingerprint long"


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits=4):
    """Union-find over all pairs of rows."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    members = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = find(i)
            members[r] = min(members.get(r, d), d)
    return [members.get(find(i)) for i in range(len(ids))]


def test_spark_xxhash64_is_the_hash(spark):
    from pyspark.sql import functions as F
    got = spark.createDataFrame([("héllo wörld a b",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % 2 ** 64 == xxhash.xxh64_intdigest("héllo wörld a b".encode(), 42)


def test_fingerprint_matches_the_definition():
    rng = random.Random(3)
    texts = ["", " \t\n", "One", "a b c", "A b C d", "é ß ü x y z", "w " * 700, "x\x0by\x0cz\u00a0q r s t"]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 900))) for _ in range(20)]
    for t in [*texts, None]:
        assert simhash.fingerprint(t) == brute_fingerprint(t), repr(t)[:60]


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = {r.doc_id: (f"{fp:016x}", c) for r, fp, c in zip(rows, fps, brute_components([r.doc_id for r in rows], fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == want


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(3, "same words in this text here", "x", "y", 1), (1, "same words in this text here", None, None, None),
            (1, "same words in this text here", "x", "y", 1), (None, "same words in this text here", "x", "y", 1),
            (7, None, "x", "y", 1), (6, "", "x", "y", 1), (8, " \n", "x", "y", 1), (None, "quite another text without a name", "", "", 0),
            (9, "long " * 50_000, "x", "y", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = simhash.near_duplicates(docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in got.collect() if r.component_id is not None) == [
        (False, 1, 1), (False, 1, 1), (False, 3, 1), (False, 6, 6), (False, 7, 6), (False, 8, 6), (False, 9, 9), (True, 0, 1)]
    assert got.count() == len(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.orderBy("doc_id").collect() if r.doc_id is not None] == [1, 6, 9]
    left = kept.where("doc_id IS NULL").count()
    assert left == len({r.fingerprint for r in got.where("component_id IS NULL").collect()})


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.drop_near_duplicates(docs).collect() == []


def _clustered(n, seed=1):
    rng = random.Random(seed)
    codes = [rng.getrandbits(64) for _ in range(60)]
    while len(codes) < n:
        c = rng.choice(codes)
        for b in rng.sample(range(64), rng.randrange(1, 8)):
            c ^= 1 << b
        codes.append(c)
    return np.array(sorted(set(codes)), np.uint64)


def _partition(codes, edges):
    root = {int(c): int(c) for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(int(a)), find(int(b))
        root[max(a, b)] = min(a, b)
    return {c: find(c) for c in root}


def test_index_loses_no_link():
    codes = _clustered(1200)
    far = np.bitwise_count(codes[:, None] ^ codes[None, :])
    want = _partition(codes, [(codes[i], codes[j]) for i, j in zip(*np.nonzero(far <= 4))])
    for cells in (1, 3):
        cell = np.arange(len(codes)) % cells
        same = cell[:, None] == cell[None, :]
        a, b = simhash.forest(cell, codes.copy(), 4)
        part = _partition(codes, [(codes[i], codes[j]) for i, j in zip(*np.nonzero((far <= 4) & same))])
        assert _partition(codes, zip(a, b)) == part
        if cells == 1:
            assert part == want


def test_bands_and_split_buckets_lose_no_link(spark):
    codes = _clustered(900, 5)
    far = np.bitwise_count(codes[:, None] ^ codes[None, :])
    want = _partition(codes, [(codes[i], codes[j]) for i, j in zip(*np.nonzero(far <= 4))])
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    for how in ({}, {"cell": 40}, {"bucket": 0}):
        edges = [(r.a % 2 ** 64, r.b % 2 ** 64) for r in simhash.links(df, 4, **how).collect()]
        assert _partition(codes, edges) == want, how


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7), (None, 3), (900, 901), (901, 900)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 540)}, 901: 900}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(7, text, 1, "x"), (7, text, 1, "x"), (7, text, 2, None), (7, text, None, "y"), (9, text, 1, "x"), (None, text, 1, "x"),
            (None, "all by itself " * 9, 1, "x"), (None, "all by itself " * 9, 1, "x"), (8, "quite another text " * 20, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_a int, kept_id string").withColumnRenamed("row_a", "row_id")
    docs = docs.withColumn("__copy", docs.doc_id).withColumn("fp", docs.doc_id)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text[:4]) for r in kept.collect()) == [
        (False, 7, "word"), (False, 8, "quit"), (True, 0, "all ")]
