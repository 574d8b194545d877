import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from plume.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=20):
    bags = [(i, Counter(t)) for i, x in docs if (t := terms(x))]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        ranked = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 12 * m))
                    for t in terms(text) if b[t])
            if s > 0:
                ranked.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(ranked, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, k=20, shard_bytes=lexical.SHARD_BYTES, **how):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, query string")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    index = lexical.build_index(d.repartition(3), shard_bytes=shard_bytes)
    return sorted((tuple(r) for r in lexical.search(index, q, k, **how).collect()), key=repr)


def corpus(rng, n, words=300, longest=60):
    vocab = [rng.choice(["ka", "Lo", "éÉ", "x1", "été", "Z"]) + str(int(rng.paretovariate(0.6))) for _ in range(words)]
    return [(i, rng.choice([" ", ", ", "-"]).join(rng.choices(vocab, range(words, 0, -1), k=rng.randint(0, longest))))
            for i in range(n)]


def test_terms_end_with_their_text_and_fold_ascii_only():
    texts = ["Ab", "cD éÉ_x", None, "", "…9\x00z", "--", "ñ"]
    data, sizes, doc = lexical.terms_of(pa.array(["skip", *texts])[1:])
    cut = np.split(data, np.cumsum(sizes)[:-1])
    assert [(int(d), bytes(c).decode()) for d, c in zip(doc, cut)] == [(i, t) for i, x in enumerate(texts) for t in terms(x)]


def test_random_corpus_small_shards(spark):
    rng = random.Random(7)
    docs = corpus(rng, 700)
    items = [(i, " ".join(rng.choices(docs[rng.randrange(700)][1].split() or ["x1"], k=9))) for i in range(25)]
    want = brute(docs, items, 5)
    assert run(spark, docs, items, 5, shard_bytes=3000) == want
    assert run(spark, docs, items, 5) == want
    assert run(spark, docs, items, 5, shard_bytes=3000, broadcast_bytes=0) == want


def test_long_lists_skip_blocks_and_stay_exact(spark):
    rng = random.Random(8)
    common = ["the", "of", "and"]
    docs = [(i, " ".join(rng.choices(common, k=rng.randint(1, 40)) + ([f"rare{i % 900}"] if i % 3 == 0 else []))) for i in range(3000)]
    bags = lexical.terms_of(pa.array([t for _, t in docs]))
    s = lexical.shard_of(np.arange(3000), np.ones(3000, bool), *bags)
    row = {k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in s.items()}
    shard = lexical.Shard(row, (s["docs"], s["tokens"]))
    known = {t: i for i, t in enumerate(shard.terms.to_pylist())}
    lists = [(known[t], w, int(shard.maxima(known[t]).max())) for t, w in ((b"the", 20), (b"of", 30), (b"rare0", 7000))]
    docs_found, scores = lexical.ranked(shard, lists, 3, 50_000_000)
    blocks = {int(b) for i, _, _ in lists for b in range(shard.blocks[i], shard.blocks[i + 1])}
    assert len(shard.decoded) < len(blocks) / 2            # most blocks were never decompressed
    every, all_scores = lexical.ranked(lexical.Shard(row, (s["docs"], s["tokens"])), lists, 3000, 1)
    best = sorted(zip((-all_scores).tolist(), every.tolist()))[:3]
    assert sorted(zip((-scores).tolist(), docs_found.tolist()))[:3] == [b for b in best if -b[0] >= 50_000_000]
    for i in range(len(shard.df)):                           # maxima are those of the blocks
        top = shard.maxima(i)
        assert [int(shard.postings(i, np.array([b]))[1].max()) for b in range(len(top))] == top.tolist()
    items = [(1, "the of rare3 the"), (2, "rare30"), (3, "and")]
    assert run(spark, docs, items, 20, shard_bytes=30000) == brute(docs, items)


def test_nulls_ties_repeats_and_long_texts(spark):
    same = "alpha beta"
    docs = ([(i, same) for i in (9, 3, 7, 7, None, None, -2)] + [(20, None), (21, ""), (22, "... !"), (None, "gamma"),
            (23, "delta " * 40000 + "omega"), (24, "word" * 50000), (25, "Alpha alpha gamma"), (26, "é")])
    items = [(1, "ALPHA"), (1, "ALPHA"), (1, "gamma delta"), (None, "beta beta"), (2, None), (3, ""), (4, "unknown"),
             (5, "word" * 50000), (6, "É é"), (7, "alpha " * 3000 + "omega")]
    assert run(spark, docs, items, 4, shard_bytes=40) == brute(docs, items, 4)
    assert run(spark, docs, items) == brute(docs, items)


def test_terms_in_every_document_and_empty_tables(spark):
    docs = [(1, "a b"), (2, "a"), (3, "a")]
    assert run(spark, docs, [(1, "a"), (2, "b")]) == brute(docs, [(1, "a"), (2, "b")])
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "?")], [(1, "a")]) == []
    assert run(spark, docs, []) == []
