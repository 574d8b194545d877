import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest

from plume.llm import suffixlm

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HOW = dict(depth=3, min_count=4, cut=2, discount=0.75, cost=0.5)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD)) + [None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


class Tree:
    """The same model by plain dictionaries of words. None is the end, 0 the start of a document."""

    def __init__(self, docs, depth, min_count, cut, discount, cost):
        train = [words(t) for i, t in docs if not held(i)]
        self.count = Counter(w for t in train for w in t)
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.nodes, considered = {}, {()}
        for d in range(1, depth + 1):
            after = defaultdict(Counter)
            for t in train:
                seq = [0, *t]
                for i in range(d, len(seq)):
                    after[tuple(seq[i - d:i])][seq[i]] += 1
            grown = set()
            for s, c in after.items():
                total = sum(c.values())
                if total < min_count or (d > 1 and (s[1:] not in self.nodes or s[:-1] not in considered)):
                    continue
                grown.add(s)
                kept = {w: m for w, m in c.items() if m >= cut}
                p = {w: float(np.float32(self.chance(s[1:], w))) for w in kept}
                rest = total - sum(kept.values())
                gain = sum(m * math.log(m / total / p[w]) for w, m in kept.items())
                gain += rest * math.log(rest / total / max(1 - sum(p.values()), 1e-12)) if rest else 0
                if kept and gain >= cost * (len(kept) + 1):
                    left = (rest + discount * len(kept)) / total
                    self.nodes[s] = left, {w: (m - discount) / total for w, m in kept.items()}
            considered = grown

    def root(self, w):
        return (self.count[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def chance(self, s, w):
        while s and s not in self.nodes:
            s = s[1:]
        if not s:
            return self.root(w)
        left, own = self.nodes[s]
        return own.get(w, 0) + left * self.chance(s[1:], w)

    def state(self, seq, depth):
        """The longest suffix that is a node, reached through nodes only."""
        s = ()
        for d in range(1, min(depth, len(seq)) + 1):
            if tuple(seq[-d:]) not in self.nodes:
                break
            s = tuple(seq[-d:])
        return s

    def score(self, text, depth):
        seq, out = [0], 0.0
        for w in words(text):
            out += math.log10(self.chance(self.state(seq, depth), w))
            seq.append(w)
        return out


def corpus(rng, n):
    follow = {w: [rng.choice("abcdefgh") for _ in range(3)] for w in [x + y for x in "abcdefgh" for y in "abcdefgh"]}
    out = []
    for i in range(n):
        t = [rng.choice("abcdefgh"), rng.choice("abcdefgh")]
        while len(t) < rng.randint(2, 30):
            t.append(rng.choice(follow[t[-2] + t[-1]]) if rng.random() < 0.8 else rng.choice("abcdeXYZ") + str(rng.randrange(40)))
            t[-1] = t[-1] if len(t[-1]) == 1 else t[-1].upper()
            if len(t[-1]) > 1:
                t += [rng.choice("abcdefgh"), rng.choice("abcdefgh")]
        out.append((i, rng.choice([" ", "  ", "\n", "\t"]).join(t)))
    return out


def run(spark, docs, **how):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, held_out string").repartition(3)
    return sorted((tuple(r) for r in suffixlm.score(df, **how).collect()), key=repr)


def check(got, docs, **how):
    tree = Tree(docs, **how)
    want = sorted(((i, held(i), len(words(t)), sum(tree.count[w] > 0 for w in words(t)), tree.n,
                    sum(math.log10(tree.root(w)) for w in words(t)), tree.score(t, how["depth"])) for i, t in docs), key=repr)
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))     # noqa: E731
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)
    return tree


def test_words_end_with_their_text():
    texts = ["Ab", "cD é\x00x", None, "", "a\x0bb\x1fc", " \n"]
    data, sizes, doc = suffixlm.words_of(pa.array(["skip", *texts])[1:])
    cut = np.split(data, np.cumsum(sizes)[:-1])
    assert [(int(d), bytes(c).decode()) for d, c in zip(doc, cut)] == [(i, w) for i, t in enumerate(texts) for w in words(t)[:-1]]


def test_equals_the_plain_tree(spark):
    docs = corpus(random.Random(3), 500)
    got = run(spark, docs, chunk_bytes=2000, **HOW)
    tree = check(got, docs, **HOW)
    assert {len(s) for s in tree.nodes} == {1, 2, 3} and any(s[0] == 0 for s in tree.nodes)
    out = [r for r in got if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out)              # better than the root on documents not learned from
    check(run(spark, docs, **HOW), docs, **HOW)
    with mock.patch.object(suffixlm, "SALT_CHUNKS", 4):
        check(run(spark, docs, chunk_bytes=2000, bucket_keys=300, **HOW), docs, **HOW)


def test_every_node_is_a_distribution():
    tree = Tree(corpus(random.Random(3), 300), **HOW)
    for s in [(), *list(tree.nodes)[:60]]:
        assert sum(tree.chance(s, w) for w in [*tree.count, "never seen"]) == pytest.approx(1)


def test_nulls_repeats_long_and_empty_texts(spark):
    docs = [(i % 40, t) for i, t in corpus(random.Random(4), 120)]
    docs += [(None, "a b c"), (None, None), (200, None), (201, ""), (202, " \n\t "), (203, "a b " * 30000), (204, "w" * 300000), (205, "é É")]
    how = dict(HOW, depth=2)
    check(run(spark, docs, chunk_bytes=500, **how), docs, **how)


def test_empty_table_and_no_training_rows(spark):
    assert run(spark, [], **HOW) == []
    alone = [next((i, "a b") for i in range(100) if held(i))]
    assert run(spark, alone, **HOW) == [(alone[0][0], True, 3, 0, 0, 0.0, 0.0)]


def test_pair_keys_travel_as_steps():
    rng = np.random.default_rng(5)
    for bits in (1, 9, 21):
        for contexts in (1, 3, 1 << 40):
            keys = np.unique((rng.integers(0, contexts, 500) << bits) | rng.integers(0, 1 << bits, 500))
            assert suffixlm.unpacked_pairs(suffixlm.packed_pairs(keys, bits), bits).tolist() == keys.tolist()
    assert suffixlm.unpacked_pairs(suffixlm.packed_pairs(np.empty(0, np.int64), 3), 3).tolist() == []


def test_scoring_leaves_no_shuffle_files(spark):
    def shuffles():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in Path(d).rglob("shuffle_*")}

    docs = corpus(random.Random(6), 200)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).localCheckpoint()
    setting = spark.conf.get(suffixlm._REMOVE)
    before = shuffles()
    scored = suffixlm.score(df, chunk_bytes=2000, **HOW)
    for _ in range(20):                                      # they are removed in the background
        if not (left := shuffles() - before):
            break
        time.sleep(0.5)
    assert not left and spark.conf.get(suffixlm._REMOVE) == setting
    check(sorted((tuple(r) for r in scored.collect()), key=repr), docs, **HOW)


def test_a_pair_is_sent_once_a_chunk(spark):
    """Counts, questions and answers of a depth travel in one exchange each way: words, pairs and contexts of two depths."""
    docs = corpus(random.Random(7), 200)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).localCheckpoint()
    sent, answered = [], suffixlm._answered

    def spy(asks, *rest):
        sent.append(asks.count() - asks.select("bucket", "chunk").distinct().count())
        return answered(asks, *rest)
    with mock.patch.object(suffixlm, "_answered", spy):
        check(sorted((tuple(r) for r in suffixlm.score(df, chunk_bytes=2000, bucket_keys=300, **dict(HOW, depth=2)).collect()), key=repr),
              docs, **dict(HOW, depth=2))
    assert sent == [0] * 5
