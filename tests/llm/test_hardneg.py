import math
import random

import numpy as np
import pytest

from plume.llm import hardneg


def brute(rows, is_anchor, n_pos=5, n_neg=3):
    q = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows
         if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for ai, al, av in {(i, lab, tuple(v)) for i, lab, v in q if is_anchor(i)}:
        s = sorted((-sum(a * b for a, b in zip(av, v)), i, lab) for i, lab, v in q if i != ai and len(v) == len(av))
        for p, pi, _ in [x for x in s if x[2] == al][:n_pos]:
            fit = [(-m, i) for m, i, lab in s if lab != al and 50 * -p <= 100 * -m <= 95 * -p][:n_neg]
            out += [(ai, pi, r, i, -p, m) for r, (m, i) in enumerate(fit, 1)]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows],
                               "vec_id long, embedding array<float>, label int, key string")
    v = hardneg.quantised(df)
    return sorted(tuple(r) for r in hardneg.mine(v, v.where("vec_id % 50 = 0"), **how).collect())


def _f32(x):
    return float(np.float32(x))


def vectors(rng, n, dim=6, labels=3):
    return [(i, [_f32(rng.gauss(0.1, 0.3)) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("dim, size", [(1, 3), (64, 300), (64, 1 << 20), (2500, 125), (3000, 1 << 24), (5, 1 << 29)])
def test_products_are_exact(dim, size):
    rng = np.random.default_rng(dim)
    q, c = rng.integers(-size, size + 1, (7, dim)), rng.integers(-size, size + 1, (9, dim))
    q[0], c[0], c[1] = size, size, -size
    want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in c] for a in q]
    assert hardneg.products(q, c).tolist() == want


def test_products_beyond_64_bits_wrap():
    q, c = np.array([[1 << 62, 1 << 62]]), np.array([[4, 5]])
    assert hardneg.products(q, c).tolist() == [[((9 << 62) + (1 << 63)) % (1 << 64) - (1 << 63)]]


def test_residues_stay_balanced_and_primes_reach_the_bound():
    assert hardneg.PRIMES[:4] == [251, 241, 239, 233] and hardneg.PRIMES[-1] == 3
    for bound in (0, 1, 125, 126, 10 ** 6, 10 ** 18, 1 << 126):
        assert math.prod(hardneg.moduli(bound)) > 2 * bound + 1
    v = np.arange(-600, 600)
    for p in (3, 251):
        r = hardneg.balanced(v, p)
        assert (np.abs(r) <= p // 2).all() and ((v - r) % p == 0).all()


def test_random_vectors_small_blocks(spark):
    rows = vectors(random.Random(3), 320)
    random.Random(4).shuffle(rows)
    want = brute(rows, lambda i: i % 50 == 0)
    assert len(want) > 20
    assert run(spark, rows, tile=40, anchor_tile=3) == want
    assert run(spark, rows) == want


def test_ties_nulls_repeats_and_dimensions(spark):
    same = [1.0, -0.5]
    rows = ([(i, same, 1) for i in range(20)] + [(i, [0.75, -0.25], 2) for i in range(100, 112)]
            + [(50, same, 1), (50, same, 1), (50, same, 2), (50, [0.5, 0.5], 1), (None, same, 1), (61, None, 1), (62, [], 1),
               (63, [1.0, None], 1), (64, [1.0, float("nan")], 1), (65, [float("inf"), 0.0], 2), (66, same, None),
               (150, [1.0, 2.0, 3.0], 1), (67, [0.5, 1.0, 1.5], 1), (68, [0.4, 0.9, 1.5], 2), (200, [0.0, 0.0], 1),
               (250, [-1.0, -1.0], 9), (101, [0.75, -0.25], 2)])
    assert run(spark, rows, tile=7, anchor_tile=2) == brute(rows, lambda i: i % 50 == 0)


def test_other_counts_and_empty_inputs(spark):
    rows = vectors(random.Random(5), 120, labels=2)
    assert run(spark, rows, positives=2, negatives=1) == brute(rows, lambda i: i % 50 == 0, 2, 1)
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0], 1)]) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
