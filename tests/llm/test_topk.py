import math
import random

from plume.llm import topk


def brute(rows, k, is_query):
    q = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
         if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for qi, qv in {(i, tuple(v)) for i, v in q if is_query(i)}:
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in q if i != qi and len(v) == len(qv))[:k]
        out |= {(qi, n + 1, i, -m) for n, (m, i) in enumerate(s)}
    return out


def run(spark, rows, k=10, **how):
    df = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<float>, v string")
    vectors = topk.quantised(df)
    got = topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k, **how).collect()
    assert len(got) == len({(r.query_id, r.rank) for r in got})
    return {tuple(r) for r in got}


def _f32(x):
    import numpy as np
    return float(np.float32(x))


def test_random_vectors_small_blocks(spark):
    rng = random.Random(2)
    rows = [(i, [_f32(rng.gauss(0, 1)) for _ in range(8)]) for i in range(420)]
    rng.shuffle(rows)
    want = brute(rows, 10, lambda i: i % 100 == 0)
    assert run(spark, rows, tile=50, query_tile=2, bins=16) == want
    assert run(spark, rows) == want


def test_ties_nulls_repeats_dimensions_and_few_candidates(spark):
    same = [1.0, -0.5]
    rows = [(i, same) for i in range(60)] + [(100, same), (100, same), (None, same), (61, None), (62, []), (63, [1.0, None]),
            (64, [1.0, float("nan")]), (65, [float("inf"), 0.0]), (200, [1.0, 2.0, 3.0]), (66, [-1.0, 0.0, 1.0]),
            (300, [0.5] * 5), (67, [1e6, -1e6])]
    assert run(spark, rows, tile=7, bins=4) == brute(rows, 10, lambda i: i % 100 == 0)


def test_scores_beyond_the_exact_range_of_doubles(spark):
    rows = [(i, [_f32(2.0 ** 18 + i), _f32(2.0 ** 18 - 3 * i)]) for i in range(150)]
    assert run(spark, rows, k=3) == brute(rows, 3, lambda i: i % 100 == 0)


def test_empty_inputs(spark):
    assert run(spark, []) == set()
    assert run(spark, [(1, [1.0])]) == set()
    assert run(spark, [(100, [1.0])]) == set()


def test_no_exchange_on_the_dimension_alone(spark):
    from plume.llm.blocks import paired
    vectors = topk.quantised(spark.range(40).selectExpr("id AS vec_id", "array(1D, double(id)) AS embedding"))
    tiles = topk._tiles(vectors.selectExpr("*", "0L AS lo"), 8, ["lo"])
    pairs = paired(tiles, topk._tiles(vectors, 8, []), 6, "ids", ("dim",))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "hashpartitioning(dim#" in plan and "part#" in plan
    assert pairs.count() == tiles.count() * topk._tiles(vectors, 8, []).count()
