import zlib

import numpy as np
import pytest

from plume.llm import quality
from tests.conftest import SF01

BAD, GOOD = "BUY!! NOW!! $$$ ### *** CHEAP!! ", "The quiet river turned past a mill, and nobody spoke of it again. "


def made(spark, n=80):
    rows = [(i, (BAD if i % 3 == 0 else GOOD) * (2 + i % 9), "c", 1.0, int(i % 3 != 0)) for i in range(n)]
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, y string, score double")
    return docs, spark.createDataFrame([(r[0], r[4], 0) for r in rows], "doc_id long, quality int, toxic int")


def test_held_out_accuracy_on_the_given_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.99
    assert got.count() == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_lang_and_source_do_not_matter(spark):
    docs, labels = made(spark)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality")
    a, b = ({r.doc_id: r.score for r in quality.classify(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_nulls_empty_long_and_repeats(spark):
    docs, labels = made(spark)
    model = quality.train(docs, labels.unionByName(labels).unionByName(
        spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 9, 0)], labels.schema)))
    odd = spark.createDataFrame([(1000, None, "", 0.0), (1001, "", "", 0.0), (1002, " \n\t", "", 0.0), (None, GOOD, "", 0.0), (None, GOOD, "", 0.0),
                                 (1003, GOOD * 30_000, "", 0.0), (1004, "x" * 500_000, "", 0.0), (1005, "汉字 🙂", "", 0.0)], docs.schema)
    rows = quality.score_documents(odd, model).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert by[1000] == by[1001] == by[1002] and len(by[None]) == 1 and min(by[None]) > 0.9 and min(by[1003]) > 0.9
    kept = quality.keep_good(docs.unionByName(odd), model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.where("doc_id < 80").collect()} == {i for i in range(80) if i % 3}


def test_no_labels_and_empty_tables(spark):
    docs, labels = made(spark, 9)
    assert quality.train(docs, labels.limit(0)) is None
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.keep_good(docs, None).count() == 9
    assert quality.classify(docs.limit(0), labels).collect() == []


def test_every_word_lies_in_one_passage_and_batching_changes_nothing():
    texts = [b"", b"one", b"a b " * 40, b" \n ", b"w" * 9000, b"x y z\n" * 500]
    x, of = quality.features(texts)
    assert [int((of == i).sum()) for i in range(len(texts))] == [1, 1, 2, 1, 1, 24]
    for i, t in enumerate(texts):
        alone, _ = quality.features([t])
        assert np.allclose(alone, x[of == i])


def test_gradients():
    rng = np.random.default_rng(0)
    x, of, y = rng.normal(size=(300, 5)).astype(np.float32), np.repeat(np.arange(60), 5), np.zeros(60)
    y[x.reshape(60, 5, 5)[:, :, 0].max(axis=1) > 1] = 1          # one passage decides the bag
    m = quality.fit(x, of, y, steps=900, decay=0)
    p = m.score(x, of)
    assert np.mean((p > 0.5) == y) > 0.95


@pytest.mark.parametrize("max_docs", [1, 10])
def test_the_training_bound_holds(spark, max_docs):
    docs, labels = made(spark)
    assert quality.train(docs, labels, max_docs) is not None


def _bags(seed=0):
    rng = np.random.default_rng(seed)
    doc_of = np.repeat(np.arange(5), [1, 4, 2, 7, 3])
    x = rng.normal(size=(len(doc_of), 6))
    weights = [rng.normal(size=s) for s in ((6, 4), 4, (4, 3), (4, 3), 3, 4)] + [np.float64(0.3)]
    return weights, x, doc_of, np.array([0.0, 1, 1, 0, 1])


def _naive(weights, x, doc_of):
    w, b, v, u, a, c, bias = weights
    out = []
    for d in range(doc_of.max() + 1):
        codes, marks = [], []
        for row in x[doc_of == d]:
            h = [np.tanh(sum(row[i] * w[i, j] for i in range(len(row))) + b[j]) for j in range(len(b))]
            t = [np.tanh(sum(h[i] * v[i, j] for i in range(len(h)))) for j in range(len(a))]
            g = [1 / (1 + np.exp(-sum(h[i] * u[i, j] for i in range(len(h))))) for j in range(len(a))]
            codes.append(h)
            marks.append(np.exp(sum(t[j] * g[j] * a[j] for j in range(len(a)))))
        z = [sum(m * h[j] for m, h in zip(marks, codes)) / sum(marks) for j in range(len(c))]
        out.append(1 / (1 + np.exp(-(sum(z[j] * c[j] for j in range(len(c))) + bias))))
    return np.array(out)


def test_forward_equals_a_plain_attention_loop():
    weights, x, doc_of, _ = _bags()
    assert quality._forward(weights, x, doc_of)[0] == pytest.approx(_naive(weights, x, doc_of), rel=1e-12)


def test_gradients_equal_finite_differences():
    weights, x, doc_of, y = _bags(1)

    def loss():
        p = quality._forward(weights, x, doc_of)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for k, grad in enumerate(quality._gradients(weights, x, doc_of, y)):
        for at in np.ndindex(np.shape(weights[k])):
            value, ends = weights[k][at] if at else weights[k], []
            for step in (1e-6, -1e-6):
                if at:
                    weights[k][at] = value + step
                else:
                    weights[k] = value + step
                ends.append(loss())
            if at:
                weights[k][at] = value
            else:
                weights[k] = value
            assert grad[at] == pytest.approx((ends[0] - ends[1]) / 2e-6, rel=1e-5, abs=1e-8)


def test_every_passage_of_a_long_document_is_learned_from(spark, monkeypatch):
    docs, labels = made(spark)
    seen = {}

    def fitted(x, doc_of, y):
        seen["passages"] = len(x)
        return None

    monkeypatch.setattr(quality, "fit", fitted)
    quality.train(docs, labels)
    short = seen["passages"]
    long_id = next(i for i in range(200, 300) if zlib.crc32(str(i).encode()) % 4 != 2)
    quality.train(docs.unionByName(spark.createDataFrame([(long_id, "word " * (quality.PASSAGE * 300), "", 0.0)], docs.schema)),
                  labels.unionByName(spark.createDataFrame([(long_id, 1, 0)], labels.schema)))
    assert seen["passages"] == short + 300
