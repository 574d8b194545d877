import random

import numpy as np

from plume.llm import decontam
from tests.conftest import SF001


def edits(item, text):
    """Least edits of the item against any stretch of the text, over all places."""
    p, t = decontam.normalised(item), decontam.normalised(text)
    v, at = np.zeros(len(t) + 1, int), np.arange(len(t) + 1)
    for i, c in enumerate(p, 1):
        new = np.empty_like(v)
        new[0] = i
        new[1:] = np.minimum(v[:-1] + (t != c), v[1:] + 1)
        v = np.minimum.accumulate(new - at) + at
    return int(v.min())


def flat(text):
    return " ".join(text.lower().split())


def budget(item, q=decontam.Q, rate=decontam.RATE):
    m = len(decontam.normalised(item))
    return -1 if m < q else min(int(m * rate), (m - q) // q)


def tables(spark, texts, items):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in texts], "doc_id long, text string, item_id string, edits int, end int")
    return docs, spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id int")


def check(spark, texts, items, **how):
    docs, bench = tables(spark, texts, items)
    got = sorted((r.doc_id, r.item_id, r.edits) for r in decontam.contaminated(docs, bench, **how).collect())
    q, rate = how.get("q", decontam.Q), how.get("rate", decontam.RATE)
    want = sorted((d, i, edits(b, t)) for d, t in texts for i, b in items
                  if d is not None and i is not None and b and t and (
                      edits(b, t) <= budget(b, q, rate) or budget(b, q, rate) < 0 and f" {flat(b)} " in f" {flat(t)} "))
    assert got == want
    clean = decontam.drop_contaminated(docs, bench, q, rate)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(d for d, _ in texts) - {d for d, *_ in got})
    return got


def test_edited_passages_equal_brute_force(spark):
    rng = random.Random(6)
    words = ["tion", "the", "é", "ing", "on,", "Re.", "wh"]
    items = [(i, " ".join("".join(rng.choice(words) for _ in range(3)) for _ in range(rng.randrange(2, 40)))) for i in range(12)]
    texts = []
    for d in range(150):
        s = list(rng.choice(items)[1])
        for _ in range(rng.randrange(0, 20)):
            o, p = rng.random(), rng.randrange(len(s) + 1)
            if o < .3:
                s.insert(p, rng.choice("abé "))
            else:
                s[p:p + 1] = [] if o < .6 else [rng.choice("xyz")]
        pad = " ".join("".join(rng.choice(words) for _ in range(2)) for _ in range(rng.randrange(0, 30)))
        texts.append((d, rng.choice(["", pad, pad.upper() + "\n"]) + " " + "".join(s) + rng.choice(["", " " + pad])))
    got = check(spark, texts, items)
    assert len(got) > 20 and {e for *_, e in got} >= {0, 1, 2}
    check(spark, texts[:60], items, q=4, rate=0.1)


def test_whole_table_finds_every_exact_passage(spark):
    docs, bench = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    flat = lambda t: " ".join(t.lower().split())
    exact = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench.collect() if flat(b.text) in flat(d.text)}
    got = {(r.doc_id, r.item_id): r.edits for r in decontam.contaminated(docs, bench).collect()}
    assert {k for k, e in got.items() if e == 0} == exact and exact


def test_odd_rows(spark):
    item = "this is the benchmark passage that leaked"
    texts = [(9, "in SHORT,"), (10, "a\nShort  one"), (11, "shorter"), (1, None), (2, ""), (3, item), (4, item.upper().replace(" ", "\n\t")), (5, "x " * 60_000 + item + " y" * 60_000),
             (6, item[:20]), (7, (item + " ") * 500), (8, "汉" * 100)]
    items = [(1, item), (2, "short"), (3, None), (4, ""), (9, item), (5, "sixteen chars ok")]
    check(spark, texts, items)
    docs, bench = tables(spark, [(None, item), (None, item), (3, item), (3, item)], [(1, item), (1, item), (None, item)])
    assert sorted((r.doc_id is None, r.item_id) for r in decontam.contaminated(docs, bench).collect()) == [
        (False, 1), (False, 1), (True, 1), (True, 1)]
    assert decontam.drop_contaminated(docs, bench).collect() == []
    nameless = bench.where("item_id IS NULL")
    assert decontam.contaminated(docs, nameless).collect() == [] and decontam.drop_contaminated(docs, nameless).collect() == []


def test_repetitive_texts_take_bounded_memory():
    import resource
    rng = random.Random(1)
    item = "ha " * 666 + "ho"
    other = "ab" * 300 + " middle " + "ab" * 300
    it = decontam.index([(1, item), (2, other), (3, "ha " * 40)], window=decontam.EXCERPT)
    near = item[:700] + "X" + item[700:1300] + item[1303:]
    texts = ["ha " * 100_000, "ab" * 10_000, "ha " * 3000 + near, "".join(rng.choice("ah ") for _ in range(5_000))]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got = sorted((x, y, e) for x, y, e, *_ in decontam.matches(texts, it))
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000            # kB
    plain = decontam.index([(1, item), (2, other), (3, "ha " * 40)])
    for x, t in enumerate(texts[1:], 1):
        for y, b in enumerate((item, other, "ha " * 40)):
            if edits(b, t) <= budget(b):
                assert (0, y, edits(b, t)) in [(0, *m[1:3]) for m in decontam.matches([t], plain)]
                assert (x, y, edits(b, t)) in got
    assert (0, 2, 0) in got and {(x, y) for x, y, _ in got} >= {(2, 0), (2, 2), (1, 1)}


def test_empty_tables_and_blocks(spark):
    docs, bench = tables(spark, [(1, "a" * 40), (2, "b" * 40)], [(i, c * 30) for i, c in enumerate("abc")])
    assert decontam.contaminated(docs.limit(0), bench).collect() == []
    assert decontam.contaminated(docs, bench.limit(0)).collect() == []
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == 2
    for block in (1, 10 ** 6):
        got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, block_bytes=block).collect()}
        assert got == {(1, 0), (2, 1)}


def test_excerpts_are_found(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    lines = [" ".join(word() for _ in range(n)) for n in (14, 8, 11)]
    item, w = "\n".join(lines), decontam.EXCERPT
    flat = " ".join(item.split())
    pad = " ".join(word() for _ in range(20))
    texts = [(1, item), (2, f"{pad}\n{lines[0]}\n{lines[2]}\n{pad}"), (3, f"{pad}\n{lines[1]}"), (4, pad + " " + flat[:20]),
             (5, lines[0][:30] + "Z" + lines[0][31:])]
    whole = w + w // 3 - 1
    texts += [(100 + i, f"{pad} {flat[i:i + whole]} {pad}") for i in range(0, len(flat) - whole + 1, 7)]
    docs, bench = tables(spark, texts, [(1, item), (2, "another item that no document holds at all, in any part")])
    got = {r.doc_id: r for r in decontam.contaminated(docs, bench, window=w).collect()}
    assert set(got) == {d for d, _ in texts} - {4}
    assert (got[1].start, got[1].length, got[1].edits) == (0, len(flat), 0) and got[5].edits <= 1
    for d, r in got.items():
        assert edits(flat[r.start:r.start + r.length], dict(texts)[d]) == r.edits
    clean = decontam.drop_contaminated(docs, bench, window=w)
    assert [r.doc_id for r in clean.collect()] == [4] and clean.columns == docs.columns
    assert {r.doc_id for r in decontam.contaminated(docs, bench).collect()} == {1}


def test_pipeline_drops_what_line_dedup_left_of_an_item(spark, tmp_dir):
    import corpus_pipeline
    a, b = "the first line of the item is the longer one of the two lines", "and here is its second line"
    docs, bench = tables(spark, [(1, "a page\n" + a + "\nanother page"), (2, "clean")], [(1, f"{a}\n{b}\n{b} again")])
    bench.write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert [r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, tmp_dir).collect()] == [2]
