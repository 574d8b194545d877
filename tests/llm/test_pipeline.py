import corpus_pipeline
from plume.llm import quality, registry
from tests.conftest import SF001
from tests.llm.test_decontam import budget, edits
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_tokens import check_packing


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_every_stage_equals_its_brute_force(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    stage = dict(corpus_pipeline.STAGES)
    from plume.llm.common import stored
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept = stored(stage[names[0]](spark, docs, SF001), "t")
    assert kept.schema == docs.schema
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    scores = quality.classify(docs, labels)
    assert set(by_id(kept)) == {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert 0 < kept.count() < docs.count()

    lined = stored(stage[names[1]](spark, kept, SF001), "t")
    before, after = by_id(kept), by_id(lined)
    gone = {}
    for doc, line, *_ in brute_lines([(r.doc_id, r.text) for r in before.values()]):
        gone.setdefault(doc, set()).add(line)
    assert gone and set(after) == set(before) and lined.columns == docs.columns
    for d, r in after.items():
        text = "\n".join(x for i, x in enumerate(before[d].text.split("\n")) if i not in gone.get(d, ()))
        assert (r.text, r.n_chars, r.lang, r.source) == (text, len(text), before[d].lang, before[d].source)

    single = stored(stage[names[2]](spark, lined, SF001), "t")
    rows = list(after.values())
    comps = brute_components([r.doc_id for r in rows], [brute_fingerprint(r.text) for r in rows])
    assert set(by_id(single)) == set(comps) and single.columns == docs.columns

    clean = stored(stage[names[3]](spark, single, SF001), "t")
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").collect()
    leaked = {d for d, r in by_id(single).items() for b in bench if edits(b.text, r.text) <= budget(b.text)}
    assert set(by_id(clean)) == set(by_id(single)) - leaked and clean.columns == docs.columns

    rows = stage[names[4]](spark, clean, SF001).collect()
    texts = by_id(clean)
    again = {d: i for i, d in enumerate(sorted(texts))}
    assert {r.doc_id for r in rows} == set(texts)

    class Row:
        def __init__(self, r):
            self.__dict__ = r.asDict() | {"doc_id": again[r.doc_id]}
    check_packing([Row(r) for r in rows], [texts[d].text for d in sorted(texts)])


def test_stages_take_empty_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        assert out.count() == 0


def test_registered(spark):
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {f"op{i}_" for i in range(1, 11)} == {n[:n.index("_") + 1] for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names and set(registry.oracle_sql()) <= set(__spark_entry__.oracle_sql())
