import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from plume.llm import packing, tokencount, tokens
from tests.conftest import SF001

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
HARD = ["", None, " ", "a", "  two  spaces\n\n tab\t", "it's we'll 'S", "<|endoftext|> and <|x|>", "汉字 かな 한글", "🙂👩‍👩‍👧", "é ñ ß ÿ ſ ɐ ʰ", "  x",
        "1234567 ١٢٣", "a" * 3000, "word " * 20_000, "\x00\x1f\x7f"]


def ids(text):
    return EXACT.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_vocabulary_file(spark):
    texts = HARD + [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    texts += [chr(c) + " x" + chr(c) for c in range(0x250)]
    for t in texts:
        assert tokens.ids(t).tolist() == ids(t), repr(t)[:80]


def docs_of(spark, texts, first=0):
    rows = [(i + first, t, "x", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, length int, offset int")


def test_histogram_and_suffix_sums(spark):
    texts = HARD * 2 + ["b"] * 40
    n = [len(ids(t)) for t in texts]
    rows = {r.length: r for r in tokencount.count_tokens(docs_of(spark, texts)).collect()}
    assert sorted(rows) == sorted(set(n))
    for length, r in rows.items():
        over = [x for x in n if x >= length]
        assert (r.documents, r.documents_at_least, r.tokens_at_least) == (n.count(length), len(over), sum(over))
        assert (r.all_documents, r.all_tokens) == (len(n), sum(n))
        assert r.truncated_tokens == sum(min(x, length) for x in n)
        assert abs(r.quantile - sum(x <= length for x in n) / len(n)) < 1e-12
    sums = tokencount.suffix_sums(tokencount.histogram(docs_of(spark, texts)))
    limits = spark.createDataFrame([(c,) for c in (0, 1, 2, 7, 300, 10 ** 6, None, 7)], "context int")
    got = {r.context: (r.documents_cut, r.truncated_tokens) for r in tokencount.at_limits(sums, limits).collect()}
    assert got == {c: (sum(x > c for x in n), sum(min(x, c) for x in n)) for c in (0, 1, 2, 7, 300, 10 ** 6)}


def test_histogram_of_whole_table_and_of_nothing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    n = [len(ids(r.text)) for r in docs.collect()]
    got = tokencount.count_tokens(docs).collect()
    assert {r.length: r.documents for r in got} == {x: n.count(x) for x in n}
    assert tokencount.count_tokens(docs_of(spark, [])).collect() == []


def check_packing(rows, texts, first=0, capacity=2048):
    """Every id of every document is placed once, gapless, in sequences of at most the capacity."""
    sequences, pieces = {}, {}
    for r in rows:
        assert 1 <= r.length <= capacity
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= capacity
    for i, t in enumerate(texts):
        every = np.array([*ids(t), 0], "<u4")
        own = sorted(pieces[i + first], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(every)
        assert all(r.length == capacity for r in own[1:])
        assert len(own) == -(-len(every) // capacity)
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(every[at:at + r.length].tobytes())
            at += r.length
    return len(sequences)


def test_packing_round_trip(spark):
    texts = HARD + ["w " * n for n in (2046, 2047, 2048, 4095, 4096)]
    check_packing(packing.pack_documents(docs_of(spark, texts)).collect(), texts)
    assert packing.pack_documents(docs_of(spark, [])).collect() == []


def test_packing_of_whole_table_is_tight(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id")
    rows, texts = packing.pack_documents(docs).collect(), [r.text for r in docs.collect()]
    bins = check_packing(rows, texts)
    assert bins <= 1.03 * sum(r.length for r in rows) / 2048 + 1


def test_null_and_repeated_ids_are_packed(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (4, "c"), (4, "c")], "doc_id long, text string")
    rows = packing.pack_documents(df).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 2), (False, 2), (True, 3), (True, 3)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4


def test_levels_merge_underfull_bins(spark):
    rng = random.Random(4)
    for sizes in ([rng.randrange(1, 900) for _ in range(3000)], [1100] * 500 + [900] * 500, [1] * 5000, [1500] * 300):
        items = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)],
                                      "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(16)
        for how in ({}, {"level_items": 200}):
            used = {}
            for r in packing.pack(items, **how).collect():
                used.setdefault(r.sequence_id, []).append(r.length)
            assert sum(map(len, used.values())) == len(sizes) and max(map(sum, used.values())) <= 2048
            least = max(-(-sum(sizes) // 2048), sum(n > 1024 for n in sizes))
            assert len(used) <= 1.12 * least + 8, (len(used), least)


def test_best_fit_is_best_fit():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 60) for _ in range(400)]
    room = []
    for n in sorted(sizes, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= n
        else:
            room.append(100 - n)
    bins = packing.best_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(400))
    assert sorted(100 - sum(sizes[i] for i in b) for b in bins) == sorted(room)
