import random

import pytest

from plume.llm import linededup
from tests.conftest import SF001


def split(line, unit):
    words = line.encode().split()
    return words if unit == "word" else list(b" ".join(words).decode())


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def brute(rows, unit="word", least=linededup.MIN_TOKENS):
    """Every pair of distinct lines is compared."""
    first, places = {}, []
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for i, line in enumerate((text or "").split("\n")):
            t = tuple(split(line, unit))
            if t:
                places.append((doc, i, t))
                first.setdefault(t, (doc, i))
    near = {}
    by_n = {}
    for t in first:
        if len(t) >= least:
            by_n.setdefault(len(t), []).append(t)
    for t in first:
        for n in (len(t) - 1, len(t), len(t) + 1):
            for u in by_n.get(n, []) if len(t) >= least else []:
                if first[u] < first[t] and sum(x != y for x, y in zip(t, u)) <= (1 if n == len(t) else len(t)) and edit(t, u) <= 1:
                    near[t] = min(near.get(t, first[u]), first[u])
    out = set()
    for doc, i, t in places:
        if t in near:
            out.add((doc, i, *near[t], 1))
        elif (doc, i) != first[t]:
            out.add((doc, i, *first[t], 0))
    return out


def result(df, repeats=0, **how):
    rows = linededup.duplicate_lines(df, **how).collect()
    got = {tuple(r) for r in rows}
    assert len(got) + repeats == len(rows)
    return got


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 5, "x", 7, "y") for i, t in rows], "doc_id long, text string, n_chars long, line string, low int, near string")


def soup(seed, unit, n=60):
    rng = random.Random(seed)
    alphabet = ["ab", "cd", "é", "f."] if unit == "word" else list("abcé ")
    glue = " " if unit == "word" else ""
    lines = [[rng.choice(alphabet) for _ in range(rng.randrange(0, 14))] for _ in range(12)]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randrange(0, 5)):
            t = list(rng.choice(lines))
            for _ in range(rng.randrange(0, 3)):
                o, p = rng.random(), rng.randrange(len(t) + 1)
                if o < .3:
                    t.insert(p, rng.choice(alphabet))
                elif p < len(t):
                    t[p:p + 1] = [] if o < .6 else [rng.choice(alphabet)]
            out.append(glue.join(t))
        rows.append((rng.randrange(1000, 9999) * 100 + i, "\n".join(out)))
    return rows


@pytest.mark.parametrize("unit,least", [("word", 2), ("word", 8), ("char", 3)])
def test_random_lines_equal_brute_force(spark, unit, least):
    rows = soup(least, unit)
    want = brute(rows, unit, least)
    assert {0, 1} == {w[-1] for w in want}
    assert result(docs_of(spark, rows), unit=unit, min_tokens=least) == want


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_nulls_blanks_long_lines_and_repeats(spark):
    long = "word " * 20_000
    rows = [(5, None), (6, ""), (7, "\n\n \n"), (None, "the very same line"), (8, "the very same line"), (9, "the very  same\tline\nown"),
            (10, long + "x"), (11, long + "y\n" + long), (12, "the very same line"), (12, "the very same line")]
    got = result(docs_of(spark, rows), repeats=1)                  # document 12 is there twice
    assert got == {(9, 0, 8, 0, 0), (12, 0, 8, 0, 0), (11, 0, 10, 0, 1), (11, 1, 10, 0, 1)}


def test_texts_are_rebuilt(spark):
    a = "one two three four five six seven eight"
    rows = [(1, f"head\n{a}\n\ntail"), (2, f"{a}\nown line é\n{a} nine"), (3, None), (None, a), (4, ""), (5, "head")]
    docs = docs_of(spark, rows)
    out = linededup.drop_duplicate_lines(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    got = {r.doc_id: (r.text, r.n_chars, r.near) for r in out.collect()}
    assert got == {1: (f"head\n{a}\n\ntail", len(f"head\n{a}\n\ntail"), "y"), 2: ("own line é", 10, "y"), 3: (None, 5, "y"),
                   None: (a, len(a), "y"), 4: ("", 0, "y"), 5: ("", 0, "y")}


def test_empty_table(spark):
    docs = docs_of(spark, [])
    assert result(docs) == set() and linededup.drop_duplicate_lines(docs).collect() == []


def test_one_hot_line_and_one_hot_neighbourhood(spark):
    rows = [(i, f"a b c d e f g h i {i}\nshared line of the whole corpus") for i in range(300)]
    assert result(docs_of(spark, rows)) == brute(rows)


def test_variant_keys_meet_exactly_at_one_edit():
    rng = random.Random(3)
    lines = [[rng.choice([b"a", b"b"]) for _ in range(rng.randrange(1, 6))] for _ in range(150)]
    for x in lines[:40]:
        for y in lines:
            kx, ky = linededup.variant_keys(x), linededup.variant_keys(y)
            meet = kx[-1] in ky[:-1] or ky[-1] in kx[:-1] or kx[-1] == ky[-1] or (len(x) == len(y) and (kx[:-1] == ky[:-1]).any())
            assert meet == (edit(x, y) <= 1)
            assert linededup.within_one(x, y) == (edit(x, y) if edit(x, y) <= 1 else None)
            if edit(x, y) == 1:
                assert set(linededup.half_keys(x)) & set(linededup.half_keys(y))


def test_clashing_columns(spark):
    line = "one two three four five six seven eight nine"
    docs = spark.createDataFrame([(1, line, "a", 1, 2), (2, f"own line here\n{line}", "b", 3, 4)],
                                 "doc_id long, text string, __gone string, gone_doc int, gone_lines int")
    got = linededup.drop_duplicate_lines(docs)
    assert got.columns == docs.columns
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == [(1, line, "a", 1, 2), (2, "own line here", "b", 3, 4)]
