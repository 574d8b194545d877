import random
import re

from pyspark.sql import functions as F

from plume.llm import license, license_rules
from tests.conftest import SF001

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NORM = re.compile("[^0-9a-z.+/:\x80-\U0010ffff-]+")
RULES = [(label, level, key, re.compile(p)) for label, level, key, p in license_rules.rules()]
BASE = [(p.split(), label) for p, label in license.BASE]


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places, base = [], set()
    for phrase, label in BASE:
        at = [i for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
        places += at
        base |= {label} if at else set()
    norm = NORM.sub(" ", low)
    found = []
    if any(a in low for a in license_rules.ANCHORS):
        for n, (label, level, key, p) in enumerate(RULES):
            if key in norm:
                found += [(m.start(), m.end(), level, n, label) for m in p.finditer(norm)]
    found.sort(key=lambda d: (d[0], -d[1], -d[2], d[3]))
    kept = [d for i, d in enumerate(found) if not any(e[1] >= d[1] and e[2] >= d[2] for e in found[:i])]
    labels = base | {d[4] for d in kept}
    score = max([license.WEIGHTS[d[2] - 1] for d in kept] + [license.WEIGHTS[0]] * bool(base) + [0.0])
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


TEXTS = ["", None, " ", "CC BY", "cc\n\tby cc--by CC-BY-SA 4.0", "xcc by", "cc byé", "Key cc BY", "All rights\x00reserved. ALL RIGHTS RESERVED",
         "GNU General Public License v3.0 or later", "GNU Lesser General Public License version 2.1", "general public\nlicense" * 3,
         "SPDX-License-Identifier: Apache-2.0", "SPDX-License-Identifier: MIT\nThe MIT License", "Licensed under the Apache License, Version 2.0",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "Copyright (c) 2020 Jo. All rights reserved.",
         "Creative Commons Attribution 4.0 International License", "the Unlicense; public domain", "İstanbul license ſ", "gpl " * 500,
         "word " * 30_000 + "all rights reserved " + "end " * 5, "licen", "BSD 3-Clause License and BSD License", "_license_ cc_by all`rights`reserved"]


def check(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 3, "y") for i, t in enumerate(texts)], "doc_id long, text string, labels string, n_words int, words string")
    rows = license.scan(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == brute(texts[r.doc_id]), texts[r.doc_id][:80]


def test_hand_made_texts(spark):
    check(spark, TEXTS)


def test_random_license_soup(spark):
    rng = random.Random(8)
    parts = " ".join(t for t in TEXTS if t and len(t) < 200).split() + ["MIT", "X11", "cc0", "version", "2.0", "-", "\n", "é", "affero", "free"]
    check(spark, [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 80))) for _ in range(120)])


def test_many_mentions(spark):
    """More matches of one rule than a block, and about as many as whole blocks."""
    one = "GPL-2.0 or cc by 4.0, "
    check(spark, [one * n for n in (1, license.BLOCK - 1, license.BLOCK, license.BLOCK + 1, 3 * license.BLOCK + 7)])


def test_whole_table(spark):
    check(spark, [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()])


def test_empty_table_null_ids_and_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert license.scan(df).collect() == []
    twice = spark.createDataFrame([(None, "cc by"), (None, "cc by")], "doc_id long, text string")
    assert [r.base_labels for r in license.scan(twice).collect()] == ["cc-by", "cc-by"]
    plan = license.scan(twice.where(F.length("text") > 0))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_every_keyword_is_gated():
    for label, level, key, pattern in license_rules.rules():
        assert 1 <= level <= license_rules.LEVELS
        if key:
            assert any(a in key for a in license_rules.ANCHORS), key
    assert len(license_rules.rules()) >= 200


def test_literals_are_in_every_match():
    for label, level, key, pattern in license_rules.rules():
        for text in TEXTS:
            norm = NORM.sub(" ", (text or "").lower())
            for m in re.finditer(pattern, norm):
                assert any(x in m.group() for x in license_rules.literals(pattern)), (label, pattern)
    weak = [p for _, _, _, p in license_rules.rules() if license_rules.literals(p) == [""]]
    assert not weak


def covering(items):
    """Texts that match a parsed pattern and between them take each of its alternatives."""
    p, each = license_rules._parser, []
    for op, arg in items:
        if op is p.LITERAL:
            each.append([chr(arg)])
        elif op is p.IN:
            each.append([chr(a if o is p.LITERAL else a[0]) for o, a in arg])
        elif op is p.SUBPATTERN:
            each.append(covering(arg[-1]))
        elif op is p.BRANCH:
            each.append([t for x in arg[1] for t in covering(x)])
        elif op is p.MAX_REPEAT:
            some = [t * max(1, arg[0]) for t in (["x"] if arg[2][0][0] is p.ANY else covering(arg[2]))]
            each.append(["", *some] if arg[0] == 0 else some)
    return ["".join(x[min(k, len(x) - 1)] for x in each) for k in range(max(map(len, each), default=1))]


def test_every_alternative_is_detected(spark):
    """No keyword, literal or anchor gate: every regex is tried on a text for each alternative."""
    texts = sorted({t for *_, pattern in license_rules.rules() for t in covering(license_rules._parser.parse(pattern))})
    texts += ["This software may be used for educational purposes only.", "may\nbe  used for research use only", "CC\nBY-SA 4.0"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license.scan(df).collect()}
    seen = set()
    for i, text in enumerate(texts):
        low, norm = text.lower(), NORM.sub(" ", text.lower())
        words = WORD.findall(low)
        labels = {label for p, label in BASE if any(words[k:k + len(p)] == p for k in range(len(words)))}
        found = [(m.start(), -m.end(), -level, n) for n, (_, level, _, p) in enumerate(RULES) for m in p.finditer(norm)]
        seen |= {d[3] for d in found}
        kept = [d for k, d in enumerate(sorted(found)) if not any(e[1] <= d[1] and e[2] <= d[2] for e in sorted(found)[:k])]
        best = max([license.WEIGHTS[-d[2] - 1] for d in kept] + [license.WEIGHTS[0]] * bool(labels) + [0.0])
        assert got[i] == (",".join(sorted(labels | {RULES[d[3]][0] for d in kept})), best), text
    assert seen == set(range(len(RULES)))
