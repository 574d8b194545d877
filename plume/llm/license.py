"""License scan by ordered signature rules, in DataFrame functions only.

Texts without any anchor keyword cost a few substring searches. The others are normalised,
and each rule whose keyword they hold gives its detections as intervals. One sweep over the
sorted intervals then drops each detection that lies inside another of at least its level.
Map only: no shuffle, whatever the corpus holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.llm.license_rules import ANCHORS, LEVELS, literals, rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words on the text as written: only A-Z is lower-cased, and that changes no boundary.
_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_SEP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_GAP = "[^0-9a-zA-Z.+/:\\x80-\\x{10FFFF}-]+"      # becomes one space in the normalised text
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
BLOCK = 256                           # matches whose places are summed at a time
WEIGHTS = (0.4, 0.6, 0.8, 1.0)       # by level; a base phrase counts as a mention


def _any(text: Column, low: Column, keys) -> Column:
    """Whether the normalised text holds any of the keys, told from the text as written and lower-cased."""
    def has(key: str) -> Column:
        words = key.split(" ")
        held = reduce(lambda a, b: a & b, [low.contains(w) for w in words])
        return held & text.rlike("(?i)" + _GAP.join(words)) if len(words) > 1 else held

    return reduce(lambda a, b: a | b, [has(k) for k in sorted(keys, key=lambda k: " " in k)])


def _places(words: Column, phrase: list[str]) -> Column:
    """Start places (in words) at which the phrase's words stand consecutively."""
    n = len(phrase)
    at = lambda i: reduce(lambda a, b: a & b, [F.get(words, i + k) == F.lit(w) for k, w in enumerate(phrase)])
    return F.when(F.size(words) >= n, F.filter(F.sequence(F.lit(0), F.size(words) - n), at)).otherwise(
        F.array().cast("array<int>"))


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _detections(norm: Column, rule: Column) -> Column:
    """Intervals of one rule's matches: lengths of what lies between and of the matches add up to places.

    Appending copies what is there already, so sums run over blocks of ``BLOCK`` matches first and
    over the blocks' totals then: the work stays in proportion to the matches."""
    found = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))
    between = F.split(norm, rule["pattern"], -1)
    steps = F.arrays_zip(F.transform(between, lambda b: F.length(b)).alias("gap"),
                         F.transform(found, lambda m: F.length(m)).alias("len"))      # one gap more than matches
    spans = "array<struct<start:int,end:int>>"

    def walk(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out"))
        return F.aggregate(part, start, lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + F.coalesce(s["len"], F.lit(0))).alias("at"),
            F.when(s["len"].isNull(), acc["out"]).otherwise(F.array_append(acc["out"], F.struct(
                (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["len"]).alias("end")))).alias("out")))

    def shifted(out: Column, by: Column) -> Column:
        return F.transform(out, lambda x: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end")))

    def joined(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spans}>").alias("out"))
        return F.flatten(F.aggregate(parts, start, lambda acc, p: F.struct(
            (acc["at"] + p["at"]).alias("at"), F.array_append(acc["out"], shifted(p["out"], acc["at"])).alias("out")))["out"])

    walked = _let(steps, lambda all_: joined(F.transform(
        F.sequence(F.lit(1), F.size(all_), F.lit(BLOCK)), lambda i: walk(F.slice(all_, i, F.lit(BLOCK))))))
    return F.transform(walked, lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("back"), (-rule["level"]).alias("rank"), rule["n"].alias("n"),
        rule["label"].alias("label")))


def _resolved(found: Column) -> Column:
    """Labels and levels of the detections not contained in another of at least their level (of equal
    ones, the first rule's stays); each label and level once."""
    kept = F.array().cast("array<struct<label:string,level:int>>")
    ends = F.array(*[F.lit(-1)] * LEVELS)            # furthest end so far of detections of each level or above

    def step(acc: Column, d: Column) -> Column:
        level, end = -d["rank"], -d["back"]
        this = F.struct(d["label"].alias("label"), level.alias("level"))
        return F.struct(
            F.transform(acc["ends"], lambda e, q: F.when(q < level, F.greatest(e, end)).otherwise(e)).alias("ends"),
            F.when((F.get(acc["ends"], level - 1) >= end) | F.array_contains(acc["kept"], this), acc["kept"])
            .otherwise(F.array_append(acc["kept"], this)).alias("kept"))

    return F.aggregate(F.array_sort(found), F.struct(ends.alias("ends"), kept.alias("kept")), step)["kept"]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are their
    smallest and largest place (null without any). ``labels`` adds what the rules detect;
    ``score`` is the weight of the strongest detection, 0 without any. Null and empty texts have
    no words and empty labels. Null ids and repeated rows are scanned like any other.
    """
    table = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(level).alias("level"), F.lit(key).alias("key"),
                               F.array(*[F.lit(x) for x in literals(pattern)]).alias("literals"),
                               F.lit(pattern).alias("pattern"), F.lit(label).alias("label"))
                      for i, (label, level, key, pattern) in enumerate(rules())])
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # lower() is used to gate only: it keeps every ASCII match that lower-casing A-Z has
    d = d.select("doc_id", "text", F.lower("text").alias("low"))
    phrases = [p.split(" ") for p, _ in base]
    stems = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col("low").contains(w) for w in p]) for p in phrases])
    near = F.col("text").rlike("(?i)(?:" + "|".join(_SEP.join(p) for p in phrases) + ")")
    d = d.select("doc_id", "text", F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"),
                 (stems & near).alias("has_base"), _any(F.col("text"), F.col("low"), ANCHORS).alias("has_anchor"))
    ascii_lower = F.translate("text", _UPPER, _LOWER)
    words = F.when(F.col("has_base"), F.regexp_extract_all(ascii_lower, F.lit(_WORD), F.lit(0)))
    norm = F.when(F.col("has_anchor"), F.regexp_replace(ascii_lower, "[^0-9a-z.+/:\\x80-\\x{10FFFF}-]+", " "))
    d = d.select("doc_id", "n_words", words.alias("words"), norm.alias("norm"))
    tried = F.filter(table, lambda r: F.col("norm").contains(r["key"])
                     & F.exists(r["literals"], lambda x: F.col("norm").contains(x)))
    found = F.when(F.col("norm").isNotNull(), F.flatten(F.transform(tried, lambda r: _detections(F.col("norm"), r))))
    d = d.select("doc_id", "n_words", found.alias("found"), F.when(F.col("words").isNotNull(), F.array(
        *[F.struct(F.lit(label).alias("label"), _places(F.col("words"), p).alias("at")) for p, (_, label) in zip(phrases, base)])
    ).alias("base"))
    d = d.select("doc_id", "n_words",
                 F.when(F.col("found").isNotNull(), _resolved(F.col("found"))).otherwise(
                     F.array().cast("array<struct<label:string,level:int>>")).alias("kept"),
                 F.filter("base", lambda b: F.size(b["at"]) > 0).alias("base"))
    places = F.flatten(F.transform("base", lambda b: b["at"]))
    d = d.select("doc_id", "n_words", "kept", F.coalesce(F.transform("base", lambda b: b["label"]),
                                                        F.array().cast("array<string>")).alias("base"), places.alias("places"))
    labels = F.array_union("base", F.transform("kept", lambda x: x["label"]))
    weight = F.array(*[F.lit(w) for w in WEIGHTS])
    best = F.greatest(F.coalesce(F.array_max(F.transform("kept", lambda x: F.get(weight, x["level"] - 1))), F.lit(0.0)),
                      F.when(F.size("base") > 0, F.lit(WEIGHTS[0])).otherwise(0.0))
    return d.select(
        "doc_id", "n_words", F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"), best.alias("score"))
