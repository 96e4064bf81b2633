"""Abbreviations: likelihood ratios on their own, and tokens that follow."""

import math
import random
import re
from collections import Counter

import pytest

from loomtext.operators import abbreviations
from loomtext.options import Options
from loomtext.plans import extract as extraction
from loomtext.tokenize import rule_words


def texts():
    rng = random.Random(1)
    plain = "river stone garden of the window letter music it is".split()
    out = []
    for _ in range(300):
        words = [rng.choice(plain) for _ in range(12)] + ["not"]
        words.insert(3, rng.choice(["Dr.", "e.g.", "No.", "St."]))
        out.append(" ".join(words).capitalize() + f". No, not {rng.choice(plain)}.")
    return [*out, None, "", "…"]


def frame(spark, rows):
    return spark.createDataFrame([(str(i), f"T{i}", "0", t) for i, t in enumerate(rows)], "id string, title string, ns string, text string")


def test_scores(spark):
    rows = texts()
    count, stop = Counter(), Counter()
    for t in rows:
        for w in re.findall(r"[^\W\d_]+(?:\.[^\W\d_]+)*\.?", t or ""):
            count[w.lower().removesuffix(".")] += 1
            stop[w.lower().removesuffix(".")] += w.endswith(".")
    share = sum(stop.values()) / sum(count.values())
    want = {}
    for w, k in stop.items():
        if k:
            likely = lambda p: k * math.log(p) + (count[w] - k) * math.log(1 - p)  # noqa: B023, E731
            letters = len(w.replace(".", ""))
            want[w] = 2 * (likely(0.99) - likely(share)) * math.exp(-letters) * (w.count(".") + 1) * float(letters) ** -(count[w] - k)
    got = {r["word"]: r["score"] for r in abbreviations.scores(frame(spark, rows)).collect()}
    assert got == pytest.approx(want, rel=1e-9, abs=1e-12)
    assert {r["word"] for r in abbreviations.abbreviations(frame(spark, rows)).collect()} == {"dr", "e.g", "st"}


def test_no_words(spark):
    assert abbreviations.scores(frame(spark, [None, "12"])).collect() == []


def test_rules_keep_the_stop():
    assert rule_words("Dr. Who lives in St. Ives.", frozenset({"dr", "st"})) == ["Dr.", "Who", "lives", "in", "St.", "Ives", "."]
    assert rule_words("Dr . x", frozenset({"dr"})) == ["Dr", ".", "x"] and rule_words("Dr. x") == ["Dr", ".", "x"]
    assert rule_words(". e.g. this", frozenset({"e.g"})) == [".", "e.g.", "this"]


def test_an_extraction_follows_what_was_learned(spark, tmp_path):
    pages = frame(spark, texts()[:100])
    abbreviations.abbreviations(pages).write.parquet(f"{tmp_path}/known")
    rows = extraction.extract(pages, Options(abbreviations=f"{tmp_path}/known")).collect()
    words = {w for r in rows for w in r["segment_text"]}
    assert "dr." in words and "river" in words and "river." not in words


def test_known_abbreviations_are_a_set(spark):
    """a list of all known ones was walked for each word with a stop."""
    from loomtext.operators import abbreviations

    known = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    df = spark.createDataFrame([("Waa. wab. end.",), (None,)], "text string").select(abbreviations.tokens(abbreviations.F.col("text"), known).alias("w"))
    assert [r["w"] for r in df.collect()] == [["Waa.", "wab.", "end", "."], None]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan and "INSET" in plan


def test_more_abbreviations_than_travel(spark, tmp_path, monkeypatch):
    """only the best 10,000 were known. All are, and those that don't go with the tasks meet the words in a join."""
    monkeypatch.setattr(abbreviations, "TRAVEL", 1, raising=False)
    rows = [(i // 2 if i % 7 else None, t) for i, t in enumerate(texts()[-40:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([("dr",), ("e.g",), ("st",), ("zz",)], "word string")
    with_list = docs.select("doc_id", "text", abbreviations.tokens(abbreviations.F.col("text"), ["dr", "e.g", "st", "zz"]).alias("w"))
    by_join = abbreviations.tokenised(docs, known, "doc_id")
    assert "Join" in by_join._jdf.queryExecution().optimizedPlan().toString()
    key = lambda r: repr(tuple(r))
    assert sorted(by_join.collect(), key=key) == sorted(with_list.collect(), key=key)


def test_abbreviations_beyond_ten_thousand(spark):
    """a word before a stop of each text, 10,500 of them."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c for a in letters for b in letters for c in letters][:10_500]
    df = spark.createDataFrame([(" ".join(f"{w}. it it" for w in words[i : i + 500]),) for i in range(0, 10_500, 500)], "text string")
    assert {r["word"] for r in abbreviations.abbreviations(df, threshold=0.01).select("word").collect()} == set(words)


def test_an_extraction_follows_a_table_that_does_not_travel(spark, tmp_path, monkeypatch):
    pages = frame(spark, texts()[:60])
    abbreviations.abbreviations(pages).write.parquet(f"{tmp_path}/known")
    options = Options(abbreviations=f"{tmp_path}/known")
    want = sorted((r["id"], r["segment_text"]) for r in extraction.extract(pages, options).collect())
    monkeypatch.setattr(abbreviations, "TRAVEL", 1, raising=False)
    got = extraction.extract(pages, options)
    assert sorted((r["id"], r["segment_text"]) for r in got.collect()) == want
    assert "Join" in got._jdf.queryExecution().optimizedPlan().toString()
