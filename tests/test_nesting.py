"""Native nesting against the plain functions, on random runs of delimiters."""

import random

import pytest
from pyspark.sql import functions as F

from loomtext.functions import nesting
from loomtext.options import Options
from loomtext.plans import queries
from loomtext.wikitext import clean, spans


def texts(seed, marks, n=500):
    rng = random.Random(seed)
    fill = ["", "a", "é 日", " ", "\n", "x|y", "|", "b c"]
    return ["".join(rng.choice(marks) + rng.choice(fill) for _ in range(rng.randrange(0, 14))) for _ in range(n)] + ["", None]


def both(spark, rows, native, plain):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, t string")
    got = {r["id"]: r["out"] for r in df.select("id", native(F.col("t")).alias("out")).collect()}
    wrong = [(t, got[i], plain(t)) for i, t in enumerate(rows) if got[i] != (None if t is None else plain(t))]
    assert wrong == []


@pytest.mark.parametrize(("opening", "closing", "marks"), [(r"\{\|", r"\|\}", ["{|", "|}", "{|", "|}", ""]), (r"\{\{", r"\}\}", ["{{", "}}", "}}", "{", "}"]), (r"<\s*div\b[^>/]*>", r"<\s*/\s*div>", ["<div>", "</div>", "<DIV a=b>", "< / div>", "<div/>", "<divx>"])])
def test_regions(spark, opening, closing, marks):
    marks = [m for m in marks if m]
    rows = [t for t in texts(1, marks) if t is None or "{|}" not in t]
    both(spark, rows, lambda c: nesting.without_nested(c, opening, closing), lambda t: spans.drop_nested(t, opening, closing))


def test_elements(spark):
    def plain(t):
        for tag in clean.DISCARDED:
            t = spans.drop_nested(t, rf"<\s*{tag}\b[^>/]*>", rf"<\s*/\s*{tag}>")
        return t

    both(spark, texts(2, ["<div>", "</div>", "<table x>", "</table>", "<td>", "</TD>", "<sup>", "</sup>", "<b>", "</ref>"], 200), nesting.elements, plain)


def test_links(spark):
    marks = ["[[", "]]", "]]", "[[File:a|", "[[w:x|", "[[:w:b", "|t ", "[[A (b) |", "[", "]", ":"]
    both(spark, texts(3, marks, 600), nesting.internal_links, lambda t: clean.internal_links(t, Options()))


def test_many_regions_of_a_long_text(spark):
    t = "a{|b{|c|}|}d" * 2000
    assert spark.createDataFrame([(t,)], "t string").select(nesting.tables(F.col("t"))).first()[0] == "ad" * 2000


@pytest.mark.parametrize("name", ["nested_regions", "internal_links_nested"])
def test_no_python_in_the_plan(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
