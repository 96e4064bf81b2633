"""The pass over lines against the kernel's, and on very many lines."""

import random

from pyspark.sql import functions as F

from loomtext.functions import lines
from loomtext.options import Options
from loomtext.wikitext import clean

LINES = ["== H ==", "=== Deep! ===", "* a", "# b", "; c", ": d", "para", " indented", "{| rest", "x}", "(aside)", "---", "", "++Note++", "++Why?++", "++++", "...", "(open", "* ", " ", "é 日", "== no"]


def test_random_lines(spark):
    rng = random.Random(1)
    rows = ["\n".join(rng.choice(LINES) for _ in range(rng.randrange(0, 14))) for _ in range(800)] + ["", None]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, t string")
    got = {r["id"]: r["out"] for r in df.select("id", lines.compact(F.col("t")).alias("out")).collect()}
    wrong = [(t, got[i]) for i, t in enumerate(rows) if got[i] != (None if t is None else clean.compact(t, Options()))]
    assert wrong == []


def test_very_many_lines(spark):
    t = "\n".join(["== H ==", "* item", "after", "next", ""] * 40_000)
    out = spark.createDataFrame([(t,)], "t string").select(F.size(lines.compact(F.col("t")))).first()[0]
    assert out == 80_000
