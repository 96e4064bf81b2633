"""Conversion by phrases against a naive longest match."""

import random

from loomtext.operators.script import Converter
from loomtext.options import Options
from loomtext.plans import extract as extraction


def naive(text, table):
    out, i = "", 0
    while i < len(text):
        best = max((len(p) for p in table if p and text.startswith(p, i)), default=0)
        out, i = (out + table[text[i : i + best]], i + best) if best else (out + text[i], i + 1)
    return out


def test_random_tables():
    rng = random.Random(1)
    for _ in range(60):
        table = {"".join(rng.choice("ab国x中😀") for _ in range(rng.randrange(0, 5))): rng.choice(["", "1", "國國", "ab"]) for _ in range(rng.randrange(0, 14))}
        texts = ["".join(rng.choice("ab国x中😀 ") for _ in range(rng.randrange(0, 40))) for _ in range(30)]
        assert Converter(list(table.items())).convert(texts) == [naive(t, table) for t in texts]


def test_columns_and_extraction(spark, tmp_path):
    rows = [("国", "國"), ("中国人", "華人"), (None, "x"), ("空", None)]
    spark.createDataFrame(rows, "src string, dst string").write.parquet(f"{tmp_path}/table")
    pages = spark.createDataFrame([("1", "中国", "0", "中国人和中国空。"), ("2", "T", "0", None), ("3", None, "0", "")], "id string, title string, ns string, text string")
    by = Converter.read(spark.read.parquet(f"{tmp_path}/table"))
    assert [r[0] for r in pages.orderBy("id").select(by.column("text")).collect()] == ["華人和中國。", None, ""]
    out = {r["id"]: r for r in extraction.extract(pages, Options(lang="zh", script=f"{tmp_path}/table")).collect()}
    assert out["1"]["title"] == "中國" and out["1"]["text"] == "華人和中國。\n" and "".join(out["1"]["segment_text"]) == "華人和中國。"
