"""Slices of Arrow batches: whole, in order and bounded."""

import random

import pandas as pd

from loomtext.functions.batches import CHARS, ROWS, slices
from loomtext.options import Options
from loomtext.plans import extract as extraction
from loomtext.plans import queries


def test_slices():
    assert list(slices([])) == [] and list(slices([9], 5, 3)) == [(0, 1)]
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randrange(40) for _ in range(rng.randrange(60))]
        got = list(slices(sizes, 7, 50))
        assert [i for a, b in got for i in range(a, b)] == list(range(len(sizes)))
        assert all(b - a <= 7 and (sum(sizes[a:b]) <= 50 or b == a + 1) for a, b in got)


def test_a_worker_holds_one_slice(spark):
    """F8: neither pages nor their tokens of a whole batch are made at once."""
    texts = pd.Series(["word " * 20] * (3 * ROWS) + ["a " * CHARS, None, "b c"])
    pages = list(extraction.text_function(extraction.Site(), Options()).func(iter([(texts, texts)])))
    tokens = list(extraction.token_function(Options()).func(iter([texts])))
    for parts in (pages, tokens):
        assert sum(map(len, parts)) == len(texts) and max(map(len, parts)) == ROWS and len(parts) > 4
    assert tokens[-1].iloc[-1] == ["b", "c"]


def test_rule_tokens_holds_one_slice(spark, tmp_path, monkeypatch):
    """tokens of a few texts at a time."""
    seen, by_slices = [], queries.by_slices

    def kept(run, kind):
        seen.append(out := by_slices(run, kind))
        return out

    monkeypatch.setattr(queries, "by_slices", kept)
    spark.createDataFrame([(1, "It's a b."), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {(r["doc_id"], r["n_tokens"]) for r in queries.rule_tokens(spark, str(tmp_path)).collect()} == {(1, 5), (2, 0)}
    assert [len(x) for x in seen[0].func(iter([pd.Series(["x " * CHARS] * 3)]))] == [1, 1, 1]
