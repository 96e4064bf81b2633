"""Boosted trees: splits and walks against plain versions, held-out accuracy, awkward tables."""

import numpy as np
import pytest

from loomtext.llm import boosting

from .helpers import CLASHING, awkward, frame, rows_of, sentence


def walk(trees, row):
    total = trees.base
    for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(row[feature[node]] > cut[node])
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_first_cut_is_the_best_of_all_and_walks_agree():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (400, 5)).astype(np.float32)
    y = ((x[:, 2] > 6) ^ (rng.random(400) < 0.1)).astype(float)
    trees = boosting.fit(x, y, trees=6, depth=3)
    share = y.mean()
    g, h = share - y, np.full(400, share * (1 - share))

    def gain(f, c):
        left = x[:, f] <= c
        if min(left.sum(), (~left).sum()) < 10:
            return -1
        return sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (left, ~left)) - g.sum() ** 2 / (h.sum() + 1)

    best = max((gain(f, c), f, c) for f in range(5) for c in range(12))
    assert (trees.feature[0, 0], trees.cut[0, 0]) == (best[1], best[2])
    assert np.allclose(trees.score(x), [walk(trees, r) for r in x])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.85


def test_statistics_of_parts_equal_those_of_one():
    texts = [t.encode() for _, t, *_ in awkward(2) if t is not None]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = boosting.statistics(np.frombuffer(b"".join(texts), np.uint8), starts)
    for t, row in zip(texts, together, strict=True):
        assert boosting.statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0].tolist() == row.tolist()
    assert np.isfinite(together).all()


def labelled(spark, n):
    import random

    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = sentence(rng, 60)
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text, None, None, None))
        labels.append((i, 0 if bad else 1, 0))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_held_out_rows_are_told_apart_and_teach_nothing(spark):
    docs, labels, known = labelled(spark, 300)
    out = boosting.classify(docs, labels, trees=20)
    got = {r["doc_id"]: r for r in out.collect()}
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(got[i]["predicted"] == q for i, q, _ in known)
    assert out.select(*[c for c in CLASHING if c != "score"]).distinct().count() == 1
    wrong = spark.createDataFrame([(i, 1 - q if got[i]["held_out"] else q, t) for i, q, t in known], "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in boosting.classify(docs, wrong, trees=20).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


@pytest.mark.parametrize("labels", [[], [(3, None), (None, 1)], [(3, 1), (6, 1)], [(3, 1), (3, 0), (6, 0), (9, 7)]])
def test_awkward(spark, labels):
    rows = awkward(4)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    out = boosting.classify(frame(spark, rows), table, trees=3)
    got = rows_of(out.select("doc_id", "text", "score", "predicted", "held_out"))
    assert len(got) == len(rows) and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.3) for r in got)
    by_text = {}
    assert all(by_text.setdefault(r[1] or "", r[2]) == r[2] for r in got)
    assert all(not r[4] for r in got if r[0] is None)
    assert boosting.classify(frame(spark, []), table, trees=3).collect() == []


def test_the_sample_is_bounded(spark):
    docs, labels, _ = labelled(spark, 120)
    table = boosting.described(docs, "text", ["doc_id"])
    from pyspark.sql import functions as F

    x, y = boosting.sampled(table, labels, F.lit(True), "doc_id", "quality", 50)
    assert x.shape == (50, len(boosting.STATISTICS)) and y.shape == (50,)


def test_accuracy_on_rows_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = boosting.op12_boosted_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 50 and sum(r["predicted"] == r["quality"] for r in got) / len(got) > 0.97
