"""Language identification: segments against a run over the whole text, letters, and the sample."""

from __future__ import annotations

import random

import numpy as np

from loomtext.llm import langid

from .helpers import SCHEMA, sentence


def test_segments_agree_with_a_run_over_the_whole_text(monkeypatch):
    """With contexts as long as the text, pooling over segments is pooling over one run."""
    rng = random.Random(61)
    network = langid.Network(["aa", "bb", "cc"], langid.new_weights(3, 8, 5))
    texts = [sentence(rng, n) for n in (1, 3, 40, 200)] + ["é" * 700, None, "12"]
    monkeypatch.setattr(langid, "CONTEXT", 5000)
    names, scores = langid.classify(network, texts, most=3)
    for text, name, score in zip(texts, names, scores, strict=True):
        if not text or text == "12":
            assert (name, score) == ("und", 0.0)
            continue
        data = np.frombuffer(text.encode(), np.uint8)[:, None]
        p, _ = langid.position_probabilities(network.weights, data, np.ones(data.shape, np.float32))
        mean = p[:, 0].mean(axis=0)
        assert name == network.languages[int(mean.argmax())] and abs(score - mean.max()) < 1e-4


def test_numbers_are_no_letters():
    network = langid.Network(["aa", "bb"], langid.new_weights(2, 8, 5))
    names, _ = langid.classify(network, ["½ ² 12", "① Ⅷ", "_ -", "ª", "日", "a" * 30_000])
    assert names[:3] == ["und"] * 3 and "und" not in names[3:]


def test_sample_is_that_of_the_rows(spark):
    rng = random.Random(62)
    rows = [(i, sentence(rng, 30), ["aa", "bb"][i % 2], "s", 0) for i in range(60)]
    networks = [langid.fit(spark.createDataFrame(r, SCHEMA).repartition(n), sample_docs=20, rounds=3) for r, n in ((rows, 2), (rows[::-1] + rows[:9], 5))]
    assert all(np.array_equal(networks[0].weights[k], networks[1].weights[k]) for k in networks[0].weights)
