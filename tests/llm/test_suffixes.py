"""Repeated passages: long texts in parts, hot anchors, contexts whose hashes clash, spans."""

from __future__ import annotations

import random

import numpy as np
import pytest

from loomtext.llm import suffixes

from .helpers import sentence
from .test_contracts import brute_cut


def windows(a):
    """Every window's anchor, by the window's place."""
    return {w: (x, h) for x, first, last, h in zip(a.anchor.tolist(), a.first.tolist(), a.last.tolist(), a.hash.tolist(), strict=True) for w in range(first, last + 1)}


def test_parts_pick_the_same_anchors(monkeypatch):
    rng = random.Random(51)
    texts = [sentence(rng, n).encode() for n in (0, 3, 900, 20, 2500, 0, 60)] + [b"", b"ab" * 900]
    whole = windows(suffixes.Anchored(texts))
    for part in (150, 1000, 7001):
        monkeypatch.setattr(suffixes, "PART", part)
        assert windows(suffixes.Anchored(texts)) == whole
    assert len(whole) == sum(max(0, len(t) - 99) for t in texts)


def test_one_very_long_text(spark):
    rng = random.Random(52)
    long = " ".join(sentence(rng, 2000) for _ in range(120))
    assert len(long) > suffixes.PART + 200_000
    at = suffixes.PART - 300
    rows = [(1, long), (2, sentence(rng, 30) + long[at : at + 700] + sentence(rng, 30)), (3, long[-5000:]), (4, None)]
    out = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], suffixes_sha(r["kept"])) for r in out), key=repr)
    assert got == brute_cut(rows)


def suffixes_sha(data):
    import hashlib

    return hashlib.sha256(bytes(data)).hexdigest()


def test_contexts_of_an_anchor_are_counted():
    """A common line of over 40 bytes between ever new neighbours: one anchor, as many contexts as texts."""
    rng = np.random.default_rng(53)
    line = b"the quick brown fox jumps over the lazy dog and then some more of it"
    texts = [rng.bytes(40) + line + rng.bytes(40) for _ in range(10_000)]
    _, contexts, times = suffixes.distinct_anchors(suffixes.Anchored(texts))
    assert contexts.max() > 9_000 and times.max() >= contexts.max()


@pytest.mark.parametrize("clash", [False, True])
def test_bytes_decide_not_hashes(monkeypatch, clash):
    rng = random.Random(54)
    shared = sentence(rng, 60).encode()
    texts = [sentence(rng, 20).encode() + shared, shared + sentence(rng, 25).encode(), sentence(rng, 100).encode()]
    a = suffixes.Anchored(texts)
    if clash:
        a.whole = np.zeros_like(a.whole)
    codes = np.zeros(len(suffixes.distinct_anchors(a)[0]), np.uint8)
    x = suffixes.Contexts(a, np.arange(3), codes, 4)
    data = lambda i: (int(x.anchor[i] - x.first[i]), bytes(a.data[x.first[i] : x.last[i] + 100]))
    sent = {data(i) for i in x.sent.tolist()}
    assert len(x.sent) and all(data(i) in sent for i in x.again.tolist())
    if not clash:
        assert len(x.again) and len(sent) == len(x.sent)


def test_spans_join_within_a_text_alone():
    a = suffixes.Anchored([b"x" * 150, b"y" * 150, b"", b"z" * 300])
    begin, end = a.covered(np.array([300, 150, 0, 50, 420, 410]), np.array([400, 250, 100, 150, 520, 510]))
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [(0, 150), (150, 250), (300, 400), (410, 520)]
