"""The pipeline's stages one after the other against brute force, and every registered query on the smallest tables."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from loomtext.llm import pii, quality, registry, simhash
from loomtext.llm.common import materialize

from .helpers import exact_groups
from .test_contracts import base_of, brute_cut, ids_of

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shares(counts):
    total = sum(counts)
    return [c / total for c in counts] if total else None


def distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def histograms(text):
    """Character classes and common words, written on their own."""
    kinds = Counter()
    for c in text:
        kinds[0 if c.isalpha() else 1 if c in " \t\n\v\f\r" else 2 if c.isnumeric() else 3 if c in ".,;:!?'\"()-" else 4 if c in "#*$%&|<>" else 5] += 1
    vocabulary = list(dict.fromkeys(w for ws in quality.COMMON_WORDS.values() for w in ws))
    words = Counter(w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text))
    common = [words[w] for w in vocabulary]
    return [kinds[i] for i in range(6)], [*common, sum(words.values()) - sum(common)]


def kept_by_quality(rows):
    seen = {i: (*histograms(t or ""), base_of(t), lang) for i, t, lang in rows}
    references = defaultdict(list)
    vocabulary = list(dict.fromkeys(w for ws in quality.COMMON_WORDS.values() for w in ws))
    for classes, common, base, lang in seen.values():
        if lang not in quality.COMMON_WORDS:
            counts = {x: sum(common[vocabulary.index(w)] for w in ws) for x, ws in quality.COMMON_WORDS.items()}
            lang = next(x for x, n in counts.items() if n == max(counts.values()))
            lang = lang if 10 * counts[lang] >= base[0] else None
        if lang and not base[5] and base[0] >= 60:
            references[lang].append((shares(classes), shares(common)))
    mean = {lang: [[sum(x) / len(found) for x in zip(*part, strict=True)] for part in zip(*found, strict=True)] for lang, found in references.items()}
    bare = {lang: distance([0.0] * (len(w) - 1) + [1.0], w) for lang, (_, w) in mean.items()}
    out = set()
    for i, (classes, common, base, lang) in seen.items():
        if base[5]:
            continue
        near = min(distance(shares(classes), c) for c, _ in mean.values()) <= 0.30 or base[1] < 200
        words = {x: distance(shares(common), w) for x, (_, w) in mean.items()}
        able = any(d <= 0.92 * bare[x] for x, d in words.items()) or (lang is not None and lang not in quality.COMMON_WORDS)
        if near and (base[0] < 60 or able):
            out.add(i)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "personal_data", "best_fit_packing"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = sorted(((r["doc_id"], r["text"], r["lang"]) for r in docs.collect()))
        out = materialize(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == COLUMNS
        texts = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "quality_rules":
            assert set(texts) == kept_by_quality(rows) and len(texts) < len(rows)
        if name == "near_duplicates":
            assert set(texts) == set(exact_groups({i: t for i, t, _ in rows}).values()) and len(texts) < len(rows)
        if name == "repeated_passages":
            cut = {r[0]: r[2] for r in brute_cut([(i, t) for i, t, _ in rows])}
            was = {i: t.encode() for i, t, _ in rows}
            assert sum(cut.values()) > 0 and all(texts[i] == t for i, t, _ in rows if not cut[i])
            for i, t in texts.items():
                if "�" not in t:
                    assert len(t.encode()) == len(was[i]) - cut[i]
        if name == "personal_data":
            for i, t, _ in rows:
                hexes = re.findall(r'token = "([0-9a-f]{40})"', t)
                assert not pii.base_spans(texts[i]) and not any(h in texts[i] for h in hexes)
                if not pii.base_spans(t) and not hexes:
                    assert texts[i] == t
        docs = out
    packed = corpus_pipeline.run(spark, SF).collect()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert docs.count() < before and Counter(r["doc_id"] for r in packed) == {i: max(1, -(-len(ids_of(t)) // 4096)) for i, t in rows.items()}
    assert sum(r["length"] for r in packed) == sum(len(ids_of(t)) for t in rows.values())
    bins = Counter()
    for r in packed:
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 4096 and len(bins) <= sum(bins.values()) / 4096 * 1.02 + 1


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_near_duplicate_groups_are_whole(spark, name):
    """Every row in its group of exact five-word Jaccard similarity of 0.8 or more."""
    docs = spark.read.parquet(f"/root/testdata/{name}/documents.parquet").select("doc_id", "text")
    got = dict(map(tuple, simhash.similar(docs).collect()))
    want = exact_groups({r["doc_id"]: r["text"] for r in docs.collect()})
    wrong = sum(got[i] != x for i, x in want.items())
    assert len(got) == len(want) and wrong <= len(want) // 2000 and len(set(got.values())) < len(got)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered(spark, name):
    df = registry.QUERIES[name](spark, SF)
    if name.startswith("op11_"):
        clicks = spark.read.parquet(f"{SF}/clicks.parquet").where("ts IS NOT NULL")
        assert df.count() == df.select("click_id").distinct().count() == clicks.select("click_id").distinct().count()
        return
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert df.select("doc_id").distinct().count() == documents.count()


def test_held_out_accuracy(spark):
    df = registry.QUERIES["op2_bidirectional_gru"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    row = df.where("held_out").join(truth, "doc_id").selectExpr("avg(cast(lang = lang_pred AS double)) AS accuracy", "count(*) AS n").first()
    assert row["n"] > 100 and row["accuracy"] > 0.95
