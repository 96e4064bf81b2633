"""Losses that a review found: each of these tests failed before its fix."""

from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline
from loomtext.llm import pii, quality, simhash

from .helpers import SCHEMA, awkward, exact_groups, frame, sentence, untouched


def test_texts_without_common_words_go(spark):
    rng = random.Random(21)
    common, rare = "the of and to in is that it".split(), "stone river music paper garden window letter".split()
    text = lambda share, n=150: " ".join(rng.choice(common if rng.random() < share else rare) + rng.choice(["", "", "."]) * (rng.random() < 0.05) for _ in range(n))
    rows = [(i, text(0.25), "en", "s", 0) for i in range(40)]
    rows += [(100 + i, text(0), "en", "s", 0) for i in range(3)] + [(200, text(0.25).upper(), "en", "s", 0), (300, text(0), "zz", "s", 0), (301, text(0, 40), "en", "s", 0)]
    kept = {r[0] for r in quality.keep_good(spark.createDataFrame(rows, SCHEMA)).select("doc_id").collect()}
    assert kept == {*range(40), 200, 300, 301}


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    """Smallest id of each row's component under exact five-word Jaccard >= 0.8, by comparing all pairs."""
    sets, label = [grams(t) for _, t in rows], [i for i, _ in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return dict(zip([i for i, _ in rows], label, strict=True))


def edited(rng, text, times):
    words = text.split()
    for at in rng.sample(range(len(words)), times):
        words[at] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def near_rows(seed=22):
    """Pairs around the threshold, a crowd of near copies of one text, copies in other case, short and empty texts."""
    rng = random.Random(seed)
    texts = [None, "", "  ", "One two", "one TWO", "one two three"]
    for times in (1, 2, 3, 4, 5, 6, 8) * 5:
        base = sentence(rng, 200)
        texts += [base, edited(rng, base, times)]
    crowd = sentence(rng, 150)
    texts += [edited(rng, crowd, rng.randrange(1, 5)) for _ in range(60)] + [crowd.upper(), crowd]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("options", [{}, {"crowd": 2, "most_sent": 0, "block_rows": 9}, {"crowd": 2, "hot_rows": 1, "block_bytes": 20_000}, {"crowd": 10**6}])
def test_near_duplicates_are_those_of_the_threshold(spark, options):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(df, **options).collect()}
    assert got == brute_components(rows)


def test_near_duplicate_stage(spark):
    rows = near_rows(23)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, "")
    assert {r[0] for r in out.select("doc_id").collect()} == set(brute_components(rows).values()) and out.columns == df.columns


def test_rows_with_one_id(spark):
    rng = random.Random(26)
    a, b = sentence(rng, 50), sentence(rng, 50)
    rows = [(5, a), (5, b), (3, b), (None, a), (None, a), (9, a), (7, None), (8, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    for most in (500_000, 0):
        kept = sorted(((r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(df, most_sent=most).collect()), key=repr)
        assert kept == sorted([(5, a), (3, b), (None, a), (None, a), (7, None)], key=repr)


def test_close_fingerprints_alone_do_not_link(spark):
    rng, texts = random.Random(24), []
    while len(texts) < 6:
        base = sentence(rng, 200)
        other = edited(rng, base, 7)
        a, b = grams(base), grams(other)
        bits = (simhash.fingerprint(base, 5) ^ simhash.fingerprint(other, 5)).bit_count()
        if bits <= 7 and 5 * len(a & b) < 4 * len(a | b):
            texts += [base, other]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    assert dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, "").count() == 6


def test_function_words_are_no_patterns(spark):
    rng = random.Random(25)
    rows = [f"{sentence(rng, 12)} {rng.choice(['of', 'in', 'and'])} the bob{i}@example.com {sentence(rng, 12)}" for i in range(60)]
    plain = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    clean = ["of the ISO27001-2022 norm", "and the RFC9110draft text of the covid-19variant", "in the Windows11Pro"]
    rows += clean + [" ".join(f"{w} the {plain()}" for w in ("of", "in", "and") for _ in range(5)) for _ in range(20)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(rows)], SCHEMA)
    out = pii.find_pii(df).collect()
    assert all(r["added"] == [] for r in out) and sum(len(r["base"]) for r in out) == 60


def test_secrets_and_numbers_behind_keys(spark):
    texts = {
        1: 'with token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" here', 2: "password=hunter2secret and on", 3: "my api key: sk_live_99ab77cd here",
        4: "ssn: 123-45-6789 is hers", 5: "iban: DE89 3704 0044 0532 0130 00 please", 6: "tel: 555 123 4567 at noon", 7: 'token: "correct-horse"',
        8: "the number 1234567890123456 and the year: 2024 05 01, the token was spent, secret: nothing, at 12:30:45678", 9: "again 04dbebab91ab85687d33eeaaf9ac699e1188f962 there",
    }
    rows = [*texts.items(), *((100 + i, f"tel: +1 514 555 {1000 + i} at noon") for i in range(12))]
    got = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)).collect()}
    want = {
        1: 'with token = "[ID]" here', 2: "password=[ID] and on", 3: "my api key: [ID] here", 4: "ssn: [ID] is hers", 5: "iban: [ID] please", 6: "tel: [ID] at noon",
        7: 'token: "[ID]"', 8: texts[8], 9: "again [ID] there",
    }
    assert {i: got[i] for i in want} == want


def test_groups_of_awkward_and_empty_tables(spark):
    rows = awkward()
    df = frame(spark, rows)
    out = simhash.drop_near_duplicates(df)
    assert out.columns == df.columns and untouched(out)
    groups = exact_groups({k: r[1] for k, r in enumerate(rows)})
    ids = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            ids[groups[k]] = min(r[0], ids.get(groups[k], r[0]))
    want = sorted(((r[0], r[1]) for k, r in enumerate(rows) if r[0] is None or r[0] == ids[groups[k]]), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == want
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.similar(empty).collect() == [] and simhash.drop_near_duplicates(empty).columns == empty.columns
    nulls = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id bigint, text string")
    assert {tuple(r) for r in simhash.similar(nulls).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_stages_on_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, "")
        assert out.columns == empty.columns and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").collect() == []
