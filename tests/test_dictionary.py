"""Template dictionaries by rounds of joins, against the dictionary that is sent, and closures against a plain search."""

import glob
import random

import pytest

from loomtext.operators import dictionary
from loomtext.operators import pages as ops
from loomtext.options import Options
from loomtext.plans import extract as extraction
from loomtext.sources.scratch import shared_folder


def plain_reach(calls, starts):
    out = set()
    for key, title in starts:
        stack = [title]
        while stack:
            t = stack.pop()
            if (key, t) not in out:
                out.add((key, t))
                stack += calls.get(t, ())
    return out


@pytest.mark.parametrize("salts", [1, 5])
def test_reachable(spark, salts):
    rng = random.Random(1)
    calls = {f"t{i}": {f"t{rng.randrange(60)}" for _ in range(rng.randrange(3))} for i in range(60)} | {"hot": {"t1", "hot"}}
    starts = [(k, "hot" if k % 3 else f"t{rng.randrange(70)}") for k in range(200)] * 2
    edges = spark.createDataFrame([(a, b) for a, bs in calls.items() for b in bs], "title string, callee string")
    got = dictionary.reachable(spark.createDataFrame(starts, "key long, title string"), edges, salts)
    assert sorted(map(tuple, got.collect())) == sorted(plain_reach(calls, starts))


def test_closure_and_cycles(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "b"), ("d", "d"), ("e", "a"), ("f", "none")]
    got = {tuple(r) for r in dictionary.closure(spark.createDataFrame(edges, "title string, callee string")).collect()}
    assert got == {("a", "b", False), ("a", "c", False), ("b", "c", True), ("b", "b", True), ("c", "b", True), ("c", "c", True), ("d", "d", True), ("e", "a", False), ("e", "b", False), ("e", "c", False), ("f", "none", False)}
    assert dictionary.closure(spark.createDataFrame([], "title string, callee string")).collect() == []


def test_closure_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """A chain of 40 into a ring of 7, beside calls at random; tables are written for doublings, not for each call."""
    rng, names = random.Random(3), []
    edges = {(i, i + 1) for i in range(46)} | {(46, 40)} | {(rng.randrange(50, 80), rng.randrange(50, 80)) for _ in range(45)}
    keep = dictionary.written
    monkeypatch.setattr(dictionary, "written", lambda df, name: names.append(name) or keep(df, name))
    got = {tuple(r) for r in dictionary.closure(spark.createDataFrame([(f"t{a}", f"t{b}") for a, b in edges] * 2, "title string, callee string")).collect()}
    calls = {a: [y for x, y in edges if x == a] for a, _ in edges}
    pairs = plain_reach(calls, edges)
    assert got == {(f"t{a}", f"t{b}", (a, a) in pairs) for a, b in pairs}
    assert names.count("reached") <= 8


def test_literal_calls(spark):
    text = "{{a b|x}} {{ Safesubst: c }}{{{1|{{d}}}}} {{lc:X}} {{#if:x|{{e\n|y}}}} {{:F}} {{ {{g}} }} {{a b}} {{{h}}} {{"
    got = spark.range(1).select(dictionary.literal_calls(extraction.F.lit(text), "Template").alias("c")).first()["c"]
    assert got == ["Template:A b", "Template:C", "Template:D", "Template:E", "F", "Template:G"]


TEMPLATES = [
    ("Template:Box", "[{{{1|none}}}/{{{size|{{{2|}}}}}}]"), ("Template:Twice", "{{Box|{{{1}}}}}{{box|size={{{1}}}}}"), ("Template:Alias", "#REDIRECT [[Template:Box]]"),
    ("Template:Made", "{{ {{{1}}} |{{{2}}}}}"), ("Template:Deep", "{{Made|{{{1}}}|z}}"), ("Template:Round", "a{{Other}}"), ("Template:Other", "b{{Round}}"), ("Template:Gone", "#REDIRECT [[Template:Nowhere]]"),
]
TEXTS = [
    "A {{Twice|x}} {{Alias|y}}.", "{{Unknown|{{Box}}}} {{PAGENAME}} end", "{{Deep|Twice}} {{Deep|Nothing}} {{Deep|alias}} x", "{{Deep|Deep}} x", "{{Round}} x", "{{Gone}} x", "no call", None, "",
    "{{Made|{{lc:TWICE}}|{{#if:a|{{Made|Box|q}}}}}} x", "{{Template:Box|x}} {{:Page}} {{subst:Box|s}} x",
]


def rows(spark):
    pages = [(str(i), f"P{i % 40}", "0", TEXTS[i % len(TEXTS)]) for i in range(150)]
    templates = [(i, t, "10", x) for i, (t, x) in enumerate(TEMPLATES)]
    return spark.createDataFrame(pages, "id string, title string, ns string, text string"), spark.createDataFrame(templates, "position long, title string, ns string, text string")


def test_rounds_give_what_a_sent_dictionary_gives(spark, monkeypatch):
    pages, templates = rows(spark)
    options = Options()
    small = sorted(map(tuple, extraction.extract(pages, options, None, templates).collect()))
    failed = sorted(map(tuple, extraction.errors(pages, options, None, templates).collect()), key=repr)
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, extraction.extract(pages, options, None, templates).collect())) == small
    assert sorted(map(tuple, extraction.errors(pages, options, None, templates).collect()), key=repr) == failed


@pytest.mark.parametrize("blocks", [1, 3, 2500])
def test_blocks(spark, blocks):
    """However pages are dealt, also with several copies of a body (more than a thousand blocks)."""
    pages, templates = rows(spark)
    held = dictionary.entries(*ops.define_templates(templates))
    site, options = extraction.Site(), Options()

    def expand(own):
        each = extraction.replace(site, templates=own.view(0), redirects=own.view(1), parsed={})
        return lambda title, text: {"text": extraction.outcome_of(each, options, title, text)["text"]}

    got = dictionary.by_rounds(pages, held, "Template", expand, "struct<text: string>", blocks)
    assert got.columns == [*pages.columns, "outcome"]
    sent = extraction.template_site(spark, templates, {"namespaces": [], "template": ""}, options)
    want = {r["id"]: extraction.outcome_of(sent, options, r["title"], r["text"])["text"] for r in pages.collect()}
    assert {r["id"]: r["outcome"]["text"] for r in got.collect()} == want


def test_tables_of_the_rounds_are_removed(spark):
    pages, templates = rows(spark)
    before = set(glob.glob(f"{shared_folder(spark)}/loomtext/*"))
    large = extraction.Large(extraction.Site(), dictionary.entries(*ops.define_templates(templates)))
    extraction.by_rounds(pages, large, Options()).count()
    left = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in set(glob.glob(f"{shared_folder(spark)}/loomtext/*")) - before}
    assert left == {"expanded"}


def test_no_pages_and_no_templates(spark):
    pages, templates = rows(spark)
    empty = extraction.Large(extraction.Site(), dictionary.entries(*ops.define_templates(templates.where("false"))))
    assert extraction.by_rounds(pages.where("false"), empty, Options()).collect() == []
    assert extraction.by_rounds(pages, empty, Options()).count() == 150
