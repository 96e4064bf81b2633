"""Updates against runs over all pages."""

from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from loomtext.options import Options
from loomtext.plans import extract as extraction
from loomtext.plans import run, snapshots

from .test_queries import DUMP

AS_OF = datetime(2024, 1, 2, tzinfo=timezone.utc)
TEXTS = {
    "1": "plain text.", "2": "{{Box|a}} box.", "3": "{{Outer}} outer.", "4": "{{Moved|b}} moved.", "5": "{{Absent}}absent.",
    "6": "{{Bo{{Letter}}|c}} made.", "7": "{{CURRENTYEAR}} year.", "8": "gone.", "9": "", "10": None, "11": "{{#if: x | {{Other}} | {{Box}} }} other.",
}
BODIES = {"Box": "[{{{1|x}}}]", "Outer": "out {{Box|in}}", "Moved": "#REDIRECT [[Template:Box]]", "Letter": "x", "Other": "other", "Bob": "BOB"}


def pages_of(spark, texts, copies=()):
    rows = [(i, f"T{i}", "0", t) for i, t in [*texts.items(), *((c, texts[c]) for c in copies)]]
    return spark.createDataFrame(rows, "id string, title string, ns string, text string")


def templates_of(spark, bodies):
    return spark.createDataFrame([(i, f"Template:{k}", "10", b) for i, (k, b) in enumerate(bodies.items())], "position long, title string, ns string, text string")


def records(df):
    return sorted(map(repr, df.select(*extraction.OUTPUT).collect()))


@pytest.mark.parametrize(
    ("texts", "bodies", "seconds", "ran"),
    [
        ({}, {}, 0, set()),
        ({"1": "changed text.", "12": "new."}, {}, 0, {"1", "12"}),
        ({}, {"Box": "<{{{1|y}}}>"}, 0, {"2", "3", "4", "6"}),  # at once, through others, by a redirect, by a made name; 11 never asks for it
        ({}, {"Absent": "now here "}, 0, {"5"}),
        ({}, {"Letter": "b"}, 0, {"6"}),
        ({}, {"Other": "else"}, 0, {"11"}),
        ({}, {"Moved": "#REDIRECT [[Template:Other]]"}, 0, {"4"}),
        ({}, {"Unused": "u"}, 0, set()),
        ({}, {}, 5, {"7"}),
    ],
)
def test_only_changed_pages_run_and_the_rest_is_the_same(spark, first, texts, bodies, seconds, ran):
    now = {k: v for k, v in {**TEXTS, **texts}.items() if k != "8"}
    options = Options(as_of=AS_OF + timedelta(seconds=seconds))
    pages, templates = pages_of(spark, now), templates_of(spark, {**BODIES, **bodies})
    rows, _ = snapshots.take(pages, options, None, templates, first)
    rows = rows.cache()
    assert {r["id"] for r in rows.where("fresh").collect()} == ran
    assert records(rows.where("error IS NULL")) == records(extraction.extract(pages, options, None, templates))


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    place = tmp_path_factory.mktemp("first")
    rows, entries = snapshots.take(pages_of(spark, TEXTS), Options(as_of=AS_OF), None, templates_of(spark, BODIES))
    rows.write.parquet(f"{place}/rows")
    entries.write.parquet(f"{place}/entries")
    return spark.read.parquet(f"{place}/rows"), spark.read.parquet(f"{place}/entries")


def test_copies_and_other_settings_and_no_pages(spark, first):
    options, templates = Options(as_of=AS_OF), templates_of(spark, BODIES)
    twice = snapshots.take(pages_of(spark, TEXTS, ["2", "2"]), options, None, templates, first)[0].collect()
    assert sorted(r["id"] for r in twice if r["fresh"]) == ["2"] * 3 and len(twice) == len(TEXTS) + 2
    html = snapshots.take(pages_of(spark, TEXTS), replace(options, html=True), None, templates, first)[0].collect()
    assert all(r["fresh"] for r in html)
    assert snapshots.take(pages_of(spark, {}), options, None, templates, first)[0].collect() == []
    assert {r["id"] for r in snapshots.take(pages_of(spark, TEXTS), options, None, None, first)[0].where("fresh").collect()} == {"2", "3", "4", "6", "11"}


def test_joined_dictionary(spark, first, monkeypatch):
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", 1)
    bodies = {**BODIES, "Box": "({{{1|z}}})"}
    rows = snapshots.take(pages_of(spark, TEXTS), Options(as_of=AS_OF), None, templates_of(spark, bodies), first)[0].collect()
    assert {r["id"] for r in rows if r["fresh"]} == {"2", "3", "4", "6"}
    assert {r["id"]: r["text"].strip() for r in rows}["6"] == "(c) made." and {r["id"]: r["text"].strip() for r in rows}["3"] == "out (in) outer."


def test_update_of_a_dump(spark, tmp_path):
    options = Options(as_of=AS_OF)
    (tmp_path / "a.xml").write_text(DUMP)
    (tmp_path / "b.xml").write_text(DUMP.replace("Cat main|Dog}} text", "Cat main|Dog}} other text"))
    run.extract_to(spark, f"{tmp_path}/a.xml", f"{tmp_path}/x", options, f"{tmp_path}/t")
    one = snapshots.update(spark, f"{tmp_path}/a.xml", f"{tmp_path}/o", "1", options, f"{tmp_path}/t")
    two = snapshots.update(spark, f"{tmp_path}/b.xml", f"{tmp_path}/o", "2", options, f"{tmp_path}/t")
    assert (one.records, one.ran, two.records, two.ran) == (3, 3, 3, 1) and (tmp_path / "o" / "LATEST").read_text() == "2"
    whole = extraction.extract_dump(spark, f"{tmp_path}/b.xml", options, f"{tmp_path}/t")
    assert records(spark.read.schema(whole.schema).json(f"{tmp_path}/o/date=2")) == records(whole)
    with pytest.raises(ValueError):
        snapshots.update(spark, f"{tmp_path}/b.xml", f"{tmp_path}/o", "2", options)
