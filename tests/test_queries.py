"""Every query with SQL against DuckDB; sources, sink and streaming on small dumps."""

import bz2
import glob
import json
import os

import duckdb
import pytest

from loomtext.options import Options
from loomtext.plans import extract as extraction
from loomtext.plans import queries as own
from loomtext.sources import dump, listing, sink
from loomtext.streaming.extract import extract_stream

SF = "/root/testdata/sf0.001"

DUMP = """<mediawiki>
<siteinfo><base>https://x.org/wiki/Main</base><namespaces><namespace key="0" /><namespace key="10">Template</namespace><namespace key="828">Module</namespace></namespaces></siteinfo>
<page>
<title>One</title>
<ns>0</ns>
<id>7</id>
<revision><id>1</id>
<text bytes="3">'''One''' &amp; [[Two (x)|two]]
{{T|Bob}}[[Category:R&amp;B|k]]</text></revision>
</page>
<page>
<title>One</title>
<ns>0</ns>
<id>7</id>
<revision><text>again</text></revision>
</page>
<page>
<title>Old</title>
<ns>0</ns>
<id>8</id>
<redirect title="One" />
<revision><text>#REDIRECT [[One]]</text></revision>
</page>
<page>
<title>Category:Dogs</title>
<ns>14</ns>
<id>9</id>
<revision><text>{{Cat main|Dog}} text</text></revision>
</page>
<page>
<title>Template:T</title>
<ns>10</ns>
<id>10</id>
<revision><text>Hi {{{1|you}}}&lt;noinclude&gt;doc&lt;/noinclude&gt;</text></revision>
</page>
<page>
<title>Empty</title>
<ns>0</ns>
<id>11</id>
<revision><text bytes="0" /></revision>
</page>
</mediawiki>
"""


@pytest.fixture(scope="module")
def dump_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "d.xml.bz2"
    path.write_bytes(bz2.compress(DUMP.encode()))
    return str(path)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(own.ORACLES))
def test_query(spark, tables, name):
    df = own.QUERIES[name](spark, SF)
    want = tables.sql(own.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(repr(tuple(dict(zip(want.columns, r, strict=True))[c] for c in columns)) for r in want.fetchall())


def test_dump(spark, dump_file):
    assert dump.read_site(spark, dump_file) == {"urlbase": "https://x.org/wiki", "namespaces": ["Template", "Module"], "template": "Template", "module": "Module"}
    rows = extraction.extract_dump(spark, dump_file, Options(), dump_file, ordered=True).collect()
    assert [r["id"] for r in rows] == ["7", "9", "11"]
    one, dogs, empty = rows
    assert one["text"] == "One & two\nHi Bob\n" and one["related"] == ["Two"] and one["categories"] == ["R&amp;B"]
    assert one["url"] == "https://x.org/wiki?curid=7" and one["segment_text"] == ["One", "&", "two", "Hi", "Bob"]
    assert (dogs["title"], dogs["isCategory"], dogs["isArticle"], dogs["mainArticle"]) == ("Dogs", True, False, "Dog")
    assert empty["text"] == "" and empty["categories"] == []
    without = extraction.extract_dump(spark, dump_file).where("id = '7'").first()
    assert without["text"] == "One & two\n"


def test_metadata_never_start_python(spark, dump_file):
    pages = dump.read_pages(spark, dump_file)
    plan = extraction.extract(pages).select("categories")._jdf.queryExecution().optimizedPlan().toString()
    assert "segment" not in plan.lower() or "run(text" not in plan


def test_errors(spark):
    pages = spark.createDataFrame([("1", "A", "{{IPA}} x"), ("2", "B", "fine"), ("3", "C", "* a\n&#123;&#123;IPA&#125;&#125;")], "id string, title string, text string")
    assert {r["id"] for r in extraction.extract(pages).collect()} == {"1", "2"}
    failed = extraction.errors(pages).collect()
    assert [r["id"] for r in failed] == ["3"] and "IndexError" in failed[0]["error"]


def test_large_template_dictionary(spark, dump_file, monkeypatch):
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", 1)
    rows = extraction.extract_dump(spark, dump_file, Options(), dump_file).where("id = '7'").collect()
    assert "Hi Bob" in rows[0]["text"]


def test_split_files(spark, tmp_path):
    df = spark.range(300).selectExpr("id AS n", "repeat('x', 50) AS text", "array() AS none")
    sink.write_split(spark, df, str(tmp_path / "o"), max_bytes=1000, order="n")
    names = sorted(glob.glob(f"{tmp_path}/o/*/wiki_*"))
    assert names[0].endswith("AA/wiki_00") and all(os.path.getsize(n) <= 1000 for n in names)
    lines = [json.loads(x) for n in names for x in open(n)]
    assert len(lines) == 300 and lines[0] == {"text": "x" * 50, "none": []}
    assert sink.file_name(2599) == "AZ/wiki_99" and sink.file_name(2600) == "BA/wiki_00"
    sink.write_split(spark, df, str(tmp_path / "z"), compress=True)
    packed = glob.glob(f"{tmp_path}/z/task-*/*/*.bz2")
    assert sum(len(bz2.open(n).readlines()) for n in packed) == 300


def test_json(spark, tmp_path):
    sink.write_json(spark.range(1).coalesce(1).selectExpr("'' AS a", "array() AS b", "cast(NULL AS string) AS c"), str(tmp_path / "j"))
    line = "".join(open(f).read() for f in glob.glob(f"{tmp_path}/j/part*"))
    assert json.loads(line) == {"a": "", "b": [], "c": None}


def test_template_file(spark, dump_file, tmp_path):
    pages = dump.read_pages(spark, dump_file).where("ns = '10'")
    dump.write_template_file(pages, str(tmp_path / "t"))
    again = dump.read_pages(spark, str(tmp_path / "t")).select("title", "ns", "id", "text").collect()
    assert again == pages.select("title", "ns", "id", "text").collect()


def test_single_file_listing(spark):
    html = '<a href="enwiki-latest-pages-articles.xml.bz2">x</a>  02-Jan-2024 10:11   200000\n<a href="enwiki-latest-stub.xml.bz2">y</a> 02-Jan-2024 10:11 5'
    df = spark.createDataFrame([(html, "https://x/", "en")], "html string, base string, lang string")
    rows = listing.part_numbers(listing.parse_listing(df)).collect()
    assert [(r["url"], r["size"], r["number"]) for r in rows] == [("https://x/enwiki-latest-pages-articles.xml.bz2", 200000, "0")]


def test_stream(spark, dump_file, tmp_path):
    query = extract_stream(spark, os.path.dirname(dump_file), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    query.awaitTermination(120)
    assert {r["id"] for r in spark.read.json(str(tmp_path / "out")).collect()} == {"7", "9", "11"}


def test_discarded_elements_go_in_order(spark):
    """The native expression against one replacement after the other."""
    import random
    import re

    from loomtext.functions import markup
    from loomtext.wikitext.clean import DISCARDED

    rng = random.Random(5)
    parts = ["<table>", "</table>", "<TR x=y>", "</tr >", "< li >", "</li>", "<ref/>", "<div a/b>", "</ div>", "<div>", "text", "\n", "<p>", "</p>", "<small>", "</small>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)]
    want = []
    for t in texts:
        for tag in DISCARDED:
            t = re.sub(rf"(?is)<\s*{tag}\b[^>/]*>.*?<\s*/\s*{tag}>", "", t)
        want.append(t)
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", markup.without_elements(markup.F.col("t")).alias("x"))
    assert [r["x"] for r in df.orderBy("n").collect()] == want


def test_places_of_a_large_group_come_from_several_tasks(spark, monkeypatch):
    """one language's files were ranked in one task."""
    kept, written = [], listing.written
    monkeypatch.setattr(listing, "written", lambda df, name: kept.append(out := written(df, name)) or out)
    rows = [("a" if i % 50 else None, i * 7919 % 1000, f"f{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "lang string, size long, filename string")
    got = {r["filename"]: r["place"] for r in listing.placed(df, ["lang"], [listing.F.desc("size"), listing.F.asc("filename")], "place").collect()}
    for lang in ("a", None):
        order = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[1], r[2]))
        assert [got[f] for _, _, f in order] == list(range(len(order)))
    shares = [r["count"] for r in kept[0].groupBy("__task").count().collect()]
    assert len(shares) > 2 and max(shares) < 600
