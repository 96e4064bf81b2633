"""Whole runs, sinks, downloads, table functions, streaming, and what they rest on."""

import bz2
import glob
import io
import json
import os
import sys
import time
import types
from contextlib import redirect_stdout
from datetime import datetime

import pytest

from loomtext import __main__ as cli
from loomtext import tokenize
from loomtext.functions import tables
from loomtext.operators import pages as ops
from loomtext.options import Options
from loomtext.plans import extract as extraction
from loomtext.plans import run
from loomtext.sources import dump, fetch, sink
from loomtext.streaming.extract import extract_stream

from .test_queries import DUMP


@pytest.fixture(scope="module")
def dump_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "d.xml.bz2"
    path.write_bytes(bz2.compress(DUMP.encode()))
    return str(path)


def lines_of(folder):
    names = sorted(glob.glob(f"{folder}/*/wiki_*") + glob.glob(f"{folder}/task-*/*/wiki_*"))
    return names, [json.loads(x) for n in names for x in (bz2.open(n) if n.endswith(".bz2") else open(n)).read().splitlines()]


def test_run_to_files(spark, dump_file, tmp_path):
    done = run.extract_to(spark, dump_file, f"{tmp_path}/o", Options(max_bytes=300, compress=True), ordered=True)
    names, records = lines_of(f"{tmp_path}/o")
    assert done.records == 3 and done.rate > 0 and [r["id"] for r in records] == ["7", "9", "11"]
    assert len(names) == 3 and names[0].endswith("AA/wiki_00.bz2") and set(records[0]) == set(extraction.OUTPUT)
    run.extract_to(spark, dump_file, f"{tmp_path}/p")
    assert {r["id"] for r in lines_of(f"{tmp_path}/p")[1]} == {"7", "9", "11"} and not os.path.exists(f"{tmp_path}/p/_temporary")


def test_run_to_standard_output(spark, dump_file, tmp_path):
    out = io.StringIO()
    with redirect_stdout(out):
        run.extract_to(spark, dump_file, "-", template_path=f"{tmp_path}/templates")
    records = [json.loads(x) for x in out.getvalue().splitlines()]
    assert {r["id"] for r in records} == {"7", "9", "11"} and "Hi Bob" in next(r["text"] for r in records if r["id"] == "7")
    assert {r["title"] for r in dump.read_pages(spark, f"{tmp_path}/templates").collect()} == {"Template:T"}  # written, for the next run


def test_command_line(spark, dump_file, tmp_path):
    a = cli.arguments([dump_file, "-o", "x", "-b", "300K", "-c", "--lists", "-ns", "w,s", "--no-templates", "-q"])
    o = cli.options_of(a)
    assert (o.max_bytes, o.compress, o.lists, o.link_prefixes, o.expand_templates) == (300 << 10, True, True, ("w", "s"), False)
    assert cli.options_of(cli.arguments([dump_file])).max_bytes == 1 << 20
    with pytest.raises(SystemExit):
        cli.arguments([dump_file, "-b", "1K"])
    out = io.StringIO()
    with redirect_stdout(out):
        assert cli.main([dump_file, "-a", "-q"]) == 0
    records = [json.loads(x) for x in out.getvalue().splitlines()]
    assert "10" in {r["id"] for r in records} and {r["url"] for r in records} >= {"?curid=7"}  # templates, too; no base


def test_languages(spark, dump_file, tmp_path):
    for date in ("20240101", "20240201"):
        reports = run.extract_languages(spark, {"en": dump_file, "id": dump_file}, str(tmp_path), date)
    assert {k: v.records for k, v in reports.items()} == {"en": 3, "id": 3}
    assert open(f"{tmp_path}/lang=en/LATEST").read() == "20240201"
    assert spark.read.json(f"{tmp_path}/lang=*/date=*").count() == 12 and os.path.exists(dump_file)
    with pytest.raises(ValueError):
        run.extract_languages(spark, {}, str(tmp_path), "../x")


def test_download(spark, tmp_path):
    (tmp_path / "remote").mkdir()
    rows = []
    for i in range(5):
        (tmp_path / "remote" / f"f{i}").write_bytes(b"x" * (i * 1000))
        rows.append((f"file://{tmp_path}/remote/f{i}", f"en/f{i}", i * 1000 + (i == 3), datetime(2024, 1, 2, 3, 4)))
    rows.append((f"file://{tmp_path}/remote/none", "en/none", 5, None))
    listing = spark.createDataFrame(rows, "url string, path string, size long, date timestamp")
    out = {r["path"]: r["error"] for r in fetch.download(listing, f"{tmp_path}/local").collect()}
    assert [out[f"en/f{i}"] for i in (0, 1, 2, 4)] == [None] * 4 and "3000 bytes of 3001" in out["en/f3"] and out["en/none"]
    assert sorted(os.listdir(f"{tmp_path}/local/en")) == ["f0", "f1", "f2", "f4"]
    assert os.path.getmtime(f"{tmp_path}/local/en/f1") == datetime(2024, 1, 2, 3, 4).timestamp()


def test_ordered_files_are_numbered_through_all_tasks(spark, tmp_path):
    df = spark.range(400).selectExpr("id AS n", "repeat('x', 50) AS text").repartition(7)
    sink.write_split(spark, df, f"{tmp_path}/o", max_bytes=1000, order="n")
    names = sorted(glob.glob(f"{tmp_path}/o/*/wiki_*"))
    assert [os.path.relpath(n, f"{tmp_path}/o") for n in names] == [sink.file_name(i) for i in range(len(names))]
    assert sum(len(open(n).readlines()) for n in names) == 400
    other = f"{tmp_path}/o/_temporary/other/x"
    os.makedirs(other)
    sink.write_split(spark, df, f"{tmp_path}/o", max_bytes=1000)
    assert os.path.exists(other)  # of a job that runs at the same time


def test_repeats_across_partitions(spark):
    rows = [(p, (part << 33) + i, str(n)) for p, part, i, n in [("a", 0, 0, 1), ("a", 0, 1, 1), ("a", 0, 2, 2), ("a", 2, 0, 2), ("a", 2, 1, 3), ("a", 3, 0, 3), ("b", 1, 0, 3), ("b", 1, 1, 4)]]
    pages = spark.createDataFrame(rows, "path string, position long, id string").selectExpr("position", "id", "'t' AS text", "path")
    for most in (100, 0):
        out = ops.without_repeats(pages, most)
        assert out.columns == pages.columns
        assert sorted((r["path"], r["position"] >> 33, r["id"]) for r in out.collect()) == [("a", 0, "1"), ("a", 0, "2"), ("a", 2, "3"), ("b", 1, "3"), ("b", 1, "4")]
    assert ops.without_repeats(pages.where("false")).collect() == []
    plan = ops.without_repeats(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "Window" in x and "text" in x]


def test_site(spark, tmp_path):
    (tmp_path / "plain.xml").write_text(DUMP[DUMP.index("</siteinfo>") + 11 :])
    assert dump.read_site(spark, f"{tmp_path}/plain.xml") == {"urlbase": "", "namespaces": [], "template": "", "module": ""}
    (tmp_path / "none.xml").write_text("")
    assert dump.read_site(spark, f"{tmp_path}/none.xml")["urlbase"] == ""


def template_pages(spark, word):
    rows = [("Template:T", f"{word} {{{{{{1}}}}}}"), ("Template:U", "#REDIRECT [[Template:T]]")]
    return spark.createDataFrame([(i, t, "10", x) for i, (t, x) in enumerate(rows)], "position long, title string, ns string, text string")


@pytest.mark.parametrize("most", [1 << 26, 1])
def test_two_dictionaries_of_one_session(spark, monkeypatch, most):
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", most)
    pages = spark.createDataFrame([("1", "A", "{{T|x}} {{U|y}} {{Nothing}}end")], "id string, title string, text string")
    for word in ("first", "second"):
        row = extraction.extract(pages, Options(), None, template_pages(spark, word)).first()
        assert row["text"] == f"{word} x {word} y end\n"


def test_table_functions(spark):
    tables.register(spark)
    rows = spark.sql("SELECT id, n, line FROM VALUES (1, 'a\n\nb c'), (2, NULL) AS t(id, text), LATERAL text_lines(text)").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "a"), (1, 2, "b c")]
    rows = spark.sql("SELECT n, token FROM text_tokens('en', 'It''s here.')").collect()
    assert [r["token"] for r in rows] == ["It", "'s", "here", "."]


def test_stream_with_templates(spark, dump_file, tmp_path):
    query = extract_stream(spark, os.path.dirname(dump_file), f"{tmp_path}/out", f"{tmp_path}/ckpt", template_path=dump_file)
    query.awaitTermination(120)
    rows = spark.read.json(f"{tmp_path}/out").collect()
    assert sorted(r["id"] for r in rows) == ["11", "7", "9"] and "Hi Bob" in next(r["text"] for r in rows if r["id"] == "7")


def test_adapters_with_stand_ins(monkeypatch):
    """The segmenters of libraries that are not installed, with modules that have the same interface."""

    def module(name, **things):
        monkeypatch.setitem(sys.modules, name, types.ModuleType(name))
        for k, v in things.items():
            setattr(sys.modules[name], k, v)

    module("konlpy")
    module("konlpy.tag", Mecab=lambda: types.SimpleNamespace(morphs=lambda s: s.split()))
    module("pyknp", Juman=lambda: types.SimpleNamespace(analysis=lambda s: [types.SimpleNamespace(midasi=c) for c in s]))
    module("zhconvert", conv2tw=lambda s: s.replace("国", "國"))
    module("stanford_segmenter", Segmenter=lambda: types.SimpleNamespace(tw_segment=lambda s: list(s)))
    tokenize.segmenter.cache_clear()
    try:
        assert tokenize.segment("ko", "가 나\n다") == ["가", "나", "다"]
        assert tokenize.segment("ja", "日本 ab cd") == ["日", "本", "a", "b", "_", "c", "d"]
        assert tokenize.segment("zh", "中国 人") == ["中", "國", "人"]
        with pytest.raises(KeyError):
            tokenize.segment("xx", "a")
    finally:
        tokenize.segmenter.cache_clear()


def test_failing_lines_are_skipped(monkeypatch):
    made = []

    def maker():
        made.append(1)
        return lambda s: 1 / 0 if "bad" in s else s.split()

    monkeypatch.setitem(tokenize.SEGMENTERS, "tt", maker)
    assert tokenize.segment("tt", "a b\nbad\nc") == ["a", "b", "c"] and len(made) == 2
    assert tokenize.segment("tt", "a\nb", seconds=-1) == []


def test_a_segmenter_that_never_returns_costs_one_line(monkeypatch):
    def run(sentence):
        while "forever" in sentence:
            time.sleep(0.05)
        if "crash" in sentence:
            os._exit(3)
        return sentence.split()

    monkeypatch.setitem(tokenize.SEGMENTERS, "tt", lambda: run)
    tokenize.segmenter.cache_clear()
    began = time.monotonic()
    try:
        assert tokenize.segment("tt", "a b\nforever c\nd\ncrash\ne f\nforever", seconds=0.5) == ["a", "b", "d", "e", "f"]
        assert time.monotonic() - began < 10
        assert tokenize.segment("tt", "g\nh", seconds=0.5) == ["g", "h"]
    finally:
        tokenize.segmenter.cache_clear()


def test_document_store(spark, tmp_path):
    """With a stand-in for the connector, which writes what it is given to a folder."""
    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    from loomtext.sources.store import load_store

    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.place = f"{options['connection.uri']}/{options['database']}.{options['collection']}"

        def write(self, rows):
            import os
            import uuid

            os.makedirs(self.place, exist_ok=True)
            with open(f"{self.place}/{uuid.uuid4().hex}", "w") as f:
                f.writelines(f"{r[0]}\n" for r in rows)
            return WriterCommitMessage()

    class Store(DataSource):
        @classmethod
        def name(cls):
            return "standin"

        def writer(self, schema, overwrite):
            return Writer(dict(self.options))

    df = spark.range(5).selectExpr("concat('t', id) AS title")
    with pytest.raises(RuntimeError, match="no Spark connector"):
        load_store(df, str(tmp_path), "en", connector="nothing_of_that_name")
    spark.dataSource.register(Store)
    load_store(df, str(tmp_path), "en", connector="standin")
    lines = [x for n in glob.glob(f"{tmp_path}/NLP.enwiki/*") for x in open(n).read().split()]
    assert sorted(lines) == [f"t{i}" for i in range(5)]
