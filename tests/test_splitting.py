"""Files of bounded size against one writer that goes through all rows."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators import splitting
from loomtext.sources import sink


def one_writer(sizes, most):
    out, filled, file = [], 0, 0
    for i, size in enumerate(sizes):
        if i and filled + size > most:
            file, filled = file + 1, 0
        filled += size
        out.append(file)
    return out


def shapes():
    r = random.Random(5)
    return {
        "even": [10] * 400,
        "mixed": [r.choice([1, 2, 3, 7, 50, 99, 100, 101]) for _ in range(1500)],
        "tiny, then long": [1] * 300 + [5000] + [1] * 90 + [2500, 2500] + [3] * 200,
        "all long": [1000] * 40,
        "one": [7],
        "none": [],
        "exact": [50, 50, 100, 100, 1, 99, 60, 41],
    }


@pytest.mark.parametrize("name", shapes())
def test_numbers_are_those_of_one_writer(spark, name):
    sizes = shapes()[name]
    rows = spark.createDataFrame([(i // 3 if i else None, i, s) for i, s in enumerate(sizes)], "key long, n long, size int").repartition(5)  # ties, a null key
    got = {r["n"]: r["file"] for r in splitting.file_numbers(rows, 100, 400).collect()}
    assert [got[i] for i in range(len(sizes))] == one_writer(sizes, 100) and len(got) == len(sizes)
    assert {r["n"]: r["file"] for r in splitting.file_numbers(rows, 100).collect()} == got  # all in one block


def test_steps_are_composed(spark):
    """No task sees more than its block: pointers stay inside one, and the path is found by doubling."""
    sizes = [random.Random(9).randint(1, 60) for _ in range(3000)]
    placed = splitting.offsets(spark.createDataFrame(list(enumerate(sizes)), "n long, size int").withColumn("key", F.col("n")))
    pointers = splitting.entries(placed, 100, 400)
    rows = pointers.collect()
    assert all(r["at"] // 400 < r["to"] // 400 <= r["at"] // 400 + 1 or r["to"] == sum(sizes) for r in rows)
    assert len({r["at"] // 400 for r in rows}) == -(-sum(sizes) // 400)
    path = splitting.entered(pointers, sum(sizes)).collect()
    assert len(path) == len({r["at"] // 400 for r in path}) == -(-sum(sizes) // 400)


def test_files_are_those_of_one_writer(spark, tmp_path):
    rows = [(i, "é" * (i * 37 % 90), None if i % 7 == 0 else i) for i in range(700)]
    df = spark.createDataFrame(rows, "n long, text string, start long").repartition(6)
    for compress in (False, True):
        out = f"{tmp_path}/{compress}"
        sink.write_split(spark, df, out, 1000, compress, "n")
        names = sorted(glob.glob(f"{out}/*/wiki_*"))
        lines = [spark.read.text(n).collect() for n in names[:3]] if compress else [open(n).read().splitlines() for n in names]
        assert [os.path.relpath(n, out) for n in names] == [sink.file_name(i) + (".bz2" if compress else "") for i in range(len(names))]
        assert not os.path.exists(f"{out}/_temporary")
    plain = [x for n in sorted(glob.glob(f"{tmp_path}/False/*/wiki_*")) for x in open(n).read().splitlines()]
    expected = one_writer([len(x.encode()) + 1 for x in plain], 1000)
    assert len(plain) == 700 and '"start":null' in plain[0]
    lines = [open(n).read().splitlines() for n in sorted(glob.glob(f"{tmp_path}/False/*/wiki_*"))]
    assert [i for i, some in enumerate(lines) for _ in some] == expected
    assert [x for some in lines for x in some] == [r[0] for r in df.orderBy("n").select(F.to_json(F.struct("text", "start"), {"ignoreNullFields": "false"})).collect()]


def test_names(spark):
    numbers = [0, 99, 100, 2599, 2600, 67599, 67600, 67699, 1757599, 1757600, 99999999]
    df = spark.createDataFrame([(n,) for n in numbers], "file long").select("file", F.concat_ws("/", splitting.folder_name("file"), splitting.base_name("file")).alias("name"))
    assert [r["name"] for r in df.orderBy("file").collect()] == [sink.file_name(n) for n in numbers]
    assert sink.file_name(67599) == "ZZ/wiki_99" and sink.file_name(67600) == "BAA/wiki_00"
