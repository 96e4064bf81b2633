"""The contracts' columns of whole queries, from a written table, against versions of their own."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from loomtext.llm import bytebpe, pii, registry, suffixes, tokenfile

from .helpers import awkward, frame
from .test_contracts import brute_cut, ids_of

RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub("[^0-9]", "", s)) <= 19 and pii.luhn(re.sub("[^0-9]", "", s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
]


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = [r for r in awkward() if r[0] is not None]
    rows += [(500 + i, t, "en", "s", 0) for i, t in enumerate(["é bob@x.org 10.1.2.3 a", 'token = "0123456789abcdef0123456789abcdef01234567"', "\U0001f600 " * 40 + "+1 514 555 8389", "4111111111111111 4111111111111112"])]
    path = tmp_path_factory.mktemp("query")
    frame(spark, rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def result(spark, table, number):
    name = next(q for q in registry.QUERIES if q.startswith(f"op{number}_"))
    return registry.QUERIES[name](spark, table[0]).collect()


def test_op5(spark, table):
    own = bytebpe.encoding()
    want = Counter()
    for i, t, *_ in table[1]:
        ids = own.encode_ordinary(t or "")
        want[i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in result(spark, table, 5)) == want


def test_op6(spark, table):
    want = Counter()
    for i, t, *_ in table[1]:
        spans = [(kind, m.start(), m.end()) for kind, p, ok in RULES for m in re.finditer(p, t or "") if ok(m[0])]
        text = ",".join(f"{k}:{a}:{z}" for k, a, z in spans)
        want[i, *(sum(s[0] == k for s in spans) for k, *_ in RULES), sha(text.encode()), text] += 1
    rows = result(spark, table, 6)
    added = [r["spans"][len(base) :].lstrip(",") for r in rows for base in [",".join(x for x in r["spans"].split(",") if not x.startswith("id:"))]]
    got = Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], ",".join(x for x in r["spans"].split(",") if not x.startswith("id:"))) for r in rows)
    assert got == want and [a for a in added if a] == ["id:9:49"]


def test_op7(spark, table):
    rows = result(spark, table, 7)
    want = Counter((i, k, a, len(x[a : a + 4096]), zlib.crc32(x[a : a + 4096].tobytes())) for i, t, *_ in table[1] for x in [ids_of(t)] for k, a in enumerate(range(0, len(x), 4096)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        assert [a for a, _ in sorted(b)] == np.cumsum([0, *(n for _, n in sorted(b))])[:-1].tolist() and sum(n for _, n in b) <= 4096


def test_op8(spark, table):
    rows = sorted(result(spark, table, 8), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted(i for i, *_ in table[1])
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    want = Counter((i, len(x), zlib.crc32(x.tobytes())) for i, t, *_ in table[1] for x in [ids_of(t)])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want


def test_op9(spark, table):
    fps = {}
    for _, t, *_ in table[1]:
        low = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(low[k : k + 4]).encode(), 42) for k in range(max(1, len(low) - 3))] if low else []
        fps[t] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    root = {f: f for f in fps.values()}
    for _ in root:
        for f in root:
            root[f] = min(root[g] for g in root if (f ^ g).bit_count() <= 4)
    least = {}
    for i, t, *_ in table[1]:
        least[root[fps[t]]] = min(i, least.get(root[fps[t]], i))
    want = Counter((i, f"{fps[t]:016x}", least[root[fps[t]]]) for i, t, *_ in table[1])
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in result(spark, table, 9)) == want


def test_op10(spark, table):
    rows = {}
    for i, t, *_ in sorted(table[1], key=lambda r: r[0]):
        rows.setdefault(i, t)
    single = [(i, t) for i, t in rows.items() if sum(x[0] == i for x in table[1]) == 1]
    # rows of one id count in the order they are read: the table without them has one answer
    df = spark.createDataFrame(single, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in suffixes.remove_repeats(df, carry=["doc_id"]).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)").collect()), key=repr)
    assert got == brute_cut(sorted(single)) and len(result(spark, table, 10)) == len(table[1])


def test_range_reads_use_the_marks(spark):
    rng = np.random.default_rng(71)
    for values in (rng.integers(0, 50_000, 5000, dtype=np.uint64), np.where(rng.random(5000) < 0.2, np.uint64(2**63), np.uint64(3)), np.zeros(0, np.uint64)):
        words, at, starts = tokenfile.packed(values)
        for stride in (1, 7, 256):
            marks = np.unique(np.searchsorted(at, np.arange(0, len(words), stride)))
            marks = marks[marks < len(at)]
            for a, z in ((0, 10), (17, 900), (4990, 5000), (0, 5000), (5, 5)):
                a, z = min(a, len(values)), min(z, len(values))
                assert tokenfile.unpack_range(words, at[marks], starts[marks], a, z).tolist() == values[a:z].tolist()


def test_range_of_the_collection(spark, table):
    docs = spark.read.parquet(f"{table[0]}/documents.parquet")
    files = tokenfile.write_files(docs, files=4, block=300, stride=4)
    whole = np.concatenate([np.array(r["ids"]) for r in tokenfile.read_range(files, 0, 1 << 60).orderBy("start").collect()])
    ordered = [ids_of(t) for _, t in sorted(((i, t or "") for i, t, *_ in table[1]))]
    assert whole.tolist() == np.concatenate(ordered).tolist()
    for a, z in ((0, 5), (250, 910), (len(whole) - 3, len(whole) + 9)):
        some = tokenfile.read_range(files, a, z).orderBy("start").collect()
        assert some[0]["start"] == a and [x for r in some for x in r["ids"]] == whole[a:z].tolist()


def test_text_ids(spark):
    rows = [(f"d{i:03}", "word " * i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    out = tokenfile.read_files(tokenfile.write_files(df, files=5)).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == [i for i, _ in rows]
