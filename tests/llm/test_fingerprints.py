"""The whole query of document fingerprints against a version of its own."""

from __future__ import annotations

import hashlib
import random
import re

import xxhash

from loomtext.llm import syncmers

from .helpers import sentence


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h64(*values):
    """Spark's xxhash64 of strings and longs: each value is hashed with the hash so far as its seed."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def anchors_of(text, k=6, s=2):
    tokens = [t for w in re.findall(r"[^\x20\x09-\x0D]+", text) for t in ([w] if len(w) <= 24 else w)]
    hashed = [h64(t) for t in tokens]
    inner = [h64(*hashed[i : i + s]) for i in range(len(hashed) - s + 1)]
    out = []
    for i in range(len(hashed) - k + 1):
        some = inner[i : i + k - s + 1]
        if min(some) in (some[0], some[-1]):
            out.append(h64(some[0], some[2], some[4]) >> 32)
    return out or ([h64(*hashed) >> 32] if hashed else [])


def numbered(found):
    seen, out = {}, []
    for x in found:
        seen[x] = seen.get(x, 0) + 1
        out.append((x, seen[x]))
    return out


def likeness(a, b):
    if not a and not b:
        return 1.0
    x, place = numbered(a), {k: i for i, k in enumerate(numbered(b))}
    runs = []
    for p, k in enumerate(x):
        if k in place:
            q = place[k]
            if runs and runs[-1][0] == p - 1 and runs[-1][2] == q - 1:
                runs[-1] = [p, runs[-1][1], q, runs[-1][3] + 1]
            else:
                runs.append([p, q, q, 1])  # last place there, first and last here, matches
    best = []
    for i, (_, first, _, n) in enumerate(runs):
        best.append(n + max((best[j] for j in range(i) if runs[j][2] < first), default=0))
    return 2 * max(best, default=0) / (len(a) + len(b))


def written(found):
    return "".join(f"{x & 0xFFFFFFFF:08x}" for x in found)


def texts():
    rng = random.Random(41)
    passage, other = sentence(rng, 60), sentence(rng, 60)
    some = [sentence(rng, n) for n in (1, 5, 6, 7, 30, 90, 400)]
    some += ["", "  \n", None, passage, " ".join([passage] * 10), f"{other} {passage}", f"{passage} {other}", passage, "x" * 300, "日本語の長い文" * 20, "é" * 40 + " " + passage, "a b c d e f g h " * 40]
    some += [sentence(rng, 25) + " " + "".join(rng.choice("abcdef01") for _ in range(200))]
    return some


def test_query(spark, tmp_path):
    rows = [(10 * i + 3, t) for i, t in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in syncmers.op4_closed_syncmers(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, _ in rows}
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r, own, changed = got[i], anchors_of(t), anchors_of(edited)
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (written(own), written(changed))
        assert abs(r["near_edited"] - likeness(own, changed)) < 1e-12 and abs(r["near_next"] - likeness(own, anchors_of(after))) < 1e-12


def test_likeness_is_positional(spark):
    rng = random.Random(42)
    a, b = sentence(rng, 80), sentence(rng, 80)
    pairs = [(a, a), (a, " ".join([a] * 10)), (f"{a} {b}", f"{b} {a}"), (f"{a} {b}", f"{a} {sentence(rng, 5)} {b}")]
    df = spark.createDataFrame(pairs, "a string, b string").select(*[syncmers.anchors(syncmers.F.col(c)).alias(c) for c in "ab"])
    rows = df.select("a", "b", syncmers.likeness(*[syncmers.numbered(syncmers.F.col(c)) for c in "ab"]).alias("x")).collect()
    assert [r["x"] for r in rows] == [likeness(r["a"], r["b"]) for r in rows]
    same, repeated, moved, grown = (r["x"] for r in rows)
    assert same == 1 and repeated < 0.25 and moved < 0.6 and grown > 0.9


def test_passage_in_text_without_spaces(spark):
    rng = random.Random(43)
    passage = "".join(rng.choice("日本語長文字漢仮名交") for _ in range(80))
    rows = [(i, "".join(rng.choice("一二三四五六七") for _ in range(n)) + passage) for i, n in enumerate((30, 41))]
    x, y = (set(r["anchors"]) for r in syncmers.fingerprint(spark.createDataFrame(rows, "doc_id int, text string")).orderBy("doc_id").collect())
    assert len(x & y) > 15
