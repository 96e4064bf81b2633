"""Every operator on awkward and on empty tables, and against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from loomtext.llm import bytebpe, langid, packing, pii, quality, sharding, simhash, suffixes, syncmers, tokenfile

from .helpers import SCHEMA, awkward, frame, rows_of, sentence, untouched


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, awkward())


@pytest.fixture(scope="module")
def written(spark, odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "documents.parquet")
    odd.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 1: quality ---


def base_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, inside, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside.update(range(i, i + 8))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), len(words) < 20 or 100 * len(inside) > 30 * len(words)


def test_quality_counts(spark, odd, empty):
    more = [(100 + i, " ".join(["a b c d e f g h i"] * n), "en", "s", 0) for i, n in enumerate((1, 2, 5))]
    df = frame(spark, awkward() + more)
    out = quality.judge(df).select("doc_id", "text", "__q.*")
    for r in out.collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base_of(r["text"])
        assert r["kept"] is False or not r["base_failed"]
    assert out.count() == len(awkward()) + 3
    assert quality.keep_good(empty).collect() == [] and quality.keep_good(empty).columns == empty.columns
    assert quality.keep_good(df).columns == df.columns and untouched(quality.keep_good(df))


def test_quality_divergence(spark):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice("the of and to in is stone river music paper".split()) for _ in range(200)) + ".", "en", "s", 0) for i in range(40)]
    junk = [(100 + i, " ".join("ab" + rng.choice(["###", "$$$", "%%%&&"]) + str(rng.random()) for _ in range(200)), "en", "s", 0) for i in range(3)]
    kept = {r[0] for r in quality.keep_good(spark.createDataFrame(good + junk, SCHEMA)).select("doc_id").collect()}
    assert kept == set(range(40))


def test_quality_needs_no_labels(spark):
    """Without labels as many documents are rejected as with them, within a tenth, and nearly the same ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = lambda df: {r[0] for r in quality.keep_good(df).select("doc_id").collect()}
    ids = {r[0] for r in docs.select("doc_id").collect()}
    with_, without = ids - kept(docs), ids - kept(docs.withColumn("lang", quality.F.lit(None).cast("string")))
    base = {r[0] for r in quality.judge(docs).where("__q.base_failed").select("doc_id").collect()}
    assert len(with_ - base) > 10 and abs(len(without) - len(with_)) <= 0.1 * len(with_) and len(with_ ^ without) <= 0.1 * len(with_)


def test_jensen_shannon(spark):
    p, q = np.array([3, 0, 5, 2]) / 10, np.array([0.25, 0.25, 0.4, 0.1])
    m = (p + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x)
    got = spark.range(1).selectExpr("array(3L, 0L, 5L, 2L) AS c").select(quality.jensen_shannon(quality.F.col("c"), q.tolist())).first()[0]
    assert abs(got - np.sqrt((kl(p) + kl(q)) / 2)) < 1e-12


# --- 2: language ---


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in langid.new_weights(3, 4, 1).items()}
    data, label = rng.integers(0, 256, (7, 5)), np.array([0, 1, 2, 1, 0])
    real = (np.arange(7)[:, None] < np.array([7, 7, 4, 6, 2])).astype(np.float32)
    weight = np.ones(5, np.float32)
    _, g = langid.gradients(w, data, real, label, weight)
    for key, at in (("uf", (1, 2)), ("ub", (0, 9)), ("out", (3, 1)), ("xf", (int(data[0, 0]), 5)), ("xb", (int(data[3, 1]), 0)), ("bias", (2,))):
        losses = []
        for step in (1e-2, -1e-2):
            moved = {k: v.copy() for k, v in w.items()}
            moved[key][at] += step
            losses.append(langid.gradients(moved, data, real, label, weight)[0])
        assert abs((losses[0] - losses[1]) / 2e-2 - g[key][at]) < 2e-3


def test_language(spark, odd, empty):
    rng = random.Random(5)
    make = {"aa": "tion ing the stre ou", "bb": "eux ché la oué ç", "cc": "über ung ä sch keit"}
    rows = [(i, " ".join(rng.choice(make[lang].split()) for _ in range(60)), lang, "s", 0) for i in range(90) for lang in [list(make)[i % 3]]]
    network = langid.fit(spark.createDataFrame(rows[:60], SCHEMA), rounds=60)
    out = langid.predict(spark.createDataFrame(rows[60:], SCHEMA), network).collect()
    assert sum(r["lang_pred"] == rows[r["doc_id"]][2] for r in out) >= 28
    assert all(0 <= r["score"] <= 1 for r in out)
    some = langid.predict(odd, network)
    assert some.count() == len(awkward())
    assert {r["lang_pred"] for r in langid.predict(spark.createDataFrame([(1, None, None, None, 0), (2, " 12 !", None, None, 0)], SCHEMA), network).collect()} == {"und"}
    assert langid.fit(empty).languages == [] and langid.predict(odd, langid.fit(empty)).where("lang_pred <> 'und'").count() == 0
    assert langid.predict(empty, network).collect() == []


# --- 3: sharding ---


def test_sharding(spark, odd, empty):
    rows = frame(spark, [(i, "t" * (i % 50), "en", "s", 0) for i in range(1003)] + awkward()).repartition(7)
    out = sharding.assign_shards(rows, shards=24).collect()
    counts = Counter(r["shard"] for r in out)
    assert len(out) == 1003 + len(awkward()) and set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(counts[s]))
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r["doc_id"], len((r["text"] or "").encode()) + 8) for r in rows.collect())
    assert {r["text_crc32"] for r in out} == {zlib.crc32((r["text"] or "").encode()) for r in rows.collect()}
    assert sharding.assign_shards(empty).collect() == []
    unique = frame(spark, [(i, str(i), "en", "s", 0) for i in range(100)])
    moved = sharding.exchange(unique, sharding.assign_shards(unique, shards=3))
    assert moved.count() == 100 and {r[0] for r in moved.select("shard").collect()} == {0, 1, 2}
    moved = sharding.exchange(odd, sharding.assign_shards(odd, shards=3))  # null and repeated ids keep their rows
    assert Counter((r["doc_id"], r["text"]) for r in moved.collect()) == Counter((r["doc_id"], r["text"]) for r in odd.collect())
    assert len({(r["shard"], r["slot"]) for r in moved.collect()}) == len(awkward()) and moved.columns[-2:] == ["shard", "slot"]


def test_communication_matrix():
    m = np.array(sharding.communication_matrix([5, 0, 1000, 37], 7, 1))
    assert m.sum(axis=1).tolist() == [5, 0, 1000, 37] and m.sum(axis=0).max() - m.sum(axis=0).min() <= 1 and m.min() >= 0
    rng = np.random.default_rng(2)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(draws) - 6) < 0.15 and abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.4
    assert 0 <= sharding.hypergeometric(rng, 10**10, 3 * 10**11, 10**9) <= 10**9


# --- 4: syncmers ---


def test_syncmers(spark, odd, empty):
    fps = syncmers.fingerprint(odd).collect()
    by_text = {}
    for r in fps:
        assert by_text.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"] and len(r["fingerprint"]) % 8 == 0
    assert by_text[""] == "" and len(fps) == len(awkward())
    assert syncmers.fingerprint(empty).collect() == []
    rng = random.Random(4)
    a, b = sentence(rng, 100), sentence(rng, 5)
    pair = spark.createDataFrame([(1, a), (2, b + " " + a), (3, sentence(rng, 100))], "doc_id bigint, text string")
    x, y, z = (r["anchors"] for r in syncmers.fingerprint(pair).orderBy("doc_id").collect())
    assert set(x) <= set(y) and not set(x) & set(z)
    k, s = 6, 2
    words = [spark.range(1).selectExpr(f"xxhash64('{w}')").first()[0] for w in a.split()]
    inner = {i: None for i in range(len(words) - s + 1)}
    hashed = spark.createDataFrame([(i, words[i : i + s]) for i in inner], "i int, w array<bigint>").selectExpr("i", "xxhash64(w[0], w[1])").collect()
    inner = dict(map(tuple, hashed))
    chosen = [i for i in range(len(words) - k + 1) if min(inner[j] for j in range(i, i + k - s + 1)) in (inner[i], inner[i + k - s])]
    assert len(x) == len(chosen)


def test_next_document(spark, odd):
    rows = [(i * 2, f"text {i} " * (i % 5 + 1)) for i in range(57)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    out = {r["doc_id"]: r["next"]["text"] for r in syncmers.with_next(df, ["text"], "doc_id", 9).collect()}
    assert out == {i: rows[(k + 1) % 57][1] for k, (i, _) in enumerate(rows)}
    assert syncmers.with_next(odd.select("doc_id", "text"), ["text"], "doc_id", 4).count() == len(awkward())
    one = df.where("doc_id = 4")
    assert syncmers.with_next(one, ["text"], "doc_id", 4).first()["next"]["text"] == rows[2][1]
    assert syncmers.with_next(df.where("false"), ["text"], "doc_id", 4).collect() == []


def test_likeness(spark):
    df = spark.sql("SELECT array(1, 2, -3) AS a, array(1, 2, 4) AS b, cast(array() AS array<int>) AS c")
    like = [df.select(syncmers.likeness(syncmers.F.col(p), syncmers.F.col(q))).first()[0] for p, q in (("a", "b"), ("c", "c"), ("a", "c"), ("a", "a"))]
    assert like == [4 / 6, 1.0, 0.0, 1.0]


# --- 5: byte-level BPE ---


def test_byte_bpe(spark, odd, written, empty):
    own = bytebpe.encoding()
    want = sorted(((r["doc_id"], np.array(own.encode_ordinary(r["text"] or ""), "<u4").tobytes()) for r in odd.collect()), key=repr)
    for df, plain in ((odd, False), (written, True)):
        got = sorted(((r["doc_id"], bytes(r["ids"])) for r in bytebpe.encode(df, chunk_chars=500, written=plain).collect()), key=repr)
        assert got == want
    assert [bytebpe.decode(ids) for _, ids in got] == [bytebpe.decode(ids) for _, ids in want]
    texts = Counter((r["text"] or "").encode() for r in odd.collect())
    assert Counter(bytebpe.decode(ids) for _, ids in got) == texts
    assert bytebpe.encode(empty).collect() == []


# --- 6: personal data ---


def test_base_spans():
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True), (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub("[^0-9]", "", s)) <= 19 and pii.luhn(re.sub("[^0-9]", "", s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
    ]
    rng = random.Random(6)
    for _ in range(8000):
        text = "".join(rng.choice("@@..aZ0019-+ ()%é25") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == [(k, m.start(), m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m[0])]
    assert pii.base_spans("1" * 200_000 + "a@" * 50_000) == []


def test_bootstrapping(spark, empty):
    seeds = [(i, f"reach me under bob{i}@example.com or wait", "en", "s", 0) for i in range(12)]
    hidden = [(50, "reach me under qx7Kd92mPz tomorrow", "en", "s", 0), (51, "the model qx9Td92mPz sells well", "en", "s", 0), (52, "the badge qx7Kd92mPz and the badge zz8Rt61pQw", "en", "s", 0)]
    out = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame(seeds + hidden, SCHEMA)).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in out[50]["added"]] == [(4, 15, 25)] and out[51]["added"] == []
    assert len(out[52]["added"]) >= 1 and out[3]["base"][0]["start"] == 15
    clean = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame(seeds + hidden, SCHEMA)).collect()}
    assert clean[50] == "reach me under [ID] tomorrow" and clean[3] == "reach me under [EMAIL] or wait" and clean[51] == hidden[1][1]
    assert pii.find_pii(empty).collect() == [] and pii.redact(empty).columns == empty.columns


def test_pii_awkward(spark, odd):
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == len(awkward()) and untouched(out)
    assert "mail [EMAIL] or [IP], card [CARD], tel [PHONE]" in {r["text"] for r in out.collect()}


# --- 7, 8: packing, token files ---


def ids_of(text):
    t = ids_of.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_packing(spark, odd, empty):
    out = packing.pack(odd, capacity=64).collect()
    want = Counter((r["doc_id"], k, a, len(x[a : a + 64]), zlib.crc32(x[a : a + 64].tobytes())) for r in odd.collect() for x in [ids_of(r["text"])] for k, a in enumerate(range(0, len(x), 64)))
    assert Counter(tuple(r)[:5] for r in out) == want
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(empty).collect() == []


def test_minimum_bin_slack():
    def best(items, room):
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums if s + x <= room}
        return max(sums)

    rng = random.Random(7)
    for _ in range(200):
        counts = Counter(rng.randrange(1, 40) for _ in range(rng.randrange(1, 15)))
        room = rng.randrange(1, 120)
        taken = packing.fullest(dict(counts), room)
        assert all(counts[x] >= n for x, n in taken.items()) and sum(x * n for x, n in taken.items()) == best(counts.elements(), room)
    many = Counter(rng.randrange(1, 4097) for _ in range(20_000))
    packed = packing.minimum_bin_slack(dict(many), 4096)
    assert sum(n for _, n in packed) <= sum(x * n for x, n in many.items()) / 4096 * 1.01 + 1
    total = Counter()
    for b, n in packed:
        for x, k in b.items():
            total[x] += k * n
    assert total == many


def test_token_files(spark, odd, empty):
    for block in (50, 65_536):
        got = rows_of(tokenfile.read_files(tokenfile.write_files(odd, files=4, block=block)))
        assert Counter((r[0], r[2], r[3]) for r in got) == Counter((r["doc_id"], len(x), zlib.crc32(x.tobytes())) for r in odd.collect() for x in [ids_of(r["text"])])
        at = 0
        for doc_id, start, n, _ in sorted(got, key=lambda r: r[1]):
            assert start == at
            at += n
        ordered = [r[0] for r in sorted(got, key=lambda r: r[1])]
        assert ordered == sorted(ordered, key=lambda i: -1 if i is None else i)
    assert tokenfile.read_files(tokenfile.write_files(empty)).collect() == []


def test_simple8b():
    rng = random.Random(8)
    for values in ([], [0], [2**64 - 1, 0, 1], [2**60] * 3 + [1] * 70, [rng.getrandbits(rng.randrange(1, 65)) for _ in range(5000)], [7] * 61):
        x = np.array(values, np.uint64)
        assert tokenfile.unpack(tokenfile.pack(x)).tolist() == values


# --- 9: near-duplicates ---


def test_simhash(spark, odd, empty):
    rng = random.Random(9)
    rows = awkward()
    for i in range(40):
        words = sentence(rng, 80).split()
        for j in range(3):
            rows.append((1000 + 10 * i + j, " ".join(words), "en", "s", 0))
            words[rng.randrange(80)] = "changed"
    df = frame(spark, rows)
    got = simhash.near_duplicates(df).collect()
    fps = {}
    for _, text, *_ in rows:
        low = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        shingles = [" ".join(low[k : k + 4]) for k in range(len(low) - 3)] or ([" ".join(low)] if low else [])
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        fps[text] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
    label = {f: f for f in fps.values()}
    changed = True
    while changed:
        changed = False
        for f in label:
            low = min(label[g] for g in label if (f ^ g).bit_count() <= 4)
            changed |= low < label[f]
            label[f] = low
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            key = label[fps[text]]
            smallest[key] = min(doc_id, smallest.get(key, doc_id))
    want = Counter((r[0], fps[r[1]], smallest.get(label[fps[r[1]]])) for r in rows)
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(empty).collect() == []
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and 40 <= kept.count() < len(rows) and untouched(kept)


def test_every_pair_meets():
    rng = np.random.default_rng(10)
    for bits in (4, 5, 6, 7):
        a = rng.integers(0, 2**63, 300, dtype=np.uint64)
        b = a.copy()
        for i in range(len(b)):
            for at in rng.choice(64, rng.integers(0, bits + 1), replace=False):
                b[i] ^= np.uint64(1) << np.uint64(at)
        anchor, fp, home = simhash.anchor_rows(np.concatenate([a, b]), bits)
        homes, visits = {}, {}
        for x, f, h in zip(anchor.tolist(), fp.tolist(), home.tolist(), strict=True):
            visits.setdefault(f, set()).add(x)
            if h:
                homes.setdefault(f, set()).add(x)
        assert all(homes[x] & visits[y] for x, y in zip(a.tolist(), b.tolist(), strict=True))


def test_large_anchor_groups():
    rng = np.random.default_rng(11)
    center = rng.integers(0, 2**63, 3, dtype=np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)) for c in center]))
    found = simhash.links_of(fps, np.ones(len(fps), bool), 4)
    assert sum(len(a) for a, _ in found) == len(fps) - 3


def test_components(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(200, 210), (210, 205), (300, 300)]
    out = dict(map(tuple, simhash.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    assert out == {**dict.fromkeys(range(61), 0), **dict.fromkeys((200, 205, 210), 200)}
    hubs = pairs + [(500, 500 + i) for i in range(1, 9)] + [(507, 400)]
    out = dict(map(tuple, simhash.components(spark.createDataFrame(hubs, "a bigint, b bigint"), hub=2).collect()))
    assert out == {**dict.fromkeys(range(61), 0), **dict.fromkeys((200, 205, 210), 200), **dict.fromkeys((400, *range(500, 509)), 400)}


# --- 10: repeated passages ---


def brute_cut(rows, length=100):
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(data, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowd", [4096, 3])
def test_repeats(spark, crowd, empty):
    rng = random.Random(12)
    common = "one line of some ninety bytes that is common to very many documents, but shorter than 100"
    shared = [sentence(rng, 40) for _ in range(6)]
    rows = [(i, rng.choice([None, "", sentence(rng, 5)]) if i % 9 == 0 else " ".join(rng.choice([common, rng.choice(shared), sentence(rng, rng.randrange(30))]) for _ in range(rng.randrange(1, 7)))) for i in range(120)]
    rows += [(200, "ab" * 300), (201, "x" + "ab" * 60), (202, "é" * 400), (203, rows[10][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'c' AS chunk", "1 AS n_removed").repartition(4)
    out = suffixes.remove_repeats(df, chunk_bytes=3000, crowd=crowd)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in out.collect()), key=repr)
    assert got == brute_cut(rows)
    assert "chunk" in out.columns
    assert suffixes.remove_repeats(empty).collect() == []


def test_repeats_awkward(spark, odd):
    out = suffixes.drop_repeats(odd)
    assert out.columns == odd.columns and out.count() == len(awkward()) and untouched(out)
    assert sum(r["text"] is None for r in out.collect()) == 1
