"""Fill-in-the-middle against a version that slices strings."""

import hashlib

import numpy as np
import pytest

from loomtext.llm import infill

from .helpers import CLASHING, awkward, frame, rows_of, untouched


def brute(key, text, seed=1):
    text = text or ""
    h = [int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in infill.MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def rows():
    out = awkward(3)
    odd = ["<P>", "a <S> b", "x<M>", "<", "<<<<>>", "<P", "S>", "😀" * 70, "é", "\x00\x00", "日本語" * 5000, "a" * 200_000 + "é" * 100_000, "\U0010ffff"]
    return out + [(1000 + i, t, None, None, None) for i, t in enumerate(odd * 4)] + [(2000 + i, "ab<c>é😀日" * (i % 9), None, None, None) for i in range(200)]


def test_forms_and_round_trip(spark):
    table = rows()
    out = infill.restored(infill.rearrange(frame(spark, table)))
    got = rows_of(out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"))
    assert got == sorted(((i, *brute(i, t), t or "") for i, t, *_ in table), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert untouched(out) and set(CLASHING) < set(out.columns)


def test_empty_and_other_settings(spark):
    assert infill.rearrange(frame(spark, [])).collect() == []
    table = [(i, f"text {i} of some words", None, None, None) for i in range(60)]
    done = infill.rearrange(frame(spark, table), seed=7, plain=0, spm=100, marks=("[1]", "(2)", "{3}"))
    assert {r["form"] for r in done.collect()} == {"spm"}
    assert {(r["text"]) for r in done.collect()} == {r["restored"] for r in infill.restored(done, marks=("[1]", "(2)", "{3}")).collect()}
    with pytest.raises(ValueError):
        infill.rearrange(frame(spark, table), marks=("aba", "b", "c"))


def test_rank_and_select():
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 511, 512, 513, 5000):
        data = rng.choice(np.array([0x41, 0x80, 0xC3], np.uint8), n)
        bits, starts = infill.Boundaries(data), np.flatnonzero((data & 0xC0) != 0x80)
        at = np.arange(n + 1)
        assert bits.rank(at).tolist() == np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]).tolist()
        assert bits.select(np.arange(len(starts) + 2), n).tolist() == [*starts.tolist(), n, n]
