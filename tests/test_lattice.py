"""Segmentation by a lattice, against every cut of short runs."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loomtext.operators import lattice
from loomtext.options import Options
from loomtext.plans import extract as extraction
from loomtext.plans import queries
from loomtext.tokenize import segment


def all_cuts(run):
    for marks in itertools.product((False, True), repeat=len(run) - 1):
        at = [0, *(i + 1 for i, m in enumerate(marks) if m), len(run)]
        yield [run[a:z] for a, z in itertools.pairwise(at)]


def script(c):
    return next((i for i, (a, z) in enumerate(lattice.WHOLE) if a <= ord(c) <= z), None)


def cost(lexicon, run, cut):
    known, total, at = dict(zip(lexicon.pieces, lexicon.costs, strict=True)), 0.0, 0
    heads, place = {}, 0
    for s, g in itertools.groupby(run, key=script):
        n = len(list(g))
        if s is not None and n > 1:
            heads[place] = n
        place += n
    for w in cut:
        options = [known[w]] if w in known else [-lexicon.unknown] if len(w) == 1 else []
        if heads.get(at) == len(w):
            options.append(-lexicon.unknown * (1 + 0.5 * (len(w) - 1)))
        if not options:
            return math.inf
        total, at = total + min(options), at + len(w)
    return total


RUNS = ["ab", "a", "abcabd", "bbbbbbb", "zzabz", "cabcabca", "カタカナ語", "あいabカ", "한국어말", "ばナナが好き", "x" * 9]


@pytest.fixture(scope="module")
def lexicon():
    return lattice.Lexicon(["a", "b", "c", "ab", "abc", "bb", "bbb", "cab", "が", "ナナ", "好き", "国"], [3.0, 2.5, 4.0, 4.1, 5.0, 4.5, 7.2, 6.1, 2.0, 8.0, 3.0, 5.0])


def test_cheapest_cut_of_all(lexicon):
    for run, cut in zip(RUNS, lexicon.cut(RUNS), strict=True):
        assert "".join(cut) == run
        assert cost(lexicon, run, cut) == pytest.approx(min(cost(lexicon, run, c) for c in all_cuts(run)))


def test_expected_counts_of_all_cuts(lexicon):
    runs = [r for r in RUNS if not any(script(c) is not None for c in r)]
    weights = np.arange(1.0, len(runs) + 1)
    got, likelihood = lattice.marginals(lexicon.lattice(runs), weights, len(lexicon.pieces))
    want, total = Counter(), 0.0
    for run, w in zip(runs, weights, strict=True):
        ways = [(c, math.exp(-cost(lexicon, run, c))) for c in all_cuts(run) if cost(lexicon, run, c) < math.inf]
        z = sum(p for _, p in ways)
        total += w * math.log(z)
        for c, p in ways:
            for piece in c:
                want[piece] += w * p / z
    assert np.allclose(got, [want[p] for p in lexicon.pieces]) and likelihood == pytest.approx(total)


def test_marginals_with_runs_of_one_script(lexicon):
    runs = ["ナナナ", "ばナナが", "カタ国カタ"]
    got, likelihood = lattice.marginals(lexicon.lattice(runs), np.ones(3), len(lexicon.pieces))
    known = dict(zip(lexicon.pieces, lexicon.costs, strict=True))

    def ways(run, at=0):  # (pieces, weight): edges as they are defined, one by one
        if at == len(run):
            yield (), 1.0
            return
        edges = [(p, math.exp(-c)) for p, c in known.items() if run.startswith(p, at)]
        if run[at] not in known:
            edges.append((run[at], math.exp(lexicon.unknown)))
        s = script(run[at])
        if s is not None and (at == 0 or script(run[at - 1]) != s):
            end = next((k for k in range(at, len(run)) if script(run[k]) != s), len(run))
            if end - at > 1:
                edges.append((("run", run[at:end]), math.exp(lexicon.unknown * (1 + 0.5 * (end - at - 1)))))
        for piece, p in edges:
            size = len(piece[1]) if isinstance(piece, tuple) else len(piece)
            for more, q in ways(run, at + size):
                yield (piece, *more), p * q

    want, total = Counter(), 0.0
    for run in runs:
        found = list(ways(run))
        z = sum(p for _, p in found)
        total += math.log(z)
        for pieces, p in found:
            for piece in pieces:
                want[piece] += p / z
    assert np.allclose(got, [want[p] for p in lexicon.pieces]) and likelihood == pytest.approx(total)


def test_trie_finds_what_a_dictionary_finds():
    rng = random.Random(4)
    keys = sorted({tuple(rng.randrange(1, 40) for _ in range(rng.randrange(1, 6))) for _ in range(4000)} | {(k,) for k in range(500, 900)})
    trie, number = lattice.DoubleArray(keys), {k: i for i, k in enumerate(keys)}
    labels = np.array([rng.choice([0, rng.randrange(1, 40), rng.randrange(480, 950)]) for _ in range(3000)])
    ends = np.repeat(np.arange(30, 3001, 30), 30)
    got = trie.walk(labels, ends, 5)
    for i in range(3000):
        for d in range(5):
            assert got[d, i] == (number.get(tuple(labels[i : i + d + 1].tolist()), -1) if i + d < ends[i] else -1)


def test_candidates_and_learning(spark):
    rng = random.Random(1)
    words = ["river", "stone", "garden", "of", "the", "window", "letter"]
    lines = ["".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) for _ in range(400)] + ["river", "", None]
    texts = spark.createDataFrame([(x,) for x in lines], "text string")
    runs = texts.selectExpr("text AS run").where("run <> ''").groupBy("run").count().withColumnRenamed("count", "n")
    got = {r["piece"]: r["n"] for r in lattice.candidates(runs, 4, 5, 10**6).collect()}
    want = Counter(x[i : i + k] for x in lines if x for k in range(1, 5) for i in range(len(x) - k + 1))
    assert got == {p: n for p, n in want.items() if n >= 5 or len(p) == 1}
    lexicon = lattice.learn(texts, pattern="[a-z]+", longest=6, least=5, most=2000, rounds=6)
    assert lexicon.cut(["riverofthegardenstone", "windowletter"]) == [["river", "of", "the", "garden", "stone"], ["window", "letter"]]
    again = lattice.Lexicon.read(lexicon.frame(spark))
    assert (again.pieces, again.costs) == (lexicon.pieces, lexicon.costs)


def test_nothing_to_learn(spark):
    lexicon = lattice.learn(spark.createDataFrame([(None,), ("",), ("abc",)], "text string"))
    assert lexicon.pieces == [] and lexicon.words(["カタカナと漢字 abc-d 12。", ""]) == [["カタカナ", "と", "漢", "字", "abc-d", "12", "。"], []]


@pytest.mark.parametrize("lang", ["ja", "zh", "ko"])
def test_languages_without_spaces_give_tokens_without_any_library(spark, lang):
    assert "".join(segment(lang, "東京 タワー\n한국어")) == "東京タワー한국어"
    pages = spark.createDataFrame([("1", "T", "0", "東京大学と東京タワー")], "id string, title string, ns string, text string")
    row = extraction.extract(pages, Options(lang=lang)).collect()[0]
    assert "".join(row["segment_text"]) == row["text"].strip()


def test_an_extraction_cuts_by_a_learned_lexicon(spark, tmp_path):
    rng = random.Random(2)
    words = ["東京", "大学", "研究", "日本語", "と", "は"]
    lines = [(str(i), f"T{i}", "0", "".join(rng.choice(words) for _ in range(8)) + "。") for i in range(300)]
    pages = spark.createDataFrame(lines, "id string, title string, ns string, text string")
    lattice.learn(pages, longest=4).frame(spark).write.parquet(f"{tmp_path}/lexicon")
    done = extraction.extract(pages, Options(lang="ja", lexicon=f"{tmp_path}/lexicon")).collect()
    assert {w for r in done for w in r["segment_text"]} == {*words, "。"}


def test_the_query_against_plain_loops(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["river", "stone", "gar-den", "of", "ÉTÉ"]) for _ in range(rng.randrange(3, 30))) + ".\nof stone 12" for _ in range(40)] + [None, "", "…"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_tokens"], r["tokens_md5"]) for r in queries.QUERIES["lattice_words"](spark, str(tmp_path)).collect()}
    joined = [re.sub(r"[ \t]+", "", (t or "").lower()) for t in texts]
    runs = Counter(r for t in joined for r in re.findall(r"[^\W\d_]+", t))
    most, least, longest = queries.LATTICE["most"], queries.LATTICE["least"], queries.LATTICE["longest"]
    count = Counter()
    for r, n in runs.items():
        for i in range(len(r)):
            for k in range(1, min(longest, len(r) - i) + 1):
                count[r[i : i + k]] += n
    ranked = sorted((p for p in count if len(p) == 1 or count[p] >= least), key=lambda p: (len(p) > 1, -count[p] * len(p), p))[:most]
    counts = {p: float(count[p]) for p in ranked}

    def costs(c):
        total = sum(max(x, 0.5) for x in c.values())
        return {p: round(math.log(total / max(x, 0.5)), 6) for p, x in c.items()}

    def sums(run, known, total):  # of all paths to each place, and from it
        ahead, behind = [1.0] + [0.0] * len(run), [0.0] * len(run) + [1.0]
        edges = [(i, i + k, run[i : i + k]) for i in range(len(run)) for k in range(1, longest + 1) if run[i : i + k] in known and i + k <= len(run)]
        for i, j, p in sorted(edges, key=lambda e: e[1]):
            ahead[j] += ahead[i] * math.exp(-known[p])
        for i, j, p in sorted(edges, key=lambda e: -e[0]):
            behind[i] += behind[j] * math.exp(-known[p])
        for i, j, p in edges:
            total[p] += runs[run] * ahead[i] * behind[j] * math.exp(-known[p]) / ahead[-1]

    for _ in range(queries.LATTICE["rounds"]):
        known, total = costs(counts), dict.fromkeys(counts, 0.0)
        for r in runs:
            sums(r, known, total)
        known = costs(total)
        other = lambda p: min(sum(known.get(w, math.inf) for w in c) for c in all_cuts(p) if len(c) > 1)  # noqa: B023, E731
        counts = {p: c for p, c in total.items() if len(p) == 1 or (c >= 1.0 and other(p) - known[p] >= 1.0)}
    known = costs(counts)
    for i, t in enumerate(joined):
        n = 0
        for r in re.findall(r"[^\W\d_]+", t):
            best = [(0.0, 0)] + [(math.inf, 0)] * len(r)
            for z in range(1, len(r) + 1):
                best[z] = min((best[a][0] + known[r[a:z]], best[a][1] + 1) for a in range(max(0, z - longest), z) if r[a:z] in known)
            n += best[-1][1]
        assert abs(got[i][0] - n) <= 1  # equal but for ties


def test_grid_and_plain_lattice_agree():
    """rows of places give what the steps over single runs give, also for runs that leave a double's range."""
    import numpy as np

    rng = random.Random(4)
    pieces = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 5))) for _ in range(60)} | set("abc"))
    lexicon = lattice.Lexicon(pieces, [rng.uniform(2, 9) for _ in pieces])
    runs = ["".join(rng.choice("abcde") for _ in range(n)) for n in (1, 2, 3, 9, 30, 31, 700)]
    x, weights = lexicon.lattice(runs), np.arange(1.0, 8.0)
    fast, fast_sum = lattice.Grid.of(x).marginals(weights, len(pieces))
    # the plain way is that of runs of one script

    class Plain(np.ndarray):
        def any(self, *a, **k):
            return True

    x.onward = x.onward.view(Plain)
    slow, slow_sum = lattice.marginals(x, weights, len(pieces))
    assert np.allclose(fast, slow, rtol=1e-9, atol=1e-12) and abs(fast_sum - slow_sum) < 1e-6


def test_substrings_are_counted():
    runs, weights = ["abab", "b", "aba"], [2, 5, 1]
    got = {(p, n) for b in lattice.substrings(runs, weights, 3) for p, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    want = {}
    for r, n in zip(runs, weights):
        for k in (1, 2, 3):
            for i in range(len(r) - k + 1):
                want[r[i : i + k]] = want.get(r[i : i + k], 0) + n
    assert got == set(want.items())


def random_lexicon(rng, letters="abcd", n=60):
    pieces = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(n)} | set(letters[:-1]))
    return lattice.Lexicon(pieces, [round(rng.uniform(2, 9), 6) for _ in pieces])


def test_the_table_and_the_plain_lattice_agree():
    """all states of a batch by one table, long runs in parts, sums scaled; before, each piece of each run by itself."""
    rng = random.Random(5)
    for n in (12, 60, 300):
        lexicon = random_lexicon(rng, n=n)
        runs = ["".join(rng.choice("abcde") for _ in range(k)) for k in (1, 1, 2, 3, 9, 30, 31, 31, 190, 200, 700, 2500)] + ["a" * 3000, "e" * 1500, "ab" * 400]
        weights = np.arange(1.0, len(runs) + 1)
        want = np.zeros(len(lexicon.pieces))
        for r, w in zip(runs, weights, strict=True):
            want += lattice.marginals(lexicon.lattice([r]), np.array([w]), len(lexicon.pieces))[0]
        codes, sizes = lattice.flat(runs)
        assert np.allclose(lexicon.expected(codes, sizes, weights), want, rtol=1e-9, atol=1e-9)
        counts, left = lexicon.table.expected(codes, sizes, weights)
        assert left == [] and np.allclose(counts[lexicon.table.state_of], want, rtol=1e-9, atol=1e-9)
        for run, cut, plain in zip(runs, lexicon.cut(runs), lexicon._cut(runs), strict=True):
            assert "".join(cut) == run
            known = dict(zip(lexicon.pieces, lexicon.costs, strict=True))
            price = lambda c: sum(known.get(w, -lexicon.unknown) for w in c)  # noqa: B023, E731
            assert all(w in known or len(w) == 1 for w in cut) and price(cut) == pytest.approx(price(plain), abs=1e-6)


def test_equal_cuts_are_equal_wherever_they_stand():
    """of equally cheap cuts, rounding chose one by what stood before it."""
    lexicon = lattice.Lexicon(["a", "ab", "abc", "b", "bc", "c", "x", "y"], [0.1, 0.3, 0.7, 0.2, 0.6, 0.4, 0.123457, 7.654321])
    for before in ("", "x", "xyxx", "y" * 50, "xy" * 300):
        assert lexicon.cut([before + "abc"])[0][-3:] == ["a", "b", "c"]


def test_lengths_of_a_column():
    import pyarrow as pa

    for runs in (["ab", "c", "", "def"], ["é", "ab", "漢字", "😀x", ""], [], ["", ""]):
        for column in (pa.array(runs, pa.string()), pa.array(["zé", *runs, "q"], pa.string()).slice(1, len(runs))):
            codes, sizes = lattice.flat_column(column)
            assert lattice.strings(codes.astype(np.uint32), sizes) == runs


@pytest.mark.parametrize("table", [1 << 22, 0])
@pytest.mark.parametrize("most", [30, 200, 10**6])
def test_candidates_are_the_best_of_all(spark, monkeypatch, table, most):
    """substrings that can't be chosen aren't counted; before, all were, of every batch."""
    rng = random.Random(6)
    words = ["river", "stone", "gärden", "of", "the", "漢字"]
    runs = Counter("".join(rng.choice(words) for _ in range(rng.randrange(1, 7))) for _ in range(150))
    df = spark.createDataFrame([*runs.items(), ("", 3)], "run string, n long")
    monkeypatch.setattr(lattice, "TABLE", table)
    monkeypatch.setattr(lattice, "SHORT", 2, raising=False)
    got = [(r["piece"], r["n"]) for r in lattice.candidates(df, 6, 5, most).collect()]
    count = Counter()
    for r, n in runs.items():
        for i in range(len(r)):
            for k in range(1, min(6, len(r) - i) + 1):
                count[r[i : i + k]] += n
    ranked = sorted((p for p in count if len(p) == 1 or count[p] >= 5), key=lambda p: (len(p) > 1, -count[p] * len(p), p))[:most]
    assert got == [(p, count[p]) for p in ranked]


def test_pieces_of_a_text(spark):
    lexicon = lattice.Lexicon(["a", "b", "ab", "é", "éa", "漢"], [2.0, 2.0, 2.5, 3.0, 4.5, 4.0])
    df = spark.createDataFrame([("ab éab-漢a",), (None,), ("",), ("12 . b",)], "text string").coalesce(1)
    got = [r["w"] for r in df.select(lattice.segmented(lexicon, pattern=r"[^\W\d_]+").alias("w")).collect()]
    assert got == [["ab", "é", "ab", "漢", "a"], [], [], ["b"]]
