"""Small inputs that every operator must take, and brute-force versions."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

WORDS = "the of and to in is that river stone garden window letter music winter travel simple number garden forest paper silver".split()


CLASHING = ("chunk", "bucket", "shard", "size", "fp", "length", "kind", "base", "added", "start", "file", "kept", "n_spans", "score", "node", "a")


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "s", "ly", "ed"])) + str(rng.randrange(40)) * (rng.random() < 0.2) for _ in range(n))


def awkward(seed: int = 1) -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows and ids, ties, copies, one long word, odd characters."""
    rng = random.Random(seed)
    base = [sentence(rng, n) for n in (3, 8, 40, 120, 300)]
    passage = "A passage that stands in several documents, long enough to be found by a window of one hundred bytes. It ends here."
    texts = [
        None, "", "   \n\t ", *base, base[3], base[3], base[4][:-9] + " altered", "x" * 3000, "é" * 150 + " ñ 日本語 😀 " * 30, passage + base[2], base[1] + passage, "a\n" + passage + "\nb",
        "mail bob@example.com or 10.0.0.1, card 4111 1111 1111 1111, tel +1 (514) 555-8389", "<|endoftext|> it's 12345", "line one here\nline one here\nline one here\n",
    ]
    rows = [(i * 3, t, ["en", "fr", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, base[2], None, None, None), (12, base[1], "en", "s", 1)]


def frame(spark, rows, extra: bool = True):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:  # columns whose names the operators use themselves
        df = df.selectExpr("*", *[f"'x' AS {name}" for name in CLASHING])
    return df


def untouched(df) -> bool:
    """The columns that only came along still have their values."""
    return df.select(*CLASHING).distinct().collect() == [("x",) * len(CLASHING)]


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def word_grams(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def exact_groups(texts: dict[int, str | None]) -> dict[int, int]:
    """Smallest id of each row's group under exact five-word Jaccard similarity of 0.8 or more: each set is compared
    with those that share one of its rarest grams, which no partner can do without."""
    rows = sorted(((word_grams(t), i) for i, t in texts.items()), key=lambda x: len(x[0]))
    seen = Counter(g for s in {s for s, _ in rows} for g in s)
    label, by_gram, sets = {i: i for i in texts}, defaultdict(list), {}
    pairs = []
    for s, i in rows:
        if s in sets:
            pairs.append((i, sets[s]))
            continue
        sets[s] = i
        met = set()
        for g in sorted(s, key=lambda g: (seen[g], g))[: len(s) - -(-4 * len(s) // 5) + 1]:
            met.update(by_gram[g])
            by_gram[g].append(s)
        pairs += [(i, sets[o]) for o in met if 5 * len(s & o) >= 4 * len(s | o)]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label
