"""Quality rules by distribution divergence (native).

A document's histograms of character classes and of common words are compared, by Jensen-Shannon distance, with each
language's own histograms, the means of those of all its documents (each counts alike, so a few long ones don't rule). A
document's language is its label or, where that is none of the known ones, the language whose common words it has most of,
if those are a tenth of its words; so references need no labels. A document is kept if it is near enough to some language
in both: in character classes by a fixed limit, in words by a share of the distance at which a text without any common word
stands from that language's own reference. Short documents, whose histograms say little, pass the comparison they are
too short for. Everything is one projection of built-in functions and one small aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, materialize

#: Common words by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "as", "with", "was", "on", "by", "be", "are"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "sur"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su"],
}

#: Character classes in the order they are taken out of the text; what is left is the last class, "other".
CLASSES = [("letter", r"\p{L}+"), ("space", SPACE), ("digit", r"\p{N}+"), ("stop", r"[.,;:!?'\"()-]+"), ("symbol", r"[#*$%&|<>]+")]

#: Words of a window, a power of two.
WINDOW = 8

#: A text of any language without one common word is at about 0.33 from that language's words. The spread of clean
#: documents (sf0.1, quality 1, 60 words or more) ends at 0.90 of that distance.
BARE_SHARE = 0.92


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a window of 8 words that the text has twice or more, first one included. Windows
    are compared by 64-bit hashes. Linear but for texts with a repeat, whose windows are sorted."""

    def covered(hashes: Column) -> Column:
        sorted_ = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(sorted_, lambda s: F.filter(s, lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"])))
        places = F.sort_array(F.transform(twice, lambda e: e["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def windows(hashed: Column) -> Column:
        """Hashes of 2, of 4, of 8 words from each place on, each from two of the ones before."""

        def doubled(some: Column, reach: int) -> Column:
            both = F.transform(some, lambda h, i: F.xxhash64(h, F.get(some, i + reach)))
            return F.slice(both, F.lit(1), F.size(hashed) - (WINDOW - 1)) if 2 * reach == WINDOW else let(both, lambda x: doubled(x, 2 * reach))

        return doubled(hashed, 1)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    found = let(let(hashed, windows), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(words) > WINDOW, found).otherwise(F.lit(0)).cast("long")


def _vocabulary() -> list[str]:
    return list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))


def features(docs: DataFrame, text_col: str = "text", any_case: bool = True) -> DataFrame:
    """docs with the struct __q: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes and common
    (arrays of counts). The text is read whole; null counts as empty. Common words count however they are written, or
    only in lower case and with a capital first letter without any_case."""
    vocabulary = _vocabulary()
    marks = [chr(0x4E00 + i) for i in range(len(vocabulary))]
    spelled = [x for w, m in zip(vocabulary, marks, strict=True) for s in (w, w.capitalize()) for x in (F.lit(s), F.lit(m))]
    either = [s for w in vocabulary for s in (w, w.capitalize())]
    df = docs.withColumn("__t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumn("__words", F.filter(F.split("__t", SPACE), lambda w: w != ""))
    df = df.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    left, before = [], "__t"
    for name, pattern in CLASSES:
        df = df.withColumn(f"__no_{name}", F.regexp_replace(before, pattern, ""))
        left.append(before := f"__no_{name}")
    sizes = [F.length("__t"), *[F.length(x) for x in left]]
    classes = [(a - b).cast("long") for a, b in zip(sizes, sizes[1:], strict=False)] + [sizes[-1].cast("long")]
    spelling = F.lower if any_case else (lambda w: w)
    common = F.transform(F.filter("__words", lambda w: spelling(w).isin(either)), lambda w: F.element_at(F.create_map(*spelled), spelling(w)))
    df = df.withColumn("__common", F.concat_ws("", common))
    n_common = F.length("__common")
    counts = [(n_common - F.length(F.replace(F.col("__common"), F.lit(m), F.lit("")))).cast("long") for m in marks]
    n_words = F.size("__words").cast("long")
    q = F.struct(
        n_words.alias("n_words"),
        (F.length("__t") - classes[1]).cast("long").alias("word_chars"),
        classes[4].alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words")).alias("n_repeat_words"),
        F.array(*classes).alias("classes"),
        F.array(*counts, (n_words - n_common).cast("long")).alias("common"),
    )
    return df.select(*docs.columns, q.alias("__q"))


def _failed(q: Column) -> Column:
    return (q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])


def language(q: Column, label: Column) -> Column:
    """The label if it is a language of COMMON_WORDS, else the one whose common words are most of the text's (the first of
    equal ones), null if they are fewer than a tenth of its words."""
    vocabulary = _vocabulary()
    counts = [(lang, sum((F.get(q["common"], F.lit(vocabulary.index(w))) for w in words), F.lit(0).cast("long"))) for lang, words in COMMON_WORDS.items()]

    def guess(best: Column) -> Column:
        first = F.coalesce(*[F.when(n == best, F.lit(lang)) for lang, n in counts])
        return F.when(10 * best >= q["n_words"], first)

    return F.when(label.isin(list(COMMON_WORDS)), label).otherwise(let(F.greatest(*[n for _, n in counts]), guess))


def references(scored: DataFrame, lang_col: str, min_words: int) -> dict[str, tuple[list[float], list[float]]]:
    """Per language of COMMON_WORDS its two histograms as shares: at most one row a language reaches the driver."""
    q = F.col("__q")
    n_common = len(_vocabulary()) + 1
    use = scored.where(~_failed(q) & (q["n_words"] >= min_words)).withColumn("__lang", language(q, F.col(lang_col))).where("__lang IS NOT NULL")
    total = {"classes": F.aggregate(q["classes"], F.lit(0).cast("long"), lambda s, x: s + x), "common": q["n_words"]}
    use = use.withColumns({f"__{part}": n for part, n in total.items()})
    sums = [F.sum(F.get(q[part], F.lit(i)) / F.col(f"__{part}")).alias(f"{part}{i}") for part, n in (("classes", len(CLASSES) + 1), ("common", n_common)) for i in range(n)]
    share = lambda xs: [x / (sum(xs) or 1) for x in xs]
    rows = [list(r) for r in use.groupBy(F.col("__lang").alias("lang")).agg(*sums).orderBy("lang").collect()]
    return {r[0]: (share(r[1 : len(CLASSES) + 2]), share(r[len(CLASSES) + 2 :])) for r in rows}


def jensen_shannon(counts: Column, reference: list[float]) -> Column:
    """Distance (root of the divergence to base 2, 0 to 1) between an array of counts and fixed shares; 1 if no counts."""

    def part(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0)) + F.when(b > 0, b * F.log2(b / m)).otherwise(F.lit(0.0))

    def distance(total: Column) -> Column:
        terms = F.zip_with(counts, F.lit(reference), lambda c, r: let(F.struct((c / total).alias("a"), r.alias("b")), lambda x: part(x["a"], x["b"])))
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))

    total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)
    return let(total, lambda n: F.when(n > 0, distance(n)).otherwise(F.lit(1.0)))


def bare_distance(common: list[float]) -> float:
    """Distance from a language's shares of common words to a text that has none of them."""
    rest = common[-1]
    terms = 1 - rest + math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest > 0 else 0)
    return math.sqrt(max(0.0, terms / 2))


def judge(
    docs: DataFrame, max_class: float = 0.30, min_chars: int = 200, min_words: int = 60,
    lang_col: str = "lang", text_col: str = "text", carry: list[str] | None = None, any_case: bool = True, bare_share: float = BARE_SHARE,
) -> DataFrame:
    """The columns `carry` of docs (all by default) and the struct __q, now with class_distance, word_distance (to the
    nearest language; null without references), base_failed and kept.

    kept: not base_failed, and class_distance <= max_class or fewer than min_chars characters, and word distance to some
    language at most bare_share of what a text without common words has to it, or fewer than min_words words, or a label that is
    no language of COMMON_WORDS (nothing is known of that language's words). A null text counts as empty and fails. Rows are
    judged one by one, so repeated rows and ids get equal verdicts. Without any reference (no document of a known
    language that is long enough), only the base rules decide. An empty table gives an empty result. Columns of docs that begin with two underscores are
    reserved.
    """
    keep = docs.columns if carry is None else carry
    need = list(dict.fromkeys([*keep, lang_col]))
    inputs = docs.select(*need, F.col(text_col).alias("__text"))
    scored = materialize(features(inputs, "__text", any_case).drop("__text"), "quality")
    known = references(scored, lang_col, min_words)
    q = F.col("__q")

    def distances(part: str, k: int) -> Column:
        each = [jensen_shannon(q[part], r[k]) for r in known.values()]
        return F.array(*each) if each else F.lit(None).cast("array<double>")

    # each distance is worked out once, though several conditions read it
    out = scored.withColumns({"__c": distances("classes", 0), "__w": distances("common", 1)})
    out = out.withColumn("__d", F.struct(F.array_min("__c").alias("c"), F.array_min("__w").alias("w")))
    close = F.coalesce((F.col("__d")["c"] <= max_class) | (q["word_chars"] < min_chars), F.lit(True))
    if known:
        able = F.lit(False)
        for i, r in enumerate(known.values()):
            bare = bare_distance(r[1])
            able |= (F.get("__w", F.lit(i)) <= bare_share * bare) if bare > 0 else F.lit(True)
        other = F.coalesce(~F.col(lang_col).isin(list(COMMON_WORDS)), F.lit(False))
        close &= able | (q["n_words"] < min_words) | other
    full = F.struct(
        *[q[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__d")["c"].alias("class_distance"), F.col("__d")["w"].alias("word_distance"),
        _failed(q).alias("base_failed"), (~_failed(q) & close).alias("kept"),
    )
    return out.select(*keep, full.alias("__q"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that judge() keeps, with the columns of docs."""
    return judge(docs, **options).where("__q.kept").drop("__q")


def op1_distribution_divergence(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"]).select("doc_id", "__q.*").withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})
