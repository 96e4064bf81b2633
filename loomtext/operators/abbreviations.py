"""Abbreviations of a language, found in its texts: words that stand before a full stop far more often than others do.

For each word, Dunning's likelihood ratio weighs that it nearly always has a stop (99 of 100) against that it has one as
often as any word. Long words, and occurrences without a stop, speak against an abbreviation; stops inside speak for one.
Counts are one aggregation; nothing but two totals, and known words while they are few, goes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written

#: A word, with stops between its letters, and the stop behind it.
WORD = r"\p{L}+(?:\.\p{L}+)*\.?"
ALWAYS = 0.99
#: So many known abbreviations go with each task; more of them meet the words of the texts in a join.
TRAVEL = 10_000
#: Parts of the texts in that join.
PARTS = 32


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def scores(texts: DataFrame, text_col: str = "text", least: int = 1) -> DataFrame:
    """word (lower case), n, n_stop (occurrences, those before a stop) and score of the words that stand before a stop at all
    and occur `least` times at least. Null texts have no words; without any word there are no rows."""
    found = texts.select(F.explode(words(F.col(text_col))).alias("w"))
    each = found.groupBy("w").agg(F.count("*").alias("n"))  # forms are taken apart once each
    stops = F.when(F.col("w").endswith("."), F.col("n")).otherwise(F.lit(0))
    counts = written(each.groupBy(F.lower(F.regexp_replace("w", r"\.$", "")).alias("word")).agg(F.sum("n").alias("n"), F.sum(stops).alias("n_stop")), "words")
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_stop").alias("n_stop")).first()
    n, k = F.col("n"), F.col("n_stop")
    share = min(max((total["n_stop"] or 0) / (total["n"] or 1), 1e-9), 1 - 1e-9)
    likely = lambda p: k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    inner = F.length("word") - letters + 1
    score = 2 * (likely(ALWAYS) - likely(share)) * F.exp(-letters) * inner * F.pow(letters.cast("double"), -(n - k).cast("double"))
    return counts.where((k > 0) & (n >= least)).select("word", "n", "n_stop", score.alias("score"))


def abbreviations(texts: DataFrame, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """word and score of all abbreviations, however many there are."""
    return scores(texts, text_col).where(F.col("score") >= threshold).select("word", "score")


def few(known: DataFrame) -> list[str] | None:
    """All known words if they are few enough to go with each task, else nothing."""
    return [r["word"] for r in known.select("word").collect()] if known.count() <= TRAVEL else None


def with_known(texts: DataFrame, known: DataFrame, asked: Column, key: str) -> DataFrame:
    """texts and `known`: those of the words asked for (an array of each row) that are known, by a join. Rows of like key
    share what they know, which changes nothing, as a word is known everywhere or nowhere. Texts are dealt to parts, so that a
    word which all of them have is not met by one task."""
    part = F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")
    each = texts.select(F.col(key).alias("__key"), part.alias("part"), F.explode(F.array_distinct(asked)).alias("word"))
    dealt = known.select("word").distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    held = each.join(dealt, ["word", "part"]).groupBy("__key").agg(F.collect_set("word").alias("known"))
    return texts.join(held, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")


def tokenised(texts: DataFrame, known: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """texts and their tokens, `w`. known: a table with any number of words; key: a column that tells most rows apart."""
    text, some = F.col(text_col), few(known)
    if some is not None:
        return texts.withColumn("w", tokens(text, some))
    stopped = F.transform(F.filter(words(text), lambda w: w.endswith(".")), lambda w: F.lower(F.substring(w, F.lit(1), F.length(w) - 1)))
    return with_known(texts, known, stopped, key).withColumn("w", tokens(text, F.col("known"))).drop("known")


def tokens(text: Column, known: list[str] | Column) -> Column:
    """Words of a text, the stop behind a word apart but for known abbreviations: a list, or a row's own array or null."""

    def one(w: Column) -> Column:
        bare = F.substring(w, F.lit(1), F.length(w) - 1)
        low = F.lower(bare)
        there = low.isin(known) if isinstance(known, list) else F.coalesce(F.array_contains(known, low), F.lit(False))  # a list is a set of literals, looked up
        return F.when(w.endswith(".") & ~there, F.array(bare, F.lit("."))).otherwise(F.array(w))

    return F.flatten(F.transform(words(text), one))
