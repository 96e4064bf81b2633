"""Template dictionaries of any size: what calls what, and pages that meet the bodies they reach, by rounds of joins.

Neither the dictionary nor the titles that pages call pass through the driver. Pages are dealt to blocks by a hash. The
templates that a block's pages reach are found by a fixpoint over the calls that can be read in the texts; their bodies meet
the block's pages in one task, entries first, so the task holds one block's entries and one page at a time. Names that are
only known when a call is expanded are asked for: pages that missed one go through another round with it, the others are done.

All joins are merge joins: the size of a compressed file says little about what a broadcast of it would take.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import removed, union, written

#: Blocks that one copy of a template's body serves in a join.
BLOCKS_A_COPY = 1000


def literal_calls(text: Column, namespace: str) -> Column:
    """Distinct full titles of the calls whose name stands literally in a text (parser functions left out). A name that
    is made by expansion isn't here, one that is never called may be."""
    names = F.regexp_extract_all(text, F.lit(r"(?<!\{)\{\{\s*(?:(?i:subst:|safesubst:)\s*)?(:?[^{}|:]+?)\s*(?=\||\}\})"), F.lit(1))
    first = lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s)))
    full = lambda s: F.when(s.startswith(":"), first(F.substring(s, F.lit(2), F.length(s)))).otherwise(F.concat(F.lit(f"{namespace}:"), first(s)))
    return F.array_distinct(F.transform(names, full))


def entries(templates: DataFrame, redirects: DataFrame) -> DataFrame:
    """title, body, dst: one row for each title that is defined (title, body) or redirects (src, dst)."""
    bodies = templates.toDF("title", "body")
    return bodies.join(redirects.toDF("title", "dst"), "title", "full_outer").select("title", "body", "dst")


def static_calls(held: DataFrame, namespace: str) -> DataFrame:
    """title and callee of entries: literal calls of bodies, and where redirects lead."""
    called = F.concat(literal_calls(F.coalesce("body", F.lit("")), namespace), F.when(F.col("dst").isNotNull(), F.array("dst")).otherwise(F.array().cast("array<string>")))
    return held.select("title", F.explode(F.array_distinct(called)).alias("callee"))


def reachable(starts: DataFrame, calls: DataFrame, salts: int = 1) -> DataFrame:
    """key and title: the starts (key, title), and every title that calls (title, callee) lead to from them; written.

    Semi-naive: a round follows only the calls of what the round before found first, and cycles end it as anything else
    that was seen does. A title that very many keys have is dealt to `salts` tasks."""
    salt = F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")
    parts = [written(starts.select("key", "title").distinct(), "reached")]
    while True:
        salted = parts[-1].withColumn("__salt", salt)
        edges = salted.select("title", "__salt").distinct().join(calls.hint("merge"), "title")
        step = salted.join(edges.hint("merge"), ["title", "__salt"]).select("key", F.col("callee").alias("title")).distinct()
        fresh = written(step.join(union(parts).hint("merge"), ["key", "title"], "left_anti"), "reached")
        if fresh.isEmpty():
            removed(fresh)
            return union(parts)
        parts.append(fresh)


def closure(calls: DataFrame) -> DataFrame:
    """title, callee and whether the title calls itself, at once or through others (`cyclic`): all that each title reaches.

    Titles are numbered once. A pair keeps its least number of calls. From all pairs up to k, those of exactly k go on with all
    pairs up to k, which gives the pairs up to 2k: rounds grow with the logarithm of the longest way, and the pairs that
    a round makes are nearly those that are new."""
    direct = written(calls.select("title", "callee").distinct(), "calls")
    names = written(direct.select("title").union(direct.select("callee")).distinct().withColumn("n", F.monotonically_increasing_id()), "names")
    numbered = direct.join(names.toDF("title", "a").hint("merge"), "title").join(names.toDF("callee", "b").hint("merge"), "callee")
    parts, far = [written(numbered.select("a", "b", F.lit(1).alias("far")), "reached")], 1
    removed(direct)
    while True:
        known = union(parts)
        onward = known.toDF("b", "c", "more").hint("merge")
        step = known.where(F.col("far") == far).join(onward, "b").groupBy("a", F.col("c").alias("b")).agg((F.min("more") + far).alias("far"))
        fresh = written(step.join(known.select("a", "b").hint("merge"), ["a", "b"], "left_anti"), "reached")
        if fresh.isEmpty():
            removed(fresh)
            break
        parts.append(fresh)
        far *= 2
    cyclic = known.where("a = b").select("a", F.lit(True).alias("cyclic"))
    callers = names.toDF("title", "a").join(cyclic.hint("merge"), "a", "left").withColumn("cyclic", F.coalesce("cyclic", F.lit(False)))
    both = known.select("a", "b").join(callers.hint("merge"), "a").join(names.toDF("callee", "b").hint("merge"), "b")
    return both.select("title", "callee", "cyclic")


class Held:
    """The entries of a block, by title: (body, redirect), both null where it is known that there is none. What is asked
    for and isn't known is kept in `missing`."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[str | None, str | None]] = {}
        self.missing: set[str] = set()

    def view(self, part: int) -> Mapping[str, str]:
        return View(self, part)


class View(Mapping):
    def __init__(self, held: Held, part: int) -> None:
        self.held, self.part = held, part

    def __getitem__(self, title: str) -> str:
        if title not in self.held.known:
            self.held.missing.add(title)
            raise KeyError(title)
        if (value := self.held.known[title][self.part]) is None:
            raise KeyError(title)
        return value

    def __contains__(self, title: object) -> bool:
        try:
            self[title]
        except KeyError:
            return False
        return True

    def __iter__(self) -> Iterator[str]:
        raise TypeError("titles are looked up, not listed")

    def __len__(self) -> int:
        return len(self.held.known)


def by_rounds(pages: DataFrame, held: DataFrame, namespace: str, expand: Callable[[Held], Callable[[str, str], dict]], outcome: str, blocks: int | None = None) -> DataFrame:
    """pages (title, text and others) with `outcome`, a struct of the given type: what expand(entries of the block) gives
    for a page's title and text. Written; runs its rounds when it is called.

    held: entries(). Pages need no key and may repeat; a null text counts as empty. blocks: into so many the pages are
    dealt, four for each shuffle partition by default; a block's reached entries must fit into a task's memory.
    """
    spark = pages.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = -(-blocks // BLOCKS_A_COPY)
    others = [c for c in pages.columns if c not in ("title", "text")]
    kind = pages.select(F.struct(*others).alias("p")).schema["p"].dataType.simpleString()
    pending = pages.withColumn("__block", F.pmod(F.xxhash64("title", "text"), F.lit(blocks)).cast("int"))
    calls = written(static_calls(held, namespace), "calls")
    called = pending.select(F.col("__block").alias("key"), F.explode(literal_calls(F.coalesce("text", F.lit("")), namespace)).alias("title"))
    needs, done, spent = reachable(called, calls, salts), [], [calls]
    outcome_type = pa_type(outcome)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = own = apply = None
        for b in batches:
            at, found, missing = [], [], []
            columns = (b.column(c).to_pylist() for c in ("__block", "__page", "title", "text", "dst"))
            for i, (k, page, title, text, dst) in enumerate(zip(*columns, strict=True)):
                if k != block:
                    block, own = k, Held()
                    apply = expand(own)
                if not page:
                    own.known[title] = (text, dst)
                    continue
                own.missing.clear()
                at.append(i)
                found.append(apply(title, text))
                missing.append(sorted(own.missing))
            if at:
                rows = b.take(pa.array(at))
                more = [pa.array(found, outcome_type), pa.array(missing, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("__block", "title", "text", "payload")), *more], ["__block", "title", "text", "payload", "outcome", "__missing"])

    while True:
        salt = F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")
        salted = needs.withColumn("__salt", salt)
        bodies = salted.select("title", "__salt").distinct().join(held.hint("merge"), "title", "left")
        loaded = salted.join(bodies.hint("merge"), ["title", "__salt"]).select(
            F.col("key").alias("__block"), F.lit(False).alias("__page"), "title", F.col("body").alias("text"), "dst", F.lit(None).cast(kind).alias("payload"),
        )
        rows = pending.select("__block", F.lit(True).alias("__page"), "title", "text", F.lit(None).cast("string").alias("dst"), F.struct(*others).alias("payload"))
        met = loaded.unionByName(rows).repartition("__block").sortWithinPartitions("__block", "__page")
        schema = f"__block int, title string, text string, payload {kind}, outcome {outcome}, __missing array<string>"
        now = written(met.mapInArrow(run, schema), "expanded")
        done.append(now.where(F.size("__missing") == 0).select("title", "text", "payload.*", "outcome"))
        left = now.where(F.size("__missing") > 0)
        more = left.select(F.col("__block").alias("key"), F.explode("__missing").alias("title"))
        if more.isEmpty():
            removed(needs, *spent)
            break
        asked, before = reachable(more, calls, salts), needs
        there = needs.join(left.select(F.col("__block").alias("key")).distinct(), "key", "left_semi")
        needs = written(there.unionByName(asked).distinct(), "needs")
        removed(before, asked)
        pending = left.select("__block", "title", "text", "payload.*")
    return union(done).select(*pages.columns, "outcome")


def pa_type(kind: str) -> pa.DataType:
    """Arrow's type of a struct<..> of Spark's."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    return to_arrow_type(DataType.fromDDL(kind))
