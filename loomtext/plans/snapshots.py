"""Runs that work on changed pages alone.

A snapshot keeps, for each page of a dump, a hash of what it is made from, its record, and the titles that its
expansion asked for, found or not. An expansion sees nothing else of the dictionary, so a page of the next dump whose hash
is known and whose titles all have the entries they had has the record it had; names that only expansion makes need no
guess. All others run. What is compared are hashes and titles; texts and records of unchanged pages move only to be written.

Tables of a snapshot: rows (page, asked, error, the columns of a record; a page that failed keeps its error and is not
tried again before it changes) and entries (title, entry: the hash of a body and a redirect; the time of the run
stands there, too, under a name that no title can have)."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dictionary
from ..operators import pages as ops
from ..options import Options
from ..sources import dump
from ..sources.scratch import removed, written
from ..wikitext.templates import NOW
from . import extract as extraction
from .run import exists, swap_pointer

ROWS = ["page", "asked", "error", *extraction.OUTPUT]
NO_SITE = {"urlbase": "", "namespaces": [], "template": "", "module": ""}


def settings(spark: SparkSession, options: Options, site: dict) -> str:
    """All that a record depends on beside its page, the dictionary and the time. Tables count by their rows."""
    fixed = [options.lang, options.html, options.links, options.sections, options.lists, options.link_prefixes, options.expand_templates, options.compat]
    tables = [spark.read.parquet(p) for p in (options.lexicon, options.abbreviations, options.script) if p]
    sums = [df.agg(F.count("*"), F.bit_xor(F.xxhash64(*df.columns)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first() for df in tables]
    return repr((fixed, sorted(site["namespaces"]), site["urlbase"], site["template"], [tuple(map(str, s)) for s in sums], [bool(p) for p in (options.lexicon, options.abbreviations, options.script)]))


def entries_of(spark: SparkSession, template_pages: DataFrame | None, options: Options) -> DataFrame:
    """title and entry of all that is defined or redirects, and the time."""
    now = spark.range(1).select(F.lit(NOW).alias("title"), F.lit(options.as_of.isoformat()).alias("entry"))
    if template_pages is None:
        return now
    held = dictionary.entries(*ops.define_templates(template_pages))
    return held.select("title", F.sha2(F.to_json(F.struct("body", "dst")), 256).alias("entry")).unionByName(now)


def unchanged(counts: DataFrame, entries: DataFrame, rows: DataFrame, before: DataFrame) -> DataFrame:
    """page: hashes of counts (page, n) that stand as often in rows and asked only for entries that are as they were."""
    old, new = before.toDF("title", "old"), entries.toDF("title", "new")
    changed = old.join(new, "title", "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).select("title")
    stale = rows.select("page", F.explode("asked").alias("title")).join(changed, "title", "left_semi").select("page").distinct()
    held = rows.groupBy("page").agg(F.count("*").alias("n"))
    return counts.join(held, ["page", "n"], "left_semi").join(stale, "page", "left_anti").select("page")


def take(pages: DataFrame, options: Options | None = None, site: dict | None = None, template_pages: DataFrame | None = None, before: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (with `fresh`: whether the page ran) and entries of a snapshot of pages (id, title, ns, text), given those of
    an earlier one. The rows are those of a run over all pages, in any order; equal pages are equal rows."""
    spark, options, site = pages.sparkSession, options or Options(), site or NO_SITE
    made_from = F.struct(F.lit(settings(spark, options, site)).alias("s"), "id", "title", "ns", "text")
    hashed = pages.withColumn("page", F.sha2(F.to_json(made_from, {"ignoreNullFields": "false"}), 256))
    entries = written(entries_of(spark, template_pages, options), "entries")
    todo, kept = hashed, None
    if before:
        rows = before[0].select(*ROWS)
        counts = written(hashed.groupBy("page").agg(F.count("*").alias("n")), "pages")
        same = written(unchanged(counts, entries, rows, before[1].select("title", "entry")), "unchanged")
        fresh = written(counts.join(same, "page", "left_anti").select("page"), "fresh")  # its size is known to the join
        removed(counts)
        todo, kept = hashed.join(fresh, "page", "left_semi"), rows.join(same, "page", "left_semi").withColumn("fresh", F.lit(False))
    tried = extraction.attempt(todo, extraction.template_site(spark, template_pages, site, options), options, site["urlbase"])
    ran = extraction.tokenised(tried, options).select("page", "outcome.asked", "outcome.error", *extraction.OUTPUT).withColumn("fresh", F.lit(True))
    return ran if kept is None else ran.unionByName(kept), entries


@dataclass(frozen=True)
class Update:
    """What an update did: records of the new snapshot, pages that ran for it, seconds."""

    records: int
    ran: int
    seconds: float


def update(spark: SparkSession, path: str, root: str, date: str, options: Options | None = None, template_path: str | None = None) -> Update:
    """The dump at path to JSON lines in root/date=.., with the help of the snapshot that root/LATEST names, if there is
    one; the new one is at root/snapshots/date=.., and LATEST names it when all is written. A run that ends early leaves LATEST
    as it was; earlier snapshots stay and can be deleted but for the latest."""
    options, began = options or Options(), time.monotonic()
    latest = spark.read.text(f"{root}/LATEST").first()["value"] if exists(spark, f"{root}/LATEST") else None
    if latest == date:
        raise ValueError(f"{date} is the latest snapshot already")
    place = lambda d, table: f"{root}/snapshots/date={d}/{table}"
    before = (spark.read.parquet(place(latest, "rows")), spark.read.parquet(place(latest, "entries"))) if latest else None
    pages = ops.articles(ops.without_repeats(ops.without_redirects(dump.read_pages(spark, path))))
    templates = dump.read_pages(spark, template_path) if template_path else None
    rows, entries = take(pages.drop("path", "position"), options, dump.read_site(spark, path), templates, before)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(place(date, "rows"))
    entries.write.mode("overwrite").parquet(place(date, "entries"))
    removed(entries)
    done = spark.read.parquet(place(date, "rows"))
    good = done.where("error IS NULL").select(*extraction.OUTPUT)
    good.write.mode("overwrite").option("ignoreNullFields", False).option("compression", "bzip2" if options.compress else "none").json(f"{root}/date={date}")
    n = done.agg(F.count_if(F.col("error").isNull()), F.count_if("fresh")).first()
    swap_pointer(spark, f"{root}/LATEST", date)
    return Update(n[0], n[1], time.monotonic() - began)
