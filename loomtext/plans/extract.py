"""A dump's pages to records of plain text, categories, links and tokens.

Metadata are native expressions, so a query that asks only for them never starts Python. The text is one Arrow
function a page and the tokens another, and each is a column of its own for the same reason."""

from __future__ import annotations

import traceback
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata
from ..functions.batches import by_slices, slices
from ..operators import abbreviations, dictionary
from ..operators import pages as ops
from ..operators.lattice import Lexicon
from ..operators.script import Converter
from ..options import Options
from ..sources import dump
from ..sources.scratch import removed, written
from ..tokenize import rule_words, segment, sentences
from ..wikitext.clean import plain_text
from ..wikitext.templates import Expander, Site

#: Template dictionaries up to this size travel in the task's closure; larger ones are joined.
BROADCAST_BYTES = 64 << 20
RESULT = "text string, title_errors int, call_errors int, depth_errors int, parameter_errors int, error string, asked array<string>"


@dataclass(frozen=True)
class Large:
    """A dictionary that doesn't travel: its entries meet the pages by rounds of joins."""

    site: Site
    entries: DataFrame


def template_site(spark: SparkSession, template_pages: DataFrame | None, site: dict, options: Options) -> Site | Large:
    """Definitions and redirects. Their size is measured first: small ones are sent to the workers, large ones stay tables."""
    names = frozenset(site["namespaces"]) | {site["template"] or "Template"}
    own = Site(namespaces=names, template_namespace=site["template"] or "Template", compat=options.compat)
    if template_pages is None:
        return own
    tables = [df.toDF("title", "value") for df in ops.define_templates(template_pages)]
    held = written(tables[0].withColumn("moved", F.lit(False)).unionByName(tables[1].withColumn("moved", F.lit(True))), "dictionary")
    size = held.agg(F.sum(F.octet_length("title") + F.octet_length("value"))).first()[0] or 0
    bodies, moved = held.where("NOT moved").select("title", "value"), held.where("moved").select("title", "value")
    if size > BROADCAST_BYTES:
        return Large(own, dictionary.entries(bodies, moved))
    sent = [{r["title"]: r["value"] for r in df.toLocalIterator()} for df in (bodies, moved)]
    removed(held)
    return replace(own, templates=sent[0], redirects=sent[1])


def outcome_of(site: Site, options: Options, title: str, text: str) -> dict:
    """RESULT for one page. A page that fails gives its error and no text."""
    expander = Expander(site, title or "", options.as_of)
    try:
        out, error = plain_text(text or "", options, expander if options.expand_templates else None), None
    except Exception:
        out, error = None, traceback.format_exc(limit=3)
    return {
        "text": out, "title_errors": expander.title_errors, "call_errors": expander.call_errors, "depth_errors": expander.depth_errors,
        "parameter_errors": expander.parameter_errors, "error": error, "asked": sorted(expander.asked),
    }


def text_function(site: Site, options: Options):
    """(title, text) to RESULT."""

    columns = [c.split()[0] for c in RESULT.split(", ")]

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for titles, texts in batches:
            for a, b in slices([len(x or "") for x in texts]):
                some = zip(titles.iloc[a:b], texts.iloc[a:b], strict=True)
                yield pd.DataFrame([outcome_of(site, options, t, x) for t, x in some], columns=columns)

    return F.pandas_udf(run, RESULT).asNondeterministic()  # else a filter on the result would run it twice


def by_rounds(pages: DataFrame, large: Large, options: Options) -> DataFrame:
    """pages with the outcome of the text function, the dictionary joined."""
    site = large.site

    def expand(held: dictionary.Held):
        own = replace(site, templates=held.view(0), redirects=held.view(1), parsed={})
        return lambda title, text: outcome_of(own, options, title, text)

    fields = ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in RESULT.split(", "))
    return dictionary.by_rounds(pages, large.entries, site.template_namespace, expand, f"struct<{fields}>")


def token_function(options: Options, lexicon: Lexicon | None = None, known: frozenset[str] = frozenset()):
    """Tokens of all lines: by the lexicon, if there is one, a batch of texts at a time; by the rules, if there are known
    abbreviations; else by the language's segmenter."""

    def run(texts: pd.Series) -> pd.Series:
        if known and lexicon is None:
            return texts.map(lambda t: [w for x in sentences(options.lang, t or "") for w in rule_words(x, known)])
        if lexicon is None:
            return texts.map(lambda t: segment(options.lang, t or "", options.sentence_seconds))
        lines = [sentences(options.lang, t or "") for t in texts]
        words = iter(lexicon.words([x for some in lines for x in some]))
        return pd.Series([[w for _ in some for w in next(words)] for some in lines], dtype=object)

    return by_slices(run, "array<string>")


def converted(pages: DataFrame, options: Options) -> DataFrame:
    """Title and text in another script: by the table of options.script; for zh without one to the traditional script, if
    the converter's library is installed."""
    if options.script:
        by = Converter.read(pages.sparkSession.read.parquet(options.script))
        return pages.withColumns({c: by.column(c) for c in ("title", "text")})
    if options.lang != "zh":
        return pages
    try:
        from zhconvert import conv2tw
    except ImportError:
        return pages
    both = F.pandas_udf(lambda s: s.map(conv2tw), "string")
    return pages.withColumn("title", both("title")).withColumn("text", both("text"))


def attempt(pages: DataFrame, site: Site | Large, options: Options, urlbase: str) -> DataFrame:
    """All pages with their metadata and the outcome of the text function."""
    title, text = F.col("title"), F.col("text")
    pages = converted(pages, options)
    named = pages.select(
        *[c for c in ("path", "position", "ns", "page") if c in pages.columns],
        metadata.bare_title(title).alias("title"), "id", metadata.page_url(urlbase, F.col("id")).alias("url"), metadata.related(text).alias("related"),
        metadata.is_category(title).alias("isCategory"), metadata.main_article(title, text).alias("mainArticle"),
        (~metadata.is_category(title)).alias("isArticle"), metadata.categories(text).alias("categories"), "text",
    )
    if isinstance(site, Large) and options.expand_templates:
        return by_rounds(named, site, options).drop("text")
    own = site.site if isinstance(site, Large) else site
    return named.withColumn("outcome", text_function(own, options)("title", "text")).drop("text")


OUTPUT = ["title", "id", "url", "text", "related", "isCategory", "mainArticle", "isArticle", "categories", "segment_text"]


def extract(pages: DataFrame, options: Options | None = None, site: dict | None = None, template_pages: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The output records of pages (as read_pages() gives them). Without a site the address has no base."""
    options = options or Options()
    site = site or {"urlbase": "", "namespaces": [], "template": "", "module": ""}
    tried = attempt(pages, template_site(pages.sparkSession, template_pages, site, options), options, site["urlbase"])
    return tokenised(tried.where(F.col("outcome.error").isNull()), options).select(*keep, *OUTPUT)


def tokenised(tried: DataFrame, options: Options) -> DataFrame:
    """attempt() with the outcome's text and its tokens."""
    spark = tried.sparkSession
    lexicon = Lexicon.read(spark.read.parquet(options.lexicon)) if options.lexicon else None
    texts = tried.withColumn("text", F.col("outcome.text"))
    table = spark.read.parquet(options.abbreviations) if options.abbreviations and lexicon is None else None
    known = abbreviations.few(table) if table is not None else []
    if known is None:
        held = written(texts, "texts")  # a text is made once, though it is read twice
        return abbreviations.with_known(held, table, by_slices(lambda t: t.map(lambda x: stopped(options, x)), "array<string>")("text"), "id").withColumn("segment_text", known_tokens(options)("text", "known")).drop("known")
    return texts.withColumn("segment_text", token_function(options, lexicon, frozenset(known))("text"))


def stopped(options: Options, text: str | None) -> list[str]:
    """Words of a text, in lower case, that have a stop behind them."""
    found = [rule_words(x) for x in sentences(options.lang, text or "")]
    return list({a.lower() for some in found for a, b in pairwise(some) if b == "."})


def known_tokens(options: Options):
    """token_function() for known abbreviations that each row brings along."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, known in batches:
            for a, b in slices([len(x or "") for x in texts]):
                some = zip(texts.iloc[a:b], known.iloc[a:b], strict=True)
                sets = ((t, frozenset(() if k is None else k)) for t, k in some)
                yield pd.Series([[w for x in sentences(options.lang, t or "") for w in (rule_words(x, k) if k else rule_words(x))] for t, k in sets], dtype=object)

    return F.pandas_udf(run, "array<string>")


def errors(pages: DataFrame, options: Options | None = None, site: dict | None = None, template_pages: DataFrame | None = None) -> DataFrame:
    """Pages that failed, or in which template expansion gave something up."""
    options = options or Options()
    site = site or {"urlbase": "", "namespaces": [], "template": "", "module": ""}
    tried = attempt(pages, template_site(pages.sparkSession, template_pages, site, options), options, site["urlbase"])
    counts = ["title_errors", "call_errors", "depth_errors", "parameter_errors"]
    return tried.select("id", "title", "outcome.*").where(" OR ".join(["error IS NOT NULL", *[f"{c} > 0" for c in counts]])).drop("text", "asked")


def extract_dump(spark: SparkSession, path: str, options: Options | None = None, template_path: str | None = None, ordered: bool = False) -> DataFrame:
    """A dump file, folder or glob to output records, with path and position in order if `ordered`. Templates have
    effect only if a file of them is given."""
    pages = ops.articles(ops.without_repeats(ops.without_redirects(dump.read_pages(spark, path))))
    templates = dump.read_pages(spark, template_path) if template_path else None
    out = extract(pages, options, dump.read_site(spark, path), templates, ("path", "position"))
    return out.orderBy("path", "position") if ordered else out


def extract_article(pages: DataFrame, options: Options | None = None, site: dict | None = None, template_pages: DataFrame | None = None) -> Iterator[str]:
    """Single-article mode: JSON lines of the given pages whatever their namespace, one after the other. Without a
    site the address has no base."""
    yield from extract(pages, options, site, template_pages).toJSON().toLocalIterator()
