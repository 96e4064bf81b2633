"""Filters over pages and the definitions of templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import markup
from ..sources.dump import TEMPLATE_NAMESPACES
from ..sources.scratch import removed, written


def without_redirects(pages: DataFrame) -> DataFrame:
    return pages.where(~F.col("redirect"))


def without_repeats(pages: DataFrame, most_sent: int = 100_000) -> DataFrame:
    """Pages whose id is that of the page before in the same file go. Redirects are expected to be gone.

    Only ids and places are brought in order, never texts: within a scan partition (the upper bits of position, as
    monotonically_increasing_id() gives it), and across partitions by the last id of the one before. They are read once and
    written; the places of repeats, a few, are then taken out of the pages where they are scanned; more than most_sent meet
    them in a join."""
    slim = written(pages.select("path", "position", "id", F.shiftright(F.col("position").cast("long"), 33).alias("__part")), "places")
    inside = Window.partitionBy("path", "__part").orderBy("position")
    ends = slim.groupBy("path", "__part").agg(F.max_by("id", "position").alias("__end"))
    ends = ends.select("path", "__part", F.lag("__end").over(Window.partitionBy("path").orderBy("__part")).alias("__end"))
    placed = slim.withColumns({"__n": F.row_number().over(inside), "__before": F.lag("id").over(inside)}).join(ends, ["path", "__part"])
    repeats = placed.where(F.col("id").eqNullSafe(F.when(F.col("__n") == 1, F.col("__end")).otherwise(F.col("__before")))).select("path", "position")
    few = repeats.limit(most_sent + 1).collect()
    if len(few) <= most_sent:
        removed(slim)
    if not few:
        return pages
    if len(few) <= most_sent:
        repeats = F.broadcast(pages.sparkSession.createDataFrame(few, repeats.schema))
    return pages.join(repeats, ["path", "position"], "left_anti").select(*pages.columns)


def articles(pages: DataFrame) -> DataFrame:
    return pages.where(~F.col("ns").isin(*TEMPLATE_NAMESPACES))


def template_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("ns").isin(*TEMPLATE_NAMESPACES))


def template_body(text: Column, unescape=markup.unescape) -> Column:
    """What a template page includes elsewhere: unescaped, without comments and noinclude parts; only the onlyinclude
    parts if they have content, else all but the includeonly tags."""
    body = markup.without_comments(unescape(text))
    body = F.regexp_replace(body, r"(?s)<noinclude>(?:.*?)</noinclude>", "")
    body = F.regexp_replace(body, r"(?s)<noinclude\s*>.*$", "")
    body = F.replace(body, F.lit("<noinclude/>"), F.lit(""))
    only = F.concat_ws("", F.regexp_extract_all(body, F.lit(r"(?s)<onlyinclude>(.*?)</onlyinclude>"), F.lit(1)))
    return F.when(only != "", only).otherwise(F.regexp_replace(body, "</?includeonly>", ""))


def redirect_target(text: Column) -> Column:
    return F.regexp_extract(text, r"(?i)^#REDIRECT.*?\[\[([^\]]*)\]\]", 1)


def define_templates(pages: DataFrame, order: str = "position", unescape=markup.unescape) -> tuple[DataFrame, DataFrame]:
    """(title, body) of templates, of equal titles the last; and (src, dst) of those that redirect. Empty bodies go."""
    last = Window.partitionBy("title").orderBy(F.desc(order))
    named = template_pages(pages).withColumn("__dst", redirect_target(F.col("text")))
    bodies = named.where("__dst = ''").withColumn("body", template_body(F.col("text"), unescape)).where("body <> ''")
    bodies = bodies.withColumn("__n", F.row_number().over(last)).where("__n = 1").select("title", "body")
    moved = named.where("__dst <> ''").withColumn("__n", F.row_number().over(last)).where("__n = 1")
    return bodies, moved.select(F.col("title").alias("src"), F.col("__dst").alias("dst"))


def template_usage(pages: DataFrame, templates: DataFrame, prefix: str = "Template:") -> DataFrame:
    """How often pages call each template by a literal name; names without a definition count, too (defined false)."""
    found = F.regexp_extract_all("text", F.lit(r"\{\{([^{}|:#]+)"), F.lit(1))
    name = F.trim("name")
    calls = pages.select(F.explode(found).alias("name")).select(F.concat(F.lit(prefix), F.upper(F.substring(name, 1, 1)), F.substring(name, F.lit(2), F.length(name))).alias("title"))
    counts = calls.groupBy("title").agg(F.count("*").alias("calls"))
    return counts.join(templates.select("title", F.lit(True).alias("defined")), "title", "left").select("title", "calls", F.coalesce("defined", F.lit(False)).alias("defined"))
