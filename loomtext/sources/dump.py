"""Dump files as DataFrames. Compressed files are read by extension; raw text keeps its one level of XML escapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPLATE_NAMESPACES = ("10", "828")
FIELDS = ["path", "position", "id", "title", "ns", "redirect", "text"]


def _last(found: Column) -> Column:
    return F.when(F.size(found) > 0, F.element_at(found, -1)).otherwise(F.lit(""))


def parse_chunks(chunks: DataFrame, value: str = "value") -> DataFrame:
    """Pages from text cut at </page>: the first id of a page counts, of several revisions the last, and a
    self-closing text is empty. Chunks without a page (the end of the file) go."""
    page = F.substring_index(F.col(value), "<page>", -1)
    texts = F.regexp_extract_all(page, F.lit(r"(?s)<text(?:\s[^>]*)?(?:/>|(?<!/)>(.*?)</text>)"), F.lit(1))
    ns = F.regexp_extract(page, r"<ns>([^<]*)", 1)
    kept = [c for c in ("path", "position") if c in chunks.columns]
    return chunks.where(F.col(value).contains("<page>")).select(
        *kept,
        F.regexp_extract(page, r"<id>([^<]*)", 1).alias("id"),
        F.regexp_extract(page, r"<title>([^<]*)", 1).alias("title"),
        F.when(ns == "", "0").otherwise(ns).alias("ns"),
        page.rlike(r"<redirect[\s/>]").alias("redirect"),
        _last(F.transform(texts, lambda t: F.coalesce(t, F.lit("")))).alias("text"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """path, position (order in the file), id, title, ns, redirect, text. A glob reads many dumps."""
    raw = spark.read.option("lineSep", "</page>").text(path)
    return parse_chunks(raw.select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("position")))


def read_site(spark: SparkSession, path: str) -> dict:
    """urlbase (the base address up to its last /), namespaces, and the names of those of templates and modules, from
    what stands before the end of the first page of the first file. A dump without them gives empty values."""
    head = spark.read.option("lineSep", "</page>").text(path).select(F.substring_index("value", "</siteinfo>", 1).alias("value")).first()
    if head is None or "<siteinfo>" not in head["value"]:
        return {"urlbase": "", "namespaces": [], "template": "", "module": ""}
    row = spark.range(1).select(
        F.regexp_extract(F.lit(head["value"]), "<base>([^<]*)</base>", 1).alias("base"),
        F.regexp_extract_all(F.lit(head["value"]), F.lit('<namespace key="([^"]*)"'), F.lit(1)).alias("keys"),
        F.regexp_extract_all(F.lit(head["value"]), F.lit('<namespace key="[^"]*"[^>]*?(?:/>|>([^<]*)<)'), F.lit(1)).alias("names"),
    ).first()
    named = dict(zip(row["keys"], row["names"], strict=False))
    return {"urlbase": row["base"].rpartition("/")[0], "namespaces": [n for n in named.values() if n], "template": named.get("10") or "", "module": named.get("828") or ""}


def write_template_file(templates: DataFrame, path: str) -> None:
    """Template pages in the dump's own form, so that read_pages() reads them back."""
    page = F.concat(F.lit("<page>\n   <title>"), "title", F.lit("</title>\n   <ns>"), "ns", F.lit("</ns>\n   <id>"), "id", F.lit("</id>\n   <text>"), "text", F.lit("</text>\n</page>"))
    templates.select(page.alias("value")).write.text(path)
