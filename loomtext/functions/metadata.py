"""What a page says about itself, as native expressions over its raw text and title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_url(base: Column | str, page_id: Column) -> Column:
    return F.concat(F.lit(base) if isinstance(base, str) else base, F.lit("?curid="), page_id)


def categories(text: Column) -> Column:
    """Names of [[Category:name|key]], in order, repeats kept."""
    return F.regexp_extract_all(text, F.lit(r"\[\[Category:([^\]|]*)"), F.lit(1))


def related(text: Column) -> Column:
    """Targets of links without a colon, cut at ' (' and at |, distinct and sorted."""
    found = F.regexp_extract_all(text, F.lit(r"\[\[([^:\]]*)\]\]"), F.lit(1))
    short = F.transform(found, lambda x: F.regexp_replace(F.regexp_replace(x, r" \(.*", ""), r"\|.*", ""))
    return F.array_sort(F.array_distinct(short))


def is_category(title: Column) -> Column:
    return F.lower(F.substring(title, 1, 9)) == "category:"


def bare_title(title: Column) -> Column:
    return F.when(is_category(title), F.substring(title, F.lit(10), F.length(title))).otherwise(title)


def main_article(title: Column, text: Column) -> Column:
    """Of a category, the page its first {{Cat main|..}} names; '' without one. An unclosed one runs to the text's
    last character, which is left out."""
    start = F.locate("{{cat main|", F.lower(text))
    rest = F.substring(text, start + 11, F.length(text))
    end = F.locate("}}", rest)
    name = F.when(end > 0, F.substring(rest, F.lit(1), end - 1)).otherwise(F.substring(rest, F.lit(1), F.greatest(F.lit(0), F.length(rest) - 1)))
    return F.when(is_category(title) & (start > 0), name).otherwise(F.lit(""))


def upper_first(s: Column) -> Column:
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s)))


def lower_first(s: Column) -> Column:
    return F.concat(F.lower(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s)))


def normal_title(title: Column, namespaces: list[str]) -> Column:
    """Spaces and underscores collapsed; first letter of the title, or of what follows a known namespace, in upper case."""
    plain = F.regexp_replace(F.regexp_replace(title, r"^[ _]+|[ _]+$", ""), r"[\s_]+", " ")
    head, rest = F.regexp_extract(plain, r"^([^:]*):\s*\S", 1), F.regexp_extract(plain, r"^[^:]*:\s*(\S.*)$", 1)
    gap = F.when(F.regexp_extract(plain, r"^[^:]*:(\s*)\S", 1) != "", F.lit(" ")).otherwise(F.lit(""))
    known = F.concat(upper_first(head), F.lit(":"), upper_first(rest))
    other = F.concat(upper_first(head), F.lit(":"), gap, upper_first(rest))
    return F.when(rest == "", upper_first(plain)).when(upper_first(head).isin(namespaces), known).otherwise(other)
