"""Markup steps that need no stack, as native expressions. Each agrees with the kernel on text without nesting."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..wikitext.clean import DISCARDED, IGNORED, LATE_SWITCHES, PROTOCOLS, SELF_CLOSING, SWITCHES

def map_matches(text: Column, pattern: str, change) -> Column:
    """change applied to every match of a pattern that is never empty: what lies between is kept."""
    between = F.split(text, pattern, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), change)
    return F.concat_ws("", F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))))


def without_comments(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<!--.*?-->", "")


def without_tags(text: Column, keep_links: bool = False) -> Column:
    """Self-closing tags, and open and close tags of the ignored elements; their content stays."""
    ignored = "|".join(IGNORED if keep_links else [*IGNORED, "a"])
    return F.regexp_replace(text, rf"(?is)<\s*(?:{'|'.join(SELF_CLOSING)})\b[^>]*/\s*>|<(?:{ignored})\b.*?>|</\s*(?:{ignored})>", "")


def without_elements(text: Column) -> Column:
    """Discarded elements with their content, in the listed order, where they don't nest in their own kind. Only the
    kinds that the text names are looked for: one pass finds them."""

    def one(whole: Column) -> Column:
        names = F.transform(F.regexp_extract_all(whole, F.lit(r"<\s*/?\s*(\w+)"), F.lit(1)), F.lower)
        present = F.array_intersect(F.array(*map(F.lit, DISCARDED)), names)
        element = lambda tag: F.concat(F.lit(r"(?is)<\s*"), tag, F.lit(r"\b[^>/]*>.*?<\s*/\s*"), tag, F.lit(">"))
        return F.aggregate(present, whole, lambda left, tag: F.regexp_replace(left, element(tag), F.lit("")))

    return F.element_at(F.transform(F.array(text), one), 1)  # the text is worked out once


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]*>", "")


def code_point(n: Column) -> Column:
    """The character of a number; null where there is none."""
    there = n.between(0, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    return F.when(there, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))


def unescape(text: Column) -> Column:
    """Named entities and decimal and hexadecimal references to characters, in one pass; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))])

    def one(m: Column) -> Column:
        body = F.substring(m, F.lit(2), F.length(m) - 2)
        decimal = F.when(body.rlike("^#[0-9]+$"), F.substring(body, F.lit(2), F.length(body)).try_cast("bigint"))
        hexadecimal = F.when(body.rlike("^#x[0-9A-Fa-f]{1,8}$"), F.conv(F.substring(body, F.lit(3), F.length(body)), 16, 10).try_cast("bigint"))
        return F.coalesce(code_point(F.coalesce(decimal, hexadecimal)), F.try_element_at(names, body), m)

    return map_matches(text, r"&#?\w+;", one)


def external_links(text: Column) -> Column:
    protocols = "|".join(f"\\Q{p}\\E" for p in PROTOCOLS)
    return F.regexp_replace(text, rf"\[(?i:{protocols})[^\]\[<>\"\x00-\x20\x7f]+\s*([^\]\[\x00-\x08\x0a-\x1f]*?)\]", "$1")


def internal_links(text: Column) -> Column:
    """Links without links inside."""

    def one(link: Column) -> Column:
        inner = F.substring(link, F.lit(3), F.length(link) - 4)
        label = F.trim(F.element_at(F.split(inner, r"\|", -1), -1))
        away = inner.rlike(r"^:?[^:|]+:") & ~inner.rlike(r"^:?(?:w|wiktionary|wikt):")
        return F.when(away, F.lit("")).otherwise(F.replace(F.when(inner.contains("|"), label).otherwise(inner), F.lit(" "), F.lit("_")))

    return map_matches(text, r"\[\[[^\[\]]*\]\]", one)


def quotes(text: Column) -> Column:
    for pattern, by in ((r"'''''(.*?)'''''", "$1"), (r"'''(.*?)'''", "$1"), (r"''\"([^\"]*?)\"''", '"$1"'), (r"''(.*?)''", '"$1"'), (r'""([^"]*?)""', '"$1"')):
        text = F.regexp_replace(text, pattern, by)
    return F.replace(F.replace(text, F.lit("'''"), F.lit("")), F.lit("''"), F.lit('"'))


def switches(text: Column, late: bool = False) -> Column:
    return F.regexp_replace(text, "|".join(LATE_SWITCHES if late else SWITCHES), "")


def tables(text: Column) -> Column:
    """Tables without tables inside."""
    return F.regexp_replace(text, r"(?s)\{\|.*?\|\}", "")


def templates(text: Column) -> Column:
    """Calls without calls inside."""
    return F.regexp_replace(text, r"\{\{[^{}]*\}\}", "")


def punctuation(text: Column) -> Column:
    text = F.replace(F.replace(F.replace(text, F.lit("<<"), F.lit("«")), F.lit(">>"), F.lit("»")), F.lit("\t"), F.lit(" "))
    text = F.regexp_replace(F.regexp_replace(text, " {2,}", " "), r"\.{4,}", "...")
    text = F.regexp_replace(text, r"(?U)\n\W+?\n", "\n")
    return F.replace(F.replace(text, F.lit(",,"), F.lit(",")), F.lit(",."), F.lit("."))


def middle_dots(text: Column) -> Column:
    return F.translate(text, "．‧˙", "···")


def left_links(text: Column) -> Column:
    def one(m: Column) -> Column:
        bare = F.replace(F.replace(m, F.lit("[["), F.lit("")), F.lit("]]"), F.lit(""))
        return F.when(m.contains(":"), F.lit("")).otherwise(F.element_at(F.split(bare, r"\|", -1), 1))

    return map_matches(text, r"\[\[[^\]]*?\]\]", one)


def numbers(text: Column) -> Column:
    return map_matches(text, r"[^\d]\d{1,2}(?:,\d{3})+[^\d]", lambda m: F.replace(m, F.lit(","), F.lit("")))


def placeholders(text: Column, tag: str, word: str) -> Column:
    """Elements to word_n, n counting all; each repeat has the number of the first of its kind."""
    pattern = rf"(?is)<\s*{tag}(?:\s*| [^>]+?)>.*?<\s*/\s*{tag}\s*>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    named = F.transform(found, lambda m: F.concat(F.lit(f"{word}_"), F.array_position(found, m).cast("string")))
    return F.concat_ws("", F.zip_with(F.split(text, pattern, -1), named, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))))
