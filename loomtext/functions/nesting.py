"""Nested regions and links as native expressions: one fold over a text's delimiters, with the depth as its state.

A text is cut at its delimiters once; the fold carries the place, the depth and where the region at hand began, and notes a
region when its depth is back at none. What is left or shown is put together by one join of the pieces. No Python runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..wikitext.clean import DISCARDED

REGIONS = "array<struct<start:int,end:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def tokens(text: Column, pattern: Column) -> Column:
    """(what stands before a delimiter, the delimiter) of each delimiter, in order."""
    before = F.split(text, pattern, -1)
    return F.zip_with(F.regexp_extract_all(text, pattern, F.lit(0)), F.slice(before, F.lit(1), F.size(before) - 1), lambda d, b: F.struct(b.alias("before"), d.alias("mark")))


def replaced(text: Column, regions: Column, by: Callable[[Column], Column] | None = None) -> Column:
    """The text with each region (ascending, apart) replaced by what `by` gives for it; by nothing without it."""

    def put(r: Column) -> Column:
        behind = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(r, i - 1)["end"])
        kept = lambda x, i: F.substring(text, behind(i) + 1, x["start"] - behind(i))
        pieces = F.transform(r, lambda x, i: F.concat(kept(x, i), by(x) if by else F.lit("")))
        last = F.substring(text, F.element_at(r, -1)["end"] + 1, F.lit(2**31 - 1))
        return F.when(F.size(r) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), last))

    return let(regions, put)


def nested_regions(text: Column, opening: Column, closing: Column) -> Column:
    """Outermost regions between delimiters that may nest. An opening right behind a region goes on with it. A region that
    stays open ends at the last close found in it, or is none without one; if openings follow further on, it reaches
    back to the first region. A delimiter that is both, when a close overlaps an opening, opens; inside a region it
    also closes."""
    either = F.concat(F.lit("(?iU)(?:"), opening, F.lit(")|(?:"), closing, F.lit(")"))
    shut = F.concat(F.lit("(?iU)^(?:"), closing, F.lit(")$"))
    state = {"place": 0, "depth": 0, "start": 2**31 - 1, "head": 0, "last": -1, "behind": False}

    def after(acc: Column, **changes: Column) -> Column:
        return F.struct(*[changes.get(k, acc[k]).alias(k) for k in (*state, "out")])

    def step(acc: Column, t: Column) -> Column:
        at = acc["place"] + F.length(t["before"])
        end = at + F.length(t["mark"])
        fresh = (acc["depth"] == 0) & (at != acc["last"])
        done = F.when(fresh & (acc["last"] > acc["start"]), F.array_append(acc["out"], F.struct(acc["start"].alias("start"), acc["last"].alias("end")))).otherwise(acc["out"])
        opened = after(
            acc, place=end, depth=acc["depth"] + 1, start=F.when(fresh, at).otherwise(acc["start"]), head=F.when(fresh, end).otherwise(acc["head"]),
            behind=(acc["depth"] > 0) & (acc["start"] < acc["last"]) & (acc["last"] < at), out=done,
        )
        closed = after(acc, place=end, depth=acc["depth"] - 1, last=end, behind=F.lit(False))
        counts = (acc["depth"] > 0) & (at >= acc["head"])
        return F.when(~F.regexp_like(t["mark"], shut), opened).when(counts, closed).otherwise(after(acc, place=end))

    def ended(acc: Column) -> Column:
        first = F.least(acc["start"], F.coalesce(F.array_min(F.transform(acc["out"], lambda r: r["start"])), acc["start"]))
        last = lambda start: F.struct(start.alias("start"), acc["last"].alias("end"))
        whole = F.when(acc["behind"], F.array(last(first))).otherwise(F.array_append(acc["out"], last(acc["start"])))
        return F.when(acc["last"] > acc["start"], whole).otherwise(acc["out"])

    zero = F.struct(*[F.lit(v).alias(k) for k, v in state.items()], F.array().cast(REGIONS).alias("out"))
    return F.aggregate(tokens(text, either), zero, step, ended)


def without_nested(text: Column, opening: str | Column, closing: str | Column) -> Column:
    """The text without its nested regions; a null text stays null."""
    left, right = (F.lit(x) if isinstance(x, str) else x for x in (opening, closing))
    return let(text, lambda t: replaced(t, nested_regions(t, left, right)))


def tables(text: Column) -> Column:
    return without_nested(text, r"\{\|", r"\|\}")


def templates(text: Column) -> Column:
    """Calls with their calls inside, where templates are not expanded."""
    return without_nested(text, r"\{\{", r"\}\}")


def elements(text: Column) -> Column:
    """Discarded elements with their content, in the listed order, each nested in its own kind. Only the kinds that the
    text names are looked for: one pass finds them."""

    def one(whole: Column) -> Column:
        names = F.transform(F.regexp_extract_all(whole, F.lit(r"(?U)<\s*/\s*(\w+)"), F.lit(1)), F.lower)
        present = F.array_intersect(F.array(*map(F.lit, DISCARDED)), names)
        opening = lambda tag: F.concat(F.lit(r"<\s*"), tag, F.lit(r"\b[^>/]*>"))
        closing = lambda tag: F.concat(F.lit(r"<\s*/\s*"), tag, F.lit(">"))
        return F.aggregate(present, whole, lambda left, tag: without_nested(left, opening(tag), closing(tag)))

    return let(text, one)


def link_regions(text: Column) -> Column:
    """Outermost [[ ]] regions, nested ones inside; what never closes is none."""
    zero = F.struct(F.lit(0).alias("place"), F.lit(0).alias("depth"), F.lit(0).alias("start"), F.array().cast(REGIONS).alias("out"))

    def step(acc: Column, t: Column) -> Column:
        at = acc["place"] + F.length(t["before"])
        state = lambda depth, start, out: F.struct((at + 2).alias("place"), depth.alias("depth"), start.alias("start"), out.alias("out"))
        opened = state(acc["depth"] + 1, F.when(acc["depth"] == 0, at).otherwise(acc["start"]), acc["out"])
        whole = F.array_append(acc["out"], F.struct(acc["start"].alias("start"), (at + 2).alias("end")))
        closed = state(F.greatest(acc["depth"] - 1, F.lit(0)), acc["start"], F.when(acc["depth"] == 1, whole).otherwise(acc["out"]))
        return F.when(t["mark"] == "[[", opened).otherwise(closed)

    return F.aggregate(tokens(text, F.lit(r"\[\[|\]\]")), zero, step, lambda acc: acc["out"])


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def link_label(inner: Column, prefixes: tuple[str, ...]) -> Column:
    """What a link shows: its label, which begins after the last outer bar before the last nested link, or after the first
    bar; nothing if its title names another namespace than the prefixes'."""

    def of(x: Column) -> Column:
        first = F.instr(x, "|")

        def begin(nested: Column) -> Column:
            earlier = F.substring(x, F.lit(1), F.coalesce(F.element_at(nested, -1)["start"], F.lit(0)))
            blank = replaced(earlier, F.slice(nested, F.lit(1), F.size(nested) - 1), lambda r: F.repeat(F.lit(" "), r["end"] - r["start"]))
            tail = lambda b: F.when(F.instr(b, "|") > 0, F.length(b) - F.instr(F.reverse(b), "|") + 1).otherwise(F.lit(0))
            return F.when(F.size(nested) == 0, first).otherwise(F.greatest(first, let(blank, tail)))

        label = stripped(F.substring(x, let(link_regions(x), begin) + 1, F.lit(2**31 - 1)))
        title = F.when(first > 0, F.regexp_replace(F.substring(x, F.lit(1), first - 1), r"(?U)\s+$", "")).otherwise(x)
        space = F.regexp_extract(title, r"^:?([^:]+):", 1)
        shown = F.when(first > 0, label).otherwise(x)
        return F.replace(F.when((space == "") | space.isin(*prefixes), shown).otherwise(F.lit("")), F.lit(" "), F.lit("_"))

    return let(inner, of)


def internal_links(text: Column, prefixes: tuple[str, ...] = ("w", "wiktionary", "wikt")) -> Column:
    """Links, with links inside, as what they show; letters right behind a link stay at it."""
    shown = lambda t: lambda r: link_label(F.substring(t, r["start"] + 3, r["end"] - r["start"] - 4), prefixes)
    return let(text, lambda t: replaced(t, link_regions(t), shown(t)))
