"""The pass over lines in its default setting, over a page's array of lines (no shuffle), and words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nesting import let

HEADER = "^==.*=="


def compact(text: Column) -> Column:
    """array of kept lines.

    A paragraph line is inside a list if the last header, item or paragraph line before it is an item; it is kept there. Else it
    is kept unless it is residue, or indented while no header waits for its first paragraph: a header waits until the next
    paragraph line that is neither in a list nor residue. What comes before a line in each of these two sequences is its
    neighbour in a filtered array, so the work is linear in the lines (and a sort of what is kept)."""

    def kind(line: Column) -> Column:
        first = F.substring(line, 1, 1)
        return F.when(line.rlike(HEADER), "H").when(line.startswith("++"), "T").when(first == ":", "D").when(first.isin("*", "#", ";"), "L").otherwise("P")

    def residue(line: Column) -> Column:
        first, last = F.substring(line, 1, 1), F.substring(line, -1, 1)
        return first.isin("{", "|") | (last == "}") | ((first == "(") & (last == ")")) | line.rlike(r"^[.\-]+$")

    def title(line: Column) -> Column:
        bare = F.substring(line, F.lit(3), F.greatest(F.lit(0), F.length(line) - 4))
        return F.regexp_replace(bare, r"([^!?])$", r"$1.")

    def kept(all_: Column) -> Column:
        titles = F.transform(F.filter(all_, lambda x: x["kind"] == "T"), lambda x: F.struct(x["n"].alias("n"), title(x["line"]).alias("line")))
        chain = F.filter(all_, lambda x: x["kind"].isin("H", "L", "P"))
        placed = let(chain, lambda c: F.transform(c, lambda x, i: F.struct(x["n"].alias("n"), x["line"].alias("line"), x["kind"].alias("kind"), F.coalesce((i > 0) & (F.get(c, i - 1)["kind"] == "L"), F.lit(False)).alias("listed"))))
        plain = lambda x: F.struct(x["n"].alias("n"), x["line"].alias("line"))

        def paragraphs(p: Column) -> Column:
            inside = F.filter(p, lambda x: (x["kind"] == "P") & x["listed"])
            waits = F.filter(p, lambda x: (x["kind"] == "H") | ((x["kind"] == "P") & ~x["listed"] & ~residue(x["line"])))
            shown = let(waits, lambda w: F.filter(w, lambda x, i: (x["kind"] == "P") & (F.coalesce((i > 0) & (F.get(w, i - 1)["kind"] == "H"), F.lit(False)) | (F.substring(x["line"], 1, 1) != " "))))
            return F.transform(F.concat(inside, shown), plain)

        found = F.concat(F.filter(titles, lambda x: x["line"] != ""), let(placed, paragraphs))
        return F.transform(F.array_sort(found), lambda x: x["line"])

    numbered = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("n"), line.alias("line"), kind(line).alias("kind")))
    return let(F.filter(numbered, lambda x: x["line"] != ""), kept)


def glue_latin(text: Column) -> Column:
    """Latin words and numbers apart by one space joined by _, other ASCII space removed (for zh and ja)."""
    for head in (r"([A-Za-z][A-Za-z0-9.]?)", r"([A-Za-z][A-Za-z0-9.]?)", r"([A-Za-z][0-9.]+)"):
        text = F.regexp_replace(text, head + r"[ 　]([A-Za-z0-9.])", "$1_$2")
    return F.regexp_replace(text, r"[ \t\n\r\x0b\x0c]", "")


def words(text: Column) -> Column:
    """Words and single marks of every line: the rule tokenizer of English and Indonesian without contractions."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+(?:[.'’-][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\s]"), F.lit(0))
