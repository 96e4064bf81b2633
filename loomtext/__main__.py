"""Extraction from the command line: python -m loomtext DUMP -o OUT [options]."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from .options import Options, file_size
from .plans.extract import extract_article
from .plans.run import extract_to
from .sources import dump

VERSION = "0.2"


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="loomtext", description="Encyclopedia dumps to JSON lines of plain text.")
    p.add_argument("input", help="dump file, folder or glob, compressed or not")
    p.add_argument("-o", "--output", default="text", help="folder, or - for standard output")
    p.add_argument("--lang", default="en")
    p.add_argument("-b", "--bytes", default="1M", type=file_size, help="most bytes of a file, with K, M or G; at least 200K")
    p.add_argument("-c", "--compress", action="store_true", help="bzip2")
    p.add_argument("--html", action="store_true")
    p.add_argument("-l", "--links", action="store_true")
    p.add_argument("-s", "--sections", action="store_true")
    p.add_argument("--lists", action="store_true")
    p.add_argument("-ns", "--namespaces", default="", help="prefixes of internal links to keep, by commas")
    p.add_argument("--templates", help="file of templates; written first if it isn't there")
    p.add_argument("--lexicon", default="", help="table of pieces and costs for zh, ja and ko; learned from the input first if it isn't there")
    p.add_argument("--abbreviations", default="", help="table of words whose stop stays at them, for en and id; learned from the input first if it isn't there")
    p.add_argument("--script", default="", help="table of phrases (src, dst) that titles and texts are converted by")
    p.add_argument("--no-templates", dest="expand", action="store_false")
    p.add_argument("--ordered", action="store_true", help="records in the order of the dump")
    p.add_argument("-a", "--article", action="store_true", help="every page of the file to standard output, whatever its namespace")
    p.add_argument("-q", "--quiet", action="store_true")
    p.add_argument("--debug", action="store_true")
    p.add_argument("-v", "--version", action="version", version=VERSION)
    return p.parse_args(given)


def options_of(a: argparse.Namespace) -> Options:
    kept = {"link_prefixes": tuple(a.namespaces.split(","))} if a.namespaces else {}
    return Options(
        lang=a.lang, max_bytes=a.bytes if isinstance(a.bytes, int) else file_size(a.bytes), compress=a.compress, html=a.html, links=a.links, sections=a.sections, lists=a.lists,
        expand_templates=a.expand, lexicon=a.lexicon, abbreviations=a.abbreviations, script=a.script, **kept,
    )


def main(given: list[str] | None = None) -> int:
    a = arguments(given)
    logging.basicConfig(level=logging.DEBUG if a.debug else logging.WARNING if a.quiet else logging.INFO, stream=sys.stderr)
    spark = SparkSession.builder.appName("loomtext").getOrCreate()
    if a.article:
        templates = dump.read_pages(spark, a.templates) if a.templates else None
        for line in extract_article(dump.read_pages(spark, a.input), options_of(a), None, templates):
            print(line)
        return 0
    done = extract_to(spark, a.input, a.output, options_of(a), a.templates, a.ordered)
    logging.info("%d records in %.1f s (%.1f a second)", done.records, done.seconds, done.rate)
    return 0


if __name__ == "__main__":
    sys.exit(main())
