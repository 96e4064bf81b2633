"""Whole runs: a dump to files, folder or standard output, and several languages to dated folders."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, replace

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import abbreviations, lattice
from ..operators import pages as ops
from ..options import Options
from ..sources import dump, sink
from . import extract as extraction


@dataclass(frozen=True)
class Report:
    """What a run did: records written, seconds, records a second."""

    records: int
    seconds: float

    @property
    def rate(self) -> float:
        return self.records / self.seconds if self.seconds else 0.0


def extract_to(spark: SparkSession, path: str, out: str, options: Options | None = None, template_path: str | None = None, ordered: bool = False) -> Report:
    """A dump file, folder or glob to JSON lines in `out`: files of at most options.max_bytes, compressed if
    options.compress; "-" is standard output. template_path: read if it is there, else the dump's templates are written
    to it first; so are options.lexicon and options.abbreviations, learned from the dump's texts."""
    options, began = options or Options(), time.monotonic()
    if template_path and not exists(spark, template_path):
        dump.write_template_file(ops.template_pages(ops.without_redirects(dump.read_pages(spark, path))), template_path)
    if options.lexicon and not exists(spark, options.lexicon):
        lattice.learn(ops.articles(ops.without_redirects(dump.read_pages(spark, path)))).frame(spark).write.parquet(options.lexicon)
    if options.abbreviations and not exists(spark, options.abbreviations):
        abbreviations.abbreviations(ops.articles(ops.without_redirects(dump.read_pages(spark, path)))).write.parquet(options.abbreviations)
    records = extraction.extract_dump(spark, path, options, template_path, ordered and out == "-")
    if out == "-":
        return Report(sink.print_json(records.drop("path", "position")), time.monotonic() - began)
    observation = Observation()
    records = records if ordered else records.drop("path", "position")
    counted = records.observe(observation, F.count(F.lit(1)).alias("n"))
    sink.write_split(spark, counted, out, options.max_bytes, options.compress, ["path", "position"] if ordered else None)
    return Report(observation.get["n"], time.monotonic() - began)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system has the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def extract_languages(spark: SparkSession, dumps: dict[str, str], root: str, date: str, options: Options | None = None) -> dict[str, Report]:
    """Each language's dump to root/lang=../date=.. by Spark's writer; when all of a language is written, the file
    root/lang=../LATEST names the date. Inputs are never deleted. A date that is there is written anew."""
    if not re.fullmatch(r"[\w.-]+", date):
        raise ValueError(f"not a name for a folder: {date!r}")
    reports = {}
    for lang, path in dumps.items():
        own, began = replace(options or Options(), lang=lang), time.monotonic()
        observation = Observation()
        records = extraction.extract_dump(spark, path, own).drop("path", "position").observe(observation, F.count(F.lit(1)).alias("n"))
        target = f"{root}/lang={lang}"
        records.write.mode("overwrite").option("ignoreNullFields", False).option("compression", "bzip2" if own.compress else "none").json(f"{target}/date={date}")
        swap_pointer(spark, f"{target}/LATEST", date)
        reports[lang] = Report(observation.get["n"], time.monotonic() - began)
    return reports


def swap_pointer(spark: SparkSession, path: str, value: str) -> None:
    """The one-line file at path gets a new value: written beside it, then renamed over it in one step."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    at, new = hadoop.Path(path), hadoop.Path(f"{path}.new")
    system = at.getFileSystem(conf)
    stream = system.create(new, True)
    stream.write(bytearray(value.encode()))
    stream.close()
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(system.getUri(), conf).rename(system.makeQualified(new), system.makeQualified(at), how)
