"""Dump listings: what a mirror's index page offers, and what of it is still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

LEAST_SIZE = 100_000


def parse_listing(html: DataFrame, base: str = "base", page: str = "html", lang: str = "lang") -> DataFrame:
    """One row per dump file of the index pages: the numbered parts, or the single file where there are none."""
    row = r'href="([^"]*pages-articles{}[^"]*bz2)"[^>]*>[^<]*</a>\s*(\d{{1,2}}-[A-Za-z]{{3}}-\d{{4}} \d{{2}}:\d{{2}})\s+(\d+)'
    numbered, single = row.format(r"\d"), row.format(r"\.xml\.").replace("[^\"]*bz2", "bz2")
    columns = lambda p: F.arrays_zip(*[F.regexp_extract_all(F.col(page), F.lit(p), F.lit(i)).alias(n) for i, n in ((1, "href"), (2, "when"), (3, "size"))])
    found = F.when(F.size(columns(numbered)) > 0, columns(numbered)).otherwise(columns(single))
    rows = html.select(F.col(base).alias("base"), F.col(lang).alias("lang"), F.explode(found).alias("r"))
    filename = F.substring_index("r.href", "/", -1)
    return rows.select(
        F.when(F.col("r.href").rlike("^[a-z]+://"), F.col("r.href")).otherwise(F.concat("base", "r.href")).alias("url"), "lang",
        F.to_timestamp("r.when", "d-MMM-yyyy HH:mm").alias("date"), F.col("r.size").cast("long").alias("size"),
        F.concat("lang", F.lit("/"), filename).alias("path"), filename.alias("filename"),
    )


def worth_fetching(listing: DataFrame) -> DataFrame:
    """Without stubs, largest first, so that the longest work begins first."""
    return listing.where(F.col("size") > LEAST_SIZE).orderBy(F.desc("size"))


def part_numbers(listing: DataFrame) -> DataFrame:
    """number: the part in the file's name; if any file of a language lacks one, 0, 1, .. by falling size. The second
    file with a number gets -1, the third -2."""
    by_size = [F.desc("size"), F.asc("filename")]
    held = written(listing.withColumn("number", F.regexp_extract("filename", r"articles(\d+).xml", 1)), "listing")
    some = held.groupBy("lang").agg(F.min(F.col("number") != "").alias("__all")).where("NOT coalesce(__all, false)").select(F.col("lang").alias("__lang"))
    numbered = held
    if not some.isEmpty():
        lacking = lambda how: held.join(F.broadcast(some), F.col("lang").eqNullSafe(F.col("__lang")), how)
        counted = placed(lacking("left_semi"), ["lang"], by_size, "__place").withColumn("number", F.col("__place").cast("string"))
        numbered = lacking("left_anti").unionByName(counted.drop("__place"))
    earlier = F.col("__place")
    suffix = F.when(earlier > 0, F.concat(F.lit("-"), earlier.cast("string"))).otherwise(F.lit(""))
    return placed(numbered, ["lang", "number"], by_size, "__place").withColumn("number", F.concat("number", suffix)).drop("__place")


def placed(rows: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """rows with the place, from 0, of each in its group. Groups may be of any size: rows are dealt by ranges of group and
    order, and a row's place is that among its range's rows of the group after those of the ranges before."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(rows.repartitionByRange(tasks, *by, *order).withColumn("__task", F.spark_partition_id()), "dealt")
    counts = dealt.groupBy(*by, "__task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*by).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(by)], F.col("__task").alias("__t"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    same = F.col("__task") == F.col("__t")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__{i}"))
    inside = F.row_number().over(Window.partitionBy(*by, "__task").orderBy(*order)) - 1
    return dealt.withColumn(name, inside).join(before.hint("merge"), same).withColumn(name, F.col(name) + F.col("__before")).select(*rows.columns, name)


def local_files(spark, path: str) -> DataFrame:
    """What is there: path, date and size of the files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("modificationTime").alias("date"), F.col("length").alias("size"))


def to_fetch(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Remote files that are not there with the same date and size."""
    return remote.join(local.select("path", "date", "size"), ["path", "date", "size"], "left_anti")
