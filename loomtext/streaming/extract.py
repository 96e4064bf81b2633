"""Extraction of dumps as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.pages import articles, without_redirects, without_repeats
from ..options import Options
from ..plans.extract import extract
from ..sources.dump import parse_chunks, read_pages


def extract_stream(
    spark: SparkSession, folder: str, out: str, checkpoint: str, options: Options | None = None, site: dict | None = None, files_per_batch: int = 8, template_path: str | None = None
) -> StreamingQuery:
    """Every new file is extracted once and written to `out`/batch=N as JSON lines; all files that are there are taken,
    then the query ends (call it again, or with a schedule, for the next ones). A batch that is run again after a
    failure replaces what it wrote. Pages that stand twice in a row in a file are taken once; templates of a file of
    them are read anew for each batch."""
    raw = spark.readStream.option("lineSep", "</page>").option("maxFilesPerTrigger", files_per_batch).text(folder)
    chunks = raw.select("value", F.col("_metadata.file_path").alias("path"))

    def write(batch: DataFrame, number: int) -> None:
        pages = parse_chunks(batch.withColumn("position", F.monotonically_increasing_id()))
        pages = articles(without_repeats(without_redirects(pages)))
        templates = read_pages(spark, template_path) if template_path else None
        extract(pages, options, site, templates).write.mode("overwrite").option("ignoreNullFields", False).json(f"{out}/batch={number}")

    return chunks.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
