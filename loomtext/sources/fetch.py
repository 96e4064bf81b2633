"""Download of the files of a listing: a few at a time, each checked and dated as the listing says."""

from __future__ import annotations

import calendar
import os
import shutil
import time
import urllib.request
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "url string, path string, size bigint, seconds double, error string"


def fetch(url: str, target: str, size: int, seconds: int | None, timeout: float = 60.0) -> None:
    """url to the file target, whole or not at all: what arrives is counted before it gets its name and its time."""
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    part = f"{target}.{uuid.uuid4().hex}.part"
    try:
        with urllib.request.urlopen(url, timeout=timeout) as source, open(part, "wb") as out:
            shutil.copyfileobj(source, out, 1 << 20)
        if os.path.getsize(part) != size:
            raise OSError(f"{os.path.getsize(part)} bytes of {size}")
        if seconds is not None:
            os.utime(part, (seconds, seconds))
        os.replace(part, target)
    finally:
        if os.path.exists(part):
            os.remove(part)


def download(listing: DataFrame, folder: str, at_once: int = 3) -> DataFrame:
    """Fetches each row's url to folder/path (a folder that all executors mount), at_once files at a time, the largest
    first. One row a file: url, path, size, seconds it took, and the error of a file that failed (the others go on).
    Lazy: an action runs it; a file that is there whole and dated is not among to_fetch()'s rows the next time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for url, path, size, date in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                began, error = time.monotonic(), None
                try:
                    fetch(url, os.path.join(folder, path), size, calendar.timegm(date.timetuple()) if date else None)
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                row = [[url], [path], [size], [time.monotonic() - began], [error]]
                kinds = [pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], ["url", "path", "size", "seconds", "error"])

    lanes = listing.select("url", "path", "size", F.to_utc_timestamp("date", F.current_timezone()).alias("date"))
    lanes = lanes.repartition(at_once).sortWithinPartitions(F.desc("size"))
    return lanes.mapInArrow(run, RESULT)
