"""What the operators of this subpackage share: the cluster's shared folder, written cuts of lineage, range bounds."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: The white space that separates words in every contract of this subpackage: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a new temporary folder is
    made and set for the rest of the session if all runs on one machine; on a cluster that is an error."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="loomtext-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back. Cuts the lineage: a lost executor costs a reread,
    not a recomputation, and a value that was drawn once stays as it was drawn."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomtext/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.__dict__["written_at"] = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Remove what materialize() wrote for these tables. Only for those that no result still reads."""
    for df in tables:
        if df is not None and (path := df.__dict__.get("written_at")):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def lean(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for mapInArrow, giving memory back to the system when its task is over: Spark keeps the worker for
    later stages, and what an idle worker holds is missing there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim:
            trim(0)

    return run


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body uses it (a lambda variable is not inlined)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def range_bounds(df: DataFrame, column: str, parts: int) -> list:
    """At most parts - 1 ascending bounds that cut the column's values into ranges of about equal counts: quantiles of
    numbers; of other types, those of the 100 * parts distinct values of least hash."""
    if parts < 2:
        return []
    if isinstance(df.schema[column].dataType, NumericType):
        shares = [i / parts for i in range(1, parts)]
        return sorted(set(df.agg(F.percentile_approx(column, shares, 20 * parts).alias("b")).first()["b"] or []))
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v")).distinct()
    some = sorted(r[0] for r in values.orderBy(F.xxhash64("v")).limit(100 * parts).collect())
    return sorted({some[len(some) * i // parts] for i in range(1, parts)}) if some else []


def range_bucket(column: str, bounds: list) -> Column:
    """Number of bounds that are less than the column's value, by binary search: ranges ascend with the value; null
    goes to range 0."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    less = lambda n, s: (n + s <= len(bounds)) & (F.get(table, n + s - 1) < F.col(column))
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda n, s: F.when(F.coalesce(less(n, s), F.lit(False)), n + s).otherwise(n))


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of one block, each headed by its size, compressed."""
    data = b"".join(len(a).to_bytes(8, "little") + a for a in (x.tobytes() for x in arrays))
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(blob: bytes, *kinds: str) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(np.frombuffer(data, kind, n // np.dtype(kind).itemsize, at + 8))
        at += 8 + n
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow column of strings and where each string starts (and the last one ends) in them; nulls
    are empty. Strings with long offsets are taken, too."""
    if column.null_count:
        column = column.fill_null("")
    long_ = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    starts = np.frombuffer(places, np.int64 if long_ else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if places else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data and len(column) else np.zeros(0, np.uint8), starts - starts[0]
