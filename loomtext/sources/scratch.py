"""Tables that cut a lineage: written to the folder that driver and executors share, and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a new temporary folder is made and set for the session if all runs on
    one machine; on a cluster that is an error."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="loomtext-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of the shared folder: a lost executor costs a reread, not the work before it."""
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}/loomtext/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["written_to"] = path
    return out


def union(parts: list[DataFrame]) -> DataFrame:
    """All rows of written tables; removed() takes it, too."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if len(parts) > 1:
        out.__dict__["parts"] = parts
    return out


def removed(*tables: DataFrame | None) -> None:
    """Remove what written() wrote for these tables; only for those that no result still reads."""
    for df in [x for t in tables if t is not None for x in t.__dict__.get("parts", [t])]:
        if (path := df.__dict__.get("written_to")):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
