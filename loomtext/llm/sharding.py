"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix (native).

1. The rows' slim keys are written once with the number of the input partition they came from.
2. The driver draws how many rows each input partition sends to each shard: a random matrix with the partition sizes
   as row sums and the exact shard sizes as column sums, drawn by successive hypergeometric variates. It has
   `partitions` x `shards` entries: input partitions are folded to some thousands of classes at most.
3. Each input partition permutes its rows and deals consecutive runs of the drawn lengths to the shards.
4. After the exchange each shard permutes again, in `sub` ranges of a second random key, so that no task has to hold
   a whole shard. Classes and ranges grow with the rows, some million rows each.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """An exact hypergeometric variate by inversion, for populations of any size: probabilities relative to the mode,
    over all values within 12 standard deviations (what lies beyond has less weight than a double resolves)."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    mode = (draws + 1) * (good + 1) // (total + 2)
    width = 40 + int(12 * math.sqrt(draws * (good / total) * (bad / total) + 1))
    first, last = max(low, mode - width), min(high, mode + width)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Row sums are the partition sizes, column sums the shard sizes, which are at most one apart."""
    rng, total = np.random.default_rng(seed), sum(rows)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for n in rows:
        line, left, free = [], n, sum(room)
        for s in range(shards):
            free -= room[s]
            line.append(hypergeometric(rng, room[s], free, left))
            left -= line[-1]
        room = [a - b for a, b in zip(room, line, strict=True)]
        matrix.append(line)
    return matrix


def assign_shards(
    docs: DataFrame, shards: int = 24, seed: int = 20, partitions: int | None = None, sub: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, size (UTF-8 bytes of the text plus 8), text_crc32, shard, slot (gapless in a shard).

    Null ids are ordinary values; a null text counts as empty (size 8, crc of no bytes). Repeated rows are placed one
    by one, each with a slot of its own. An empty table gives an empty result. Other columns are not read.
    Input partitions are folded to `partitions` classes: by default one for each million rows, from 256 to 4096.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
    )
    slim = materialize(slim.withColumn("lot", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")), "shard-rows")
    rows = slim.count()
    partitions = partitions or min(4096, max(256, rows // 1_000_000))
    sub = sub or max(64, rows // (1_000_000 * shards))
    slim = slim.withColumn("part", F.pmod("part", F.lit(partitions)))
    counts = {r["part"]: r["n"] for r in slim.groupBy("part").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return slim.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    parts = sorted(counts)
    matrix = communication_matrix([counts[p] for p in parts], shards, seed)
    runs = ", ".join(
        f"({p}, array({', '.join(f'{x}L' for x in np.cumsum(line).tolist())}))" for p, line in zip(parts, matrix, strict=True)
    )
    runs = spark.sql(f"SELECT * FROM VALUES {runs} AS t(part, ends)")
    within = Window.partitionBy("part").orderBy("lot", "doc_id", "text_crc32", "size")
    dealt = slim.withColumn("nth", F.row_number().over(within)).join(F.broadcast(runs), "part")
    dealt = dealt.select(
        "doc_id", "size", "text_crc32",
        F.size(F.filter("ends", lambda e: e < F.col("nth"))).alias("shard"),
        F.xxhash64(F.lit(seed + 1), "doc_id", "text_crc32", "size", "nth").alias("lot"),
    )
    dealt = materialize(dealt.withColumn("sub", F.pmod(F.shiftright("lot", 8), F.lit(sub)).cast("int")), "shard-dealt")
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "sub").agg(F.count("*").alias("n"))
    offsets = offsets.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("shard", "sub").orderBy("lot", "doc_id", "text_crc32", "size")
    return (
        dealt.withColumn("nth", F.row_number().over(inner))
        .join(F.broadcast(offsets), ["shard", "sub"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("nth") - 1).alias("slot"))
    )


def exchange(docs: DataFrame, assigned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with their shard and slot, in ranges by shard and slot, so that a shard is as many tasks as its
    size asks for. A row finds its place by its id, text checksum and size, null ids among them; rows that are equal in
    these take theirs in any order. Columns of docs named shard or slot are replaced."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = {"__id": F.col(id_col), "__crc": F.crc32(text.cast("binary")), "__size": (F.octet_length(text) + 8).cast("long")}
    nth = F.row_number().over(Window.partitionBy("__id", "__crc", "__size").orderBy(F.lit(0)))
    rows = docs.drop("shard", "slot").withColumns(key).withColumn("__nth", nth)
    names = {"doc_id": "__id", "text_crc32": "__crc", "size": "__size"}
    place = assigned.withColumnsRenamed(names).withColumn("__nth", nth).select("__id", "__crc", "__size", "__nth", "shard", "slot")
    place = place.withColumnsRenamed({c: f"{c}_" for c in names.values()} | {"__nth": "__nth_"})
    same = F.lit(True)
    for c in (*names.values(), "__nth"):
        same &= F.col(c).eqNullSafe(F.col(f"{c}_"))
    out = rows.join(place, same).select(*[c for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")
    return out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")


def op3_hypergeometric_shards(spark, sf_dir: str) -> DataFrame:
    out = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
