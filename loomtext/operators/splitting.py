"""Rows in order to files of bounded size, by the rule of one writer that never looks back: a row that doesn't fit opens
the next file.

Where a file starts depends on where all before it started, yet no task walks through all rows. Rows stand at byte
offsets and fall into blocks of offsets. A file that starts at a row ends where the bytes say, so from each row at which
a block can be entered (those within one file's size of its start) the block alone gives the last file that starts in
it, how many start on the way, and the row of a later block where the next one starts. These pointers are composed by
doubling; those on the path of the first row say where each block is really entered, and with which number."""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import removed, written

FILES_PER_FOLDER = 100
BLOCK_BYTES = 64 << 20


def offsets(rows: DataFrame) -> DataFrame:
    """rows (key, n, size; n unique) as n, start and end: the bytes of all rows before in the order of key and n, and of
    these with the row's own. Ranges of the order are summed each by itself; one row a range goes into their sum."""
    ranges = rows.select("key", "n", "size").repartitionByRange("key", "n").sortWithinPartitions("key", "n")
    placed = written(ranges.select("n", F.col("size").cast("long").alias("size"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "ranges")
    inside = placed.withColumn("end", F.sum("size").over(Window.partitionBy("part").orderBy("place")))
    sums = placed.groupBy("part").agg(F.sum("size").alias("size"))
    bases = sums.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))
    out = written(inside.join(bases, "part").select("n", (F.col("base") + F.col("end") - F.col("size")).alias("start"), (F.col("base") + F.col("end")).alias("end")), "offsets")
    removed(placed)
    return out


def following(starts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """Where the next file starts, for a file that starts at each of these rows: as far as whole rows fit, one at least."""
    reach = np.searchsorted(ends, starts + most, side="right") - 1
    return ends[np.maximum(reach, np.arange(len(starts)))]


def in_blocks(placed: DataFrame, most: int, size: int) -> DataFrame:
    """Rows by block; those within one file's size of a block's start stand in the block before, too."""
    block, inside = F.expr(f"start div {size}"), F.expr(f"start % {size}")
    both = F.when((inside < most) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    return placed.withColumn("block", F.explode(both))


def _sorted_block(block: int, rows: pd.DataFrame, most: int, size: int):
    """The rows of a block and of the edge after it in order; how many are its own; where files end."""
    rows = rows.sort_values("start", kind="stable")
    starts = rows["start"].to_numpy()
    return rows, starts, int(np.searchsorted(starts, (block + 1) * size)), following(starts, rows["end"].to_numpy(), most)


def entries(placed: DataFrame, most: int, size: int) -> DataFrame:
    """at, to, files: from each row where a block can be entered to the row of a later block where the next file starts
    (the end of all bytes, after the last), and how many files start from one to the other."""

    def run(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        block = int(key[0])
        _, starts, own, then = _sorted_block(block, rows, most, size)
        at = starts[:own][(starts[:own] - block * size < most) | (np.arange(own) == 0)]
        to, files = at.copy(), np.zeros(len(at), dtype=np.int64)
        inside = np.arange(len(at))
        while len(inside):  # all at once, a file a step: two files of a row are longer than most, so steps are few
            to[inside] = then[np.searchsorted(starts, to[inside])]
            files[inside] += 1
            inside = inside[(to[inside] < (block + 1) * size) & (to[inside] <= starts[-1])]
        return pd.DataFrame({"at": at, "to": to, "files": files})

    return in_blocks(placed, most, size).groupBy("block").applyInPandas(run, "at long, to long, files long")


def entered(pointers: DataFrame, end: int) -> DataFrame:
    """at and number: the rows where files really enter blocks, and the number of the file that starts there."""
    jumps = [pointers]
    while (first := jumps[-1].where("at = 0").first()) and first["to"] < end:
        a, b = jumps[-1], jumps[-1].select(F.col("at").alias("to"), F.col("to").alias("then"), F.col("files").alias("more"))
        jumps.append(written(a.join(b, "to", "left").select("at", F.coalesce("then", "to").alias("to"), (F.col("files") + F.coalesce("more", F.lit(0))).alias("files")), "jumps"))
    spark = pointers.sparkSession
    path = spark.range(1).select(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("number"))
    for jump in reversed(jumps[:-1]):
        before = path
        on = jump.join(before, "at").where(F.col("to") < end).select(F.col("to").alias("at"), (F.col("number") + F.col("files")).alias("number"))
        path = written(before.unionByName(on), "path")
        removed(before)
    removed(*jumps[1:])
    return path


def file_numbers(rows: DataFrame, most: int, block_bytes: int | None = None) -> DataFrame:
    """n, start (offset in all bytes), file (from 0), for rows of key, n and size (n unique; size in bytes, above 0). Rows
    are in the order of key, equal keys by n; null keys come first. A file holds as many rows as fit into `most`; a row
    that is longer has a file of its own. No rows give no rows."""
    size = max(block_bytes or BLOCK_BYTES, 4 * most)
    placed = offsets(rows)
    end = placed.agg(F.max("end")).first()[0] or 0
    pointers = written(entries(placed, most, size), "entries")
    path = entered(pointers, end)
    reached = path.join(pointers, "at").where(F.expr(f"to div {size} > at div {size}")).select("to", (F.col("number") + F.col("files") - 1).alias("before"), F.explode(F.sequence(F.expr(f"at div {size} + 1"), F.expr(f"to div {size}"))).alias("block"))
    first = path.where("at = 0").select(F.lit(0).cast("long").alias("to"), F.lit(-1).cast("long").alias("before"), F.lit(0).cast("long").alias("block"))
    known = written(reached.where(F.col("block") * size < end).unionByName(first).select("block", "to", "before"), "known")

    def run(key: tuple[Any, ...], rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """Numbers of a block's rows: that of the file before, and one more from each start on. Where no file starts
        in the block (its rows fit into one that is open) `to` lies behind it."""
        block = int(key[0])
        rows, starts, own, then = _sorted_block(block, rows, most, size)
        if not own:
            return pd.DataFrame({"n": [], "start": [], "file": []})
        opened, at = np.zeros(own, dtype=np.int64), int(known["to"].iloc[0])
        while at <= starts[own - 1]:
            i = int(np.searchsorted(starts, at))
            opened[i] = 1
            at = int(then[i])
        return pd.DataFrame({"n": rows["n"].to_numpy()[:own], "start": starts[:own], "file": known["before"].iloc[0] + np.cumsum(opened)})

    groups = in_blocks(placed, most, size).groupBy("block").cogroup(known.groupBy("block"))
    out = written(groups.applyInPandas(run, "n long, start long, file long"), "files")
    removed(placed, pointers, path, known)
    return out


def folder_name(file):
    """AA for the first hundred files, AB, .. ZZ, and with a letter more from BAA on, so that no two folders share a name."""
    folder = F.floor(F.col(file) / FILES_PER_FOLDER)
    letter = lambda power: F.char(F.lit(65) + F.floor(folder / 26**power) % 26)
    more = [F.when(folder >= 26**power, letter(power)).otherwise("") for power in range(6, 1, -1)]
    return F.concat(*more, letter(1), letter(0))


def base_name(file):
    return F.concat(F.lit("wiki_"), F.lpad((F.col(file) % FILES_PER_FOLDER).cast("string"), 2, "0"))
