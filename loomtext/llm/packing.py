"""Best-fit packing by minimum bin slack.

Per bin the largest remaining length is set, then a bitset subset-sum program over the lengths still available (bit c
of a set: c tokens can be filled) finds the fullest feasible combination, which is removed. Only the number of pieces
of each length matters for this, so the driver works on that histogram (at most `capacity` entries, whatever the
number of documents), and a combination is taken at once as often as the counts allow: every step uses up some
length, or all bins that are left, so the number of programs does not grow with the documents.

Pieces then take their places by rank within their length. Ranks come from windows over `sub` salted parts of each
length, one for each million pieces of the most frequent length and 16 at least, so that a length that a third of all
pieces have is dealt to many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize
from .wordbpe import runs, word_bpe


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length to take so that they fill room as far as possible, lengths of at most room."""
    reach, marks = 1, []
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left:  # 1, 2, 4, .. copies and the rest make any number up to the count
            take = min(times, left)
            grown = (reach | reach << (take * length)) & mask
            if grown != reach:
                marks.append((length, take, reach))
                reach = grown
            left -= take
            times *= 2
            if reach & goal:
                break
        if reach & goal:
            break
    full, taken = reach.bit_length() - 1, {}
    for length, take, before in reversed(marks):
        if not before >> full & 1:
            taken[length] = taken.get(length, 0) + take
            full -= take * length
    return taken


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pieces of each length in a bin, number of such bins) until every piece has a bin."""
    counts, out = {x: n for x, n in histogram.items() if n}, []
    while counts:
        largest = max(counts)
        rest = counts | {largest: counts[largest] - 1}
        if not rest[largest]:
            del rest[largest]
        bin_ = fullest(rest, capacity - largest)
        bin_[largest] = bin_.get(largest, 0) + 1
        times = min(counts[x] // n for x, n in bin_.items())
        for x, n in bin_.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        out.append((bin_, times))
    return out


def pieces(docs: DataFrame, capacity: int = 4096, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's ids with the end id, cut where longer than capacity."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(path)
        for b in batches:
            keys, texts = b.column(0), b.column(1)
            for lo, hi in runs(texts):
                ids, sizes = encoder.encode_ended(texts.slice(lo, hi - lo))
                each = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(sizes)), each)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
                start = piece * capacity
                length = np.minimum(capacity, sizes[owner] - start)
                first = (np.cumsum(sizes) - sizes)[owner] + start
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crcs = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
                columns = [keys.take(pa.array(owner + lo)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(lean(run), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(
    docs: DataFrame, capacity: int = 4096, sub: int | None = None, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of the end id alone. Null ids and repeated rows are packed like others, each row
    by itself. An empty table gives an empty result. Other columns are not read.
    """
    cut = materialize(pieces(docs, capacity, path, id_col, text_col), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    sub = sub or max([16, *(n // 1_000_000 for n in histogram.values())])
    slots, sequence, used = [], 0, dict.fromkeys(histogram, 0)
    for bin_, times in minimum_bin_slack(histogram, capacity):
        at = 0
        for x in sorted(bin_, reverse=True):
            slots.append((x, used[x], bin_[x], times, sequence, at))
            used[x] += bin_[x] * times
            at += bin_[x] * x
        sequence += times
    by_length: dict[int, list[tuple]] = {x: [] for x in histogram}
    for x, *place_ in slots:
        by_length[x].append(place_)
    table = {x: [np.array(c, np.int64) for c in zip(*rows, strict=True)] for x, rows in by_length.items()}
    salted = cut.withColumn("__sub", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(sub)).cast("int"))
    before = Window.partitionBy("length").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    ahead = salted.groupBy("length", "__sub").agg(F.count("*").alias("n"))
    ahead = ahead.select("length", "__sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inner = Window.partitionBy("length", "__sub").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("nth", F.row_number().over(inner)).join(ahead, ["length", "__sub"])
    ranked = ranked.select(*cut.columns, (F.col("ahead") + F.col("nth") - 1).alias("rank"))
    names = [*cut.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            sequence_id, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length).tolist():
                rows = np.flatnonzero(length == x)
                first, per_bin, _, base, at = table[x]
                j = np.searchsorted(first, rank[rows], side="right") - 1
                k = rank[rows] - first[j]
                sequence_id[rows] = base[j] + k // per_bin[j]
                offset[rows] = at[j] + k % per_bin[j] * x
            columns = [b.column(c) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence_id), pa.array(offset)], names)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(lean(place), f"{fields}, sequence_id bigint, offset bigint")


def op7_minimum_bin_slack(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
