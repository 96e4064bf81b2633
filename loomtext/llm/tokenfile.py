"""Token ids in Simple-8b files.

A 64-bit word holds a selector in its low 4 bits and values of one width above it:

    selector 0: escape; selectors 1 to 14: as many values of 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30 or 60 bits as
    60 bits hold

An escape word is followed by one raw 64-bit value, for values of more than 60 bits. A block holds whole
documents, of `block` ids together or one longer one; its row in the file table says which file it belongs to, how many
ids of the file come before it, which documents it holds and how many ids each has, and, for about every `stride`-th word, its place and
the number of ids before it (offsets: the place of a word that begins a value or a run, never that of a raw value),
so that a reader decodes all words at once or a stretch of ids alone. A file holds one range of ids of documents; files
and the blocks in them ascend. They are rows of a Parquet table, because an executor reaches shared storage through
Spark's writers only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize, range_bounds, range_bucket
from .wordbpe import runs, word_bpe

#: Values per word and bits per value, by selector from 1 on; selector 0 is the escape.
WIDTHS = [(60 // b, b) for b in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)]
U64 = np.uint64


COUNTS = np.array([1, *(c for c, _ in WIDTHS)])
LIMITS = np.array([1 << b for _, b in WIDTHS], U64)
#: Narrowest selector of each value below 2**16.
NARROWEST = np.searchsorted(LIMITS, np.arange(1 << 16, dtype=U64), side="right").astype(np.uint8) + np.uint8(1)


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words that hold the values (any below 2**64), as many in each word as fit; the places of the words that are no
    raw values, and the place of the first value of each."""
    n = len(values)
    small = n > 0 and int(values.max()) < len(NARROWEST)
    least = NARROWEST[values] if small else np.searchsorted(LIMITS, values.astype(U64), side="right").astype(np.uint8) + np.uint8(1)
    values = values.astype(U64)
    choice = np.zeros(n, np.uint8)  # selector per start; wide ones first, so the last that fits packs most
    most = {1: least}  # greatest of so many values from each place on
    narrow = int(least.min()) if n else len(WIDTHS) + 1
    for s in range(len(WIDTHS), narrow - 1, -1):
        count = WIDTHS[s - 1][0]
        if count > n:
            break
        span = 1 << (count.bit_length() - 1)
        if span not in most:
            half = most[span >> 1] if span >> 1 in most else most.setdefault(span >> 1, np.maximum(most[span >> 2][: n - (span >> 1) + 1], most[span >> 2][span >> 2 :]))
            most[span] = np.maximum(half[: n - span + 1], half[span >> 1 :])
        whole = most[span]
        fits = np.maximum(whole[: n - count + 1], whole[count - span :]) <= s
        np.copyto(choice[: len(fits)], s, where=fits)
    # starts: a walk of 16 words at a time, the words between filled in for all strides at once
    step = np.minimum(np.append(np.arange(n) + COUNTS[choice], n), n)
    far = step
    for _ in range(4):
        far = far[far]
    heads, i = [], 0
    while i < n:
        heads.append(i)
        i = int(far[i])
    lanes = [np.array(heads, np.int64)]
    for _ in range(15):
        lanes.append(step[lanes[-1]])
    starts = np.stack(lanes, axis=1).ravel()
    starts = starts[starts < n]
    chosen = choice[starts]
    raw = chosen == 0
    at = np.arange(len(starts)) + np.cumsum(raw) - raw
    words = np.zeros(len(starts) + int(raw.sum()), U64)
    words[at[raw] + 1] = values[starts[raw]]
    for s, (count, bits) in enumerate(WIDTHS, 1):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            held = values[starts[rows, None] + np.arange(count)]
            shifts = (4 + bits * np.arange(count)).astype(U64)
            words[at[rows]] = np.bitwise_or.reduce(held << shifts, axis=1) | U64(s)
    return words, at, starts


def pack(values: np.ndarray) -> np.ndarray:
    """The words alone."""
    return packed(values)[0]


def unpack(words: np.ndarray) -> np.ndarray:
    """The values that pack() was given, all words of a selector at once."""
    selector = (words & U64(15)).astype(np.int64)
    at = np.arange(len(words))
    if (selector == 0).any():  # a raw value's low bits may look like a selector: walk from escape to escape
        head, i, sel = [], 0, selector.tolist()
        while i < len(sel):
            head.append(i)
            i += 1 + (sel[i] == 0)
        at = np.array(head, np.int64)
        selector = selector[at]
    counts = COUNTS[selector]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), U64)
    raw = selector == 0
    out[first[raw]] = words[at[raw] + 1]
    for s, (count, bits) in enumerate(WIDTHS, 1):
        rows = np.flatnonzero(selector == s)
        if len(rows):
            shifts = (4 + bits * np.arange(count)).astype(U64)
            out[first[rows, None] + np.arange(count)] = (words[at[rows], None] >> shifts) & U64((1 << bits) - 1)
    return out


def unpack_range(words: np.ndarray, places: np.ndarray, offsets: np.ndarray, start: int, end: int) -> np.ndarray:
    """The values from start to end (exclusive), of which only the words between two marks around them are decoded."""
    if end <= start or not len(offsets):
        return np.zeros(0, U64)
    a = int(np.searchsorted(offsets, start, side="right")) - 1
    z = int(np.searchsorted(offsets, end, side="left"))
    some = unpack(words[places[a] : places[z] if z < len(places) else len(words)])
    return some[start - offsets[a] : end - offsets[a]]


FILE_SCHEMA = "file int, block bigint, before bigint, doc_ids array<{id}>, sizes array<bigint>, n_ids bigint, places array<int>, offsets array<bigint>, words binary"


def write_files(
    docs: DataFrame, name: str = "tokens", files: int | None = None, block: int = 65_536, stride: int = 256,
    path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Encode every whole text, append the end id, write the files and return the table of their blocks.

    files: ranges of ids of documents, by default four for each shuffle partition. A null text counts as empty (the
    end id alone); null ids come first; rows of equal id are in order of their text. An empty table gives an empty
    table of blocks. Other columns are not read.
    """
    spark = docs.sparkSession
    files = files or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(docs, id_col, files)
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranged = named.withColumn("file", range_bucket("doc_id", bounds)).select("file", "doc_id", "text")
    dealt = ranged.repartition("file").sortWithinPartitions("file", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(path)
        file, number, before, n = None, 0, 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # ids of documents, their sizes, their token ids

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, before, held, n
            if n:
                keys, sizes, ids = zip(*held, strict=True)
                words, at, starts = packed(np.concatenate(ids))
                marks = np.unique(np.searchsorted(at, np.arange(0, len(words), stride)))
                marks = marks[marks < len(at)]
                row = [[file], [number], [before], [pa.concat_arrays(keys).to_pylist()], [np.concatenate(sizes)], [n], [at[marks]], [starts[marks]], [words.astype("<u8").tobytes()]]
                types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(keys[0].type), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names)
                number, before = number + 1, before + n
            held, n = [], 0

        names = ["file", "block", "before", "doc_ids", "sizes", "n_ids", "places", "offsets", "words"]
        for b in batches:
            numbers, keys, texts = b.column(0).to_pylist(), b.column(1), b.column(2)
            for lo, hi in runs(texts):
                ids, sizes = encoder.encode_ended(texts.slice(lo, hi - lo))
                ends = np.cumsum(sizes)
                first = 0  # of the documents that are not held yet

                def hold(last: int, lo=lo, ids=ids, sizes=sizes, ends=ends) -> None:
                    nonlocal first
                    if last > first:
                        held.append((keys.slice(lo + first, last - first), sizes[first:last], ids[ends[first] - sizes[first] : ends[last - 1]]))
                    first = last

                for i, (f, size) in enumerate(zip(numbers[lo:hi], sizes.tolist(), strict=True)):
                    if f != file or n + size > block:
                        hold(i)
                        yield from flush()
                        if f != file:
                            file, number, before = f, 0, 0
                    n += size
                hold(len(sizes))
        yield from flush()

    return materialize(dealt.mapInArrow(lean(run), FILE_SCHEMA.format(id=kind)), name)


def with_starts(table: DataFrame) -> DataFrame:
    """table with ahead, the ids of all files before: only the files' sizes, one row a file, are brought together."""
    per_file = table.groupBy("file").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.select("file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    return table.join(F.broadcast(starts), "file")


def read_range(table: DataFrame, start: int, end: int) -> DataFrame:
    """The ids from place start to place end (exclusive) of the whole collection, one row a block: start (place of the
    row's first id) and ids. Blocks outside are not read into a task, of the others only the words between the marks
    around the stretch are decoded."""
    first = F.col("ahead") + F.col("before")
    some = with_starts(table).where((first < end) & (first + F.col("n_ids") > start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                at, n, places, offsets, words = (b.column(c)[i] for c in range(5))
                at = at.as_py()
                lo, hi = max(0, start - at), min(n.as_py(), end - at)
                ids = unpack_range(np.frombuffer(words.as_buffer(), "<u8"), places.values.to_numpy(), offsets.values.to_numpy(), lo, hi)
                yield pa.RecordBatch.from_arrays([pa.array([at + lo]), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], ["start", "ids"])

    return some.select(first.alias("start"), "n_ids", "places", "offsets", "words").mapInArrow(run, "start bigint, ids array<bigint>")


def read_files(table: DataFrame) -> DataFrame:
    """Per document, from the blocks: doc_id, start (ids of all documents before it), n_tokens, ids_crc32. Each block
    is decoded where it is read."""
    kind = table.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                before, ids, sizes, words = (b.column(c)[i] for c in ("before", "doc_ids", "sizes", "words"))
                data = memoryview(unpack(np.frombuffer(words.as_buffer(), "<u8")).astype("<u4")).cast("B")
                n = np.array(sizes.as_py(), np.int64)
                at = np.cumsum(n) - n
                crcs = [zlib.crc32(data[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), n.tolist(), strict=True)]
                columns = [ids.values, pa.array(at + before.as_py()), pa.array(n), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = with_starts(table).select((F.col("before") + F.col("ahead")).alias("before"), "doc_ids", "sizes", "words")
    return placed.mapInArrow(lean(run), f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def op8_simple8b_files(spark, sf_dir: str) -> DataFrame:
    return read_files(write_files(spark.read.parquet(f"{sf_dir}/documents.parquet")))
