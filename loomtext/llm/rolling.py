"""Rolling exact medians and median absolute deviations (wavelet matrix over haloed chunks).

Rows of one series, in order of time, are cut into blocks of whole hours; a row also goes, as a halo, to the next block if it
may stand in a window there. A block's rows come to their task in order of time, sorted by Spark, and are answered chunk by
chunk: each chunk is the rows to answer and those of the window before them. Per chunk the values' ranks, in order of time,
make a wavelet matrix (numpy): for each bit of the ranks, from the highest, a count of ones up to each place. A window is a
stretch of places, so the medians of all its rows are one batched descent, and the radius that holds half of a window is
bisected for all rows by batched range counts.

What a task holds follows the rows of one window, not those of a series or a block: some 130 bytes for each of twice as
many rows as the densest window has, 200,000 at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean

HOUR = 3_600_000_000
ANSWER = "n long, median2 long, mad4 long, far boolean"


class Wavelet:
    """Ranks in order of place, for batched questions about stretches [left, right) of places."""

    def __init__(self, ranks: np.ndarray, bits: int) -> None:
        self.bits, n = bits, len(ranks)
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for b in reversed(range(bits)):
            bit = (ranks >> b & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            ranks = np.concatenate([ranks[~bit], ranks[bit]])

    def least(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th rank (from 0) of each stretch in order; 0 <= k < right - left."""
        out = np.zeros(len(k), np.int32)
        for b, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros, strict=True):
            a, z = ones.take(left), ones.take(right)
            here = right - left - z + a  # those whose bit is 0
            up = k >= here
            k = np.where(up, k - here, k)
            left, right = np.where(up, zeros + a, left - a), np.where(up, zeros + z, right - z)
            out |= up.astype(np.int32) << b
        return out

    def below(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """How many ranks of each stretch are less than the given one, which may be as high as 2 ** bits."""
        out = np.where(rank >> self.bits > 0, right - left, 0).astype(np.int32)
        right = np.where(rank >> self.bits > 0, left, right)
        for b, ones, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros, strict=True):
            a, z = ones.take(left), ones.take(right)
            up = (rank >> b & 1).astype(bool)
            out += np.where(up, right - left - z + a, 0)
            left, right = np.where(up, zeros + a, left - a), np.where(up, zeros + z, right - z)
        return out


def half_radius(tree: Wavelet, values: np.ndarray, left: np.ndarray, right: np.ndarray, median2: np.ndarray) -> np.ndarray:
    """Doubled median of |2 * value - median2| over each stretch of two rows or more. values: those of the ranks, ascending.

    The radius of the lower middle one is bisected. A first bracket comes from ranks: a run of as many values in order
    as must be inside holds that many, and what lies strictly between two values one further apart is fewer."""
    n = right - left
    need = (n + 1) // 2  # so many lie within the radius of the lower middle one
    at = lambda k: values.take(tree.least(left, right, k))
    first = n // 4
    outer = np.maximum(median2 - 2 * at(first), 2 * at(first + need - 1) - median2)
    inner = np.maximum(np.minimum(median2 - 2 * at(first), 2 * at(np.minimum(first + need, n - 1)) - median2) - 1, -1)
    inner = np.where(first + need < n, inner, -1)

    def within(i: np.ndarray, radius: np.ndarray) -> np.ndarray:
        low = np.searchsorted(values, -((radius - median2[i]) // 2), "left").astype(np.int32)
        high = np.searchsorted(values, (median2[i] + radius) // 2, "right").astype(np.int32)
        return tree.below(left[i], right[i], high) - tree.below(left[i], right[i], low)

    low, high = np.minimum(inner, outer - 1), outer  # within(low) < need <= within(high)
    held = np.full(len(n), -1, np.int32)
    while len(open_ := np.flatnonzero(high - low > 1)):
        middle = (low[open_] + high[open_]) // 2
        count = within(open_, middle)
        enough = count >= need[open_]
        high[open_[enough]], held[open_[enough]] = middle[enough], count[enough]
        low[open_[~enough]] = middle[~enough]
    unknown = np.flatnonzero(held < 0)
    held[unknown] = within(unknown, high[unknown])
    # an even window's upper middle one is as far, or the next farther on either side
    upper = high.copy()
    more = np.flatnonzero((n % 2 == 0) & (held <= need))
    if len(more):
        m, r, a, z = median2[more], high[more], left[more], right[more]
        under = tree.below(a, z, np.searchsorted(values, -((r - m) // 2), "left").astype(np.int32))
        over = tree.below(a, z, np.searchsorted(values, (m + r) // 2, "right").astype(np.int32))
        far = np.int64(2**62)
        down = np.where(under > 0, m - 2 * values.take(tree.least(a, z, np.maximum(under - 1, 0))), far)
        up = np.where(over < z - a, 2 * values.take(tree.least(a, z, np.minimum(over, z - a - 1))) - m, far)
        upper[more] = np.minimum(down, up)
    return high + upper


def answers(key: np.ndarray, value: np.ndarray, known: np.ndarray, asked: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """n, median2, mad4 and whether far of the asked rows, each over the rows with known values whose key is at least its
    own less width and at most its own; keys ascend. Where n < 2 only n has a meaning."""
    keys, held = key[known], value[known]
    values, ranks = np.unique(held, return_inverse=True)
    tree = Wavelet(ranks.astype(np.int32), max(1, int(len(values) - 1).bit_length()))
    mine = key[asked]
    left, right = np.searchsorted(keys, mine - width, "left").astype(np.int32), np.searchsorted(keys, mine, "right").astype(np.int32)
    n = right - left
    some = np.flatnonzero(n >= 2)
    a, z, m = left[some], right[some], n[some]
    median2, mad4, far = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.zeros(len(n), bool)
    if len(some):
        median2[some] = values.take(tree.least(a, z, (m - 1) // 2)) + values.take(tree.least(a, z, m // 2))
        mad4[some] = half_radius(tree, values, a, z, median2[some])
        far = 2 * np.abs(2 * value[asked] - median2) > 3 * mad4
    return n, median2, mad4, far


class Stream:
    """Rows of blocks in order, answered as soon as all rows of their windows are there. A row is held until no window
    that is still to be answered reaches it."""

    def __init__(self, width: int, block: int, rows: int) -> None:
        self.width, self.block, self.rows = width, block, rows
        self.span = block + 2 * width  # keys of one block, so that windows never reach into another
        self.units, self.last = -1, None
        self.parts: list[tuple] = []
        self.waiting = self.held = 0

    def add(self, b: pa.RecordBatch) -> None:
        series, block = b.column("series").to_numpy(zero_copy_only=False), b.column("block").to_numpy(zero_copy_only=False)
        if not len(block):
            return
        change = np.ones(len(block), bool)
        change[1:] = (block[1:] != block[:-1]) | (series[1:] != series[:-1])
        change[0] = (series[0], block[0]) != self.last
        unit = self.units + np.cumsum(change)
        self.units, self.last = int(unit[-1]), (series[-1], block[-1])
        time = b.column("time").to_numpy(zero_copy_only=False)
        value = b.column("value")
        known = ~np.asarray(value.is_null())
        key = unit * self.span + time - block * self.block + self.width
        own = b.column("own").to_numpy(zero_copy_only=False)
        self.parts.append((key, value.fill_null(0).to_numpy(zero_copy_only=False), known, own, [b.column("rest")]))
        self.waiting += len(key)

    def drain(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """Answers to the rows before the last key, or to all; those need nothing that is still to come."""
        if not self.parts or not last and self.waiting < max(self.rows, self.held):
            return
        key, value, known, own = (np.concatenate([p[i] for p in self.parts]) for i in range(4))
        rest = pa.chunked_array([c for p in self.parts for c in p[4]]).combine_chunks()
        done = len(key) if last else int(np.searchsorted(key, key[-1], "left"))
        if done > self.held:
            asked = np.flatnonzero(own[:done])
            n, median2, mad4, far = answers(key, value, known, asked, self.width)
            few, mine = n < 2, rest.take(pa.array(asked))
            none = few | ~known[asked]
            columns = [pa.array(n.astype(np.int64)), pa.array(median2, mask=few), pa.array(mad4, mask=few), pa.array(far, mask=none)]
            if len(asked):
                yield pa.RecordBatch.from_arrays([*mine.flatten(), *columns], [*mine.type.names, "n", "median2", "mad4", "far"])
        if last:
            self.parts = []
            return
        keep = int(np.searchsorted(key, key[done] - self.width, "left"))
        own[:done] = False
        cut = [x[keep:].copy() for x in (key, value, known, own)]
        self.parts = [(*cut, [pa.concat_arrays([rest.slice(keep)])])]
        self.held, self.waiting = done - keep, len(key) - done


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a timestamp; of one without a zone, by its own calendar."""
    if df.schema[column].dataType.typeName() == "timestamp":
        return F.unix_micros(column)
    past = F.col(column) - F.lit("1970-01-01").cast("timestamp_ntz")
    return (past.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("long")


def rolling_medians(
    rows: DataFrame, time: str, value: str, series: str, carry: list[str], minutes: int = 60, most_hours: int = 12,
    block_rows: int = 2_000_000, chunk_rows: int = 100_000,
) -> DataFrame:
    """The columns `carry` of rows with n, median2, mad4 and far over the window of the row's series from `minutes`
    before its time to its time, ends included.

    value is a whole number; null stands in no window (n may be 0) and is not far or near. series may be null, which is
    one more series. Rows with null time are dropped, equal rows all count; an empty table gives an empty result. Other
    columns are not read, whatever their names. Values beyond 2 ** 58 either way are not taken (an error).
    most_hours, block_rows and chunk_rows decide how rows are dealt, not the result: a block has most_hours or, where the
    densest hour of a series has more than block_rows / most_hours rows, as many hours as block_rows allow (one, and no
    less than the window, at least). Only that one count reaches the driver.
    """
    width = minutes * 60_000_000
    rest = F.struct(*[F.col(c) for c in carry]).alias("rest")
    named = rows.select(F.col(series).cast("string").alias("series"), micros(rows, time).alias("time"), F.col(value).cast("long").alias("value"), rest).where("time IS NOT NULL")
    dense = named.groupBy("series", F.floor(F.col("time") / HOUR).alias("hour")).count().agg(F.max("count")).first()[0] or 0
    hours = max(1, -(-width // HOUR), min(most_hours, block_rows // max(1, dense)))
    block = hours * HOUR
    own, halo = (F.expr(f"cast((time + {w} - pmod(time + {w}, {block}L)) div {block}L as long)") for w in (0, width))
    places = F.when(own == halo, F.array(own)).otherwise(F.array(own, halo))
    dealt = named.withColumn("block", F.explode(places)).withColumn("own", F.col("block") == own)
    dealt = dealt.repartition("series", "block").sortWithinPartitions("series", "block", "time")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(width, block, chunk_rows)
        for b in batches:
            stream.add(b)
            yield from stream.drain()
        yield from stream.drain(last=True)

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    return dealt.mapInArrow(lean(run), f"{kinds}, {ANSWER}")


def cents(value: Column) -> Column:
    """Hundredths, rounded; null for null, for what is no number, and from 5e15 on, where a double has no hundredths."""
    return F.when(F.abs(value) < 5e15, F.floor(100 * value + 0.5).cast("long"))


def once(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row of each key (null is one), with the least values of the columns where its rows differ."""
    return rows.groupBy(key).agg(F.min(F.struct(*columns)).alias("__row")).select(key, "__row.*")


def op11_rolling_medians(spark, sf_dir: str) -> DataFrame:
    clicks = spark.read.parquet(f"{sf_dir}/clicks.parquet").where("ts IS NOT NULL")
    clicks = once(clicks.select("click_id", "ts", "kind", cents(F.col("value")).alias("cents")), "click_id", ["ts", "kind", "cents"])
    return rolling_medians(clicks, "ts", "cents", "kind", ["click_id", "kind"])
