"""SimHash near-duplicates by anchor-point covering.

Fingerprints within `max_bits` differ in at most one bit of some block when the 64 bits are cut into
max_bits // 2 + 1 blocks. Per block a covering code gives the anchors: the perfect Hamming code of length 15 on the
first 15 bits (covering radius 1) times all words on the remaining bits. A fingerprint has its home at the one anchor
within radius 1 of its block and visits every anchor within radius 1 + 1 that a partner with at most one other bit
could have as its home. Homes are compared with visitors, anchor by anchor, so every linked pair meets.

Equal fingerprints are one class before any replication, so copies cost one row. An anchor's task emits only links
that join two sets of fingerprints not yet joined there (a spanning forest), never all pairs of a group, and no
group is capped. Components are found by alternating large-star and small-star steps on written edge tables.

Groups of a shingle similarity (`similar`): one fingerprint of 64 bits says too little about a Jaccard similarity of
0.8, at which about 9.7 bits differ. There a text has several fingerprints (lanes), each of its own hashes of the same
shingles, cut into the same blocks with the same anchors. A pair of the given similarity differs in each bit with a known
chance at most, so the number of lanes follows from the share of such pairs that may meet at no anchor. Pairs
that meet and whose fingerprints are near enough are then verified on their whole sets of shingles; only verified pairs
link.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, lean, materialize

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
HAMMING = 15


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; no words give 0."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return 0
    whole, n = b" ".join(parts), len(parts)
    if n <= words:
        return xxhash.xxh64_intdigest(whole, seed)
    sizes = np.fromiter(map(len, parts), np.int64, n) + 1
    ends = np.cumsum(sizes)
    begins = (ends - sizes)[: n - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(whole[a:b], seed) for a, b in zip(begins, (ends[words - 1 :] - 1).tolist(), strict=True)], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(((counts * 2 > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long), one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x.as_py(), words, seed) for x in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, fp bigint")


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each block."""
    m = max_bits // 2 + 1
    if 64 // m < HAMMING:
        raise ValueError("max_bits is at most 7: a block needs 15 bits for its code")
    ends = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def anchor_rows(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """anchor (block number above 48 bits of code word), fingerprint and home flag of every replica."""
    anchor, row, home = replicas(fps, blocks(max_bits))
    return anchor, fps[row], home


def replicas(fps: np.ndarray, cut: list[tuple[int, int]], first_block: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row and home flag of every replica of the fingerprints, whose blocks are numbered from first_block."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = np.arange(len(fps))
    for k, (first, width) in enumerate(cut, first_block):
        block = (fps >> np.uint64(first)) & np.uint64((1 << width) - 1)
        word, rest = (block & np.uint64(0x7FFF)).astype(np.int64), (block >> np.uint64(HAMMING)).astype(np.int64)
        syndrome = np.zeros(len(fps), np.int64)
        for i in range(HAMMING):
            syndrome ^= np.where(word >> i & 1, i + 1, 0)
        flip = lambda w, at: np.where(at > 0, w ^ (1 << np.maximum(at - 1, 0)), w)  # noqa: E731  at 0: no bit
        near = flip(word, syndrome)

        def add(code: np.ndarray, free: np.ndarray, keep, home: bool, k=k) -> None:
            anchor = (np.int64(k) << np.int64(48)) | (free << np.int64(HAMMING)) | code
            out.append((anchor[keep], rows[keep], np.full(len(anchor[keep]), home)))

        every = slice(None)
        add(near, rest, every, True)
        for bit in range(width - HAMMING):  # a partner that differs in a free bit
            add(near, rest ^ (1 << bit), every, False)
        for i in range(1, HAMMING + 1):  # a partner that differs in the code's bits: two flips reach its code word
            j = syndrome ^ i
            add(flip(word ^ (1 << (i - 1)), j), rest, (syndrome > 0) & (j > i), False)
    anchor, row, home = (np.concatenate(x) for x in zip(*out, strict=True))
    return anchor, row, home


def links_of(fps: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links between homes and all fingerprints of one anchor."""
    label = np.arange(len(fps))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rows = np.flatnonzero(home)
    step = max(1, 4_000_000 // len(fps))
    for at in range(0, len(rows), step):
        some = rows[at : at + step]
        near = np.bitwise_count(fps[some, None] ^ fps[None, :]) <= max_bits
        for r in np.flatnonzero(near.sum(axis=1) > 1):
            x = some[r]
            others = np.flatnonzero(near[r])
            others = others[label[others] != label[x]]
            if len(others):
                roots, one = np.unique(label[others], return_index=True)
                found.append((np.full(len(one), fps[x]), fps[others[one]]))
                label[np.isin(label, roots)] = label[x]
    return found


class Forest:
    """Union-find over the fingerprints that one task has linked; only links that join two sets are kept."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def joined(self, pairs: np.ndarray) -> list[tuple[int, int]]:
        out = []
        for a, b in pairs.tolist():
            x, y = self.root(a), self.root(b)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                out.append((a, b))
        return out


def compare_sorted(batches: Iterator[pa.RecordBatch], max_bits: int, small: int = 96) -> Iterator[pa.RecordBatch]:
    """Links of a partition whose rows come sorted by anchor. Groups of up to `small` rows are compared many at a
    time, larger ones each by itself; a group that spans batches is put together first."""
    forest = Forest()
    rest: tuple[np.ndarray, ...] | None = None

    def work(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.r_[starts, len(anchor)])
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for a, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist(), strict=True):
            pairs += links_of(fp[a : a + n], home[a : a + n], max_bits)
        group = np.repeat(np.arange(len(starts)), sizes)
        rows = np.flatnonzero(home & (sizes[group] <= small) & (sizes[group] > 1))
        for at in range(0, len(rows), 20_000):
            some = rows[at : at + 20_000]
            n = sizes[group[some]]
            left = np.repeat(some, n)
            right = np.repeat(starts[group[some]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            near = (np.bitwise_count(fp[left] ^ fp[right]) <= max_bits) & (left != right)
            pairs.append((fp[left[near]], fp[right[near]]))
        if pairs:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*pairs, strict=True))
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            if kept := forest.joined(both):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*kept, strict=True)], ["a", "b"])

    for b in batches:
        now = (b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy(zero_copy_only=False))
        if rest is not None:
            now = tuple(np.concatenate(x) for x in zip(rest, now, strict=True))
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))  # the last group may go on
        if cut:
            yield from work(*(x[:cut] for x in now))
        rest = tuple(x[cut:] for x in now)
    if rest is not None:
        yield from work(*rest)


def links(classes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp`, enough to connect all that are connected; written."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 20_000):
                anchor, fp, home = anchor_rows(fps[at : at + 20_000], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp.view(np.int64)), pa.array(home)], ["anchor", "fp", "home"])

    rows = classes.select("fp").mapInArrow(replicate, "anchor bigint, fp bigint, home boolean")
    dealt = rows.repartition("anchor").sortWithinPartitions("anchor")
    return materialize(dealt.mapInArrow(lambda it: compare_sorted(it, max_bits), "a bigint, b bigint"), "simhash-links")


def components(edges: DataFrame, hub: int = 1_000_000) -> DataFrame:
    """node and root (the smallest node of its component) for all nodes of edges (a, b). The neighbours of a node come
    together in a window; those of a hub, a node with more than `hub` of them, stay where they are and are sent the
    smallest, one row a hub."""

    def star(pairs: DataFrame, many: bool) -> DataFrame:
        least = F.least("u", F.min("v").over(Window.partitionBy("u")))
        if not many:
            return pairs.withColumn("m", least)
        hubs = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).where(F.col("n") > hub)
        found = hubs.select("u", F.least("u", "m").alias("m")).collect()
        if not found:
            return pairs.withColumn("m", least)
        tops = F.broadcast(pairs.sparkSession.createDataFrame(found, "u bigint, m bigint"))
        return pairs.join(tops, "u", "left_anti").withColumn("m", least).unionByName(pairs.join(tops, "u"))

    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "simhash-stars")
    mark, many = None, now.count() > hub
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both, many).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = star(large, many)
        small = down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        before, now = now, materialize(small.where("u <> v").distinct(), "simhash-stars")
        discard(before)
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark, many = seen, seen["n"] > hub


def near_duplicates(
    docs: DataFrame, words: int = 4, max_bits: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, fp (signed long), component_id (smallest id that links reach, itself included).

    Null and empty texts and texts of white space only have fingerprint 0 and are linked like others. A null id keeps
    its row and gets its component's smallest id (null if there is none). Repeated rows stay repeated. An empty table
    gives an empty result. Other columns are not read.
    """
    fps = materialize(fingerprints(docs, words, seed, id_col, text_col), "simhash-fps")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    nodes = components(links(classes, max_bits))
    linked = classes.join(nodes, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    tops = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    found = materialize(linked.join(tops, "root").select("fp", "component_id"), "simhash-components")
    return fps.join(found, "fp").select("doc_id", "fp", "component_id")


def normal(text: str | None) -> list[bytes]:
    """The text's words, A to Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def class_of(parts: list[bytes]) -> int:
    """64-bit hash of the words, signed."""
    h = xxhash.xxh64_intdigest(b" ".join(parts))
    return h - (1 << 64) if h >> 63 else h


def shingles(parts: list[bytes], words: int, seed: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words are one shingle, no words give none."""
    if not parts:
        return np.zeros(0, np.uint64)
    whole, n = b" ".join(parts), len(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1)
    starts = np.r_[0, ends[:-1]]
    digest = xxhash.xxh64_intdigest
    last = min(words, n) - 1
    return np.unique(np.array([digest(whole[a:b], seed) for a, b in zip(starts[: n - last].tolist(), (ends[last:] - 1).tolist(), strict=True)], np.uint64))


def lane_fingerprints(hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint a key, of the set of hashes: each bit is what most of the hashes have there, mixed with
    the key; the least hash breaks ties."""
    lanes = len(keys)
    if not len(hashes):
        return np.zeros(lanes, np.uint64)

    def mixed(h: np.ndarray) -> np.ndarray:
        x = (h[:, None] ^ keys) * np.uint64(0xFF51AFD7ED558CCD)
        return (x ^ (x >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)

    def bits(h: np.ndarray) -> np.ndarray:
        return np.unpackbits(mixed(h).view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little")

    votes = 2 * np.zeros(64 * lanes, np.int64)
    for at in range(0, len(hashes), 255):  # sums of 255 bits fit a byte
        votes += np.add.reduce(bits(hashes[at : at + 255]), axis=0, dtype=np.uint8)
    most = 2 * votes + bits(hashes[:1])[0] > len(hashes)
    return np.packbits(most, bitorder="little").view(np.uint64)


def disagreement(least: float) -> float:
    """Most that the chance of a bit to differ can be for sets of at least this Jaccard similarity: their angle over pi."""
    return math.acos(min(1.0, 2 * least / (1 + least))) / math.pi


def lane_plan(classes: int, least: float, miss: float) -> tuple[list[tuple[int, int]], int]:
    """Blocks of a lane and number of lanes, such that a pair at `least` meets at no anchor with a chance of at most
    miss. Blocks are wider for more classes, so that an anchor's share of them stays small."""
    count = 4 if classes <= 1 << 21 else 3 if classes <= 1 << 27 else 2
    ends = [64 * i // count for i in range(count + 1)]
    cut = [(a, b - a) for a, b in itertools.pairwise(ends)]
    p = disagreement(least)
    apart = math.prod(1 - ((1 - p) ** w + w * p * (1 - p) ** (w - 1)) for _, w in cut)
    return cut, max(2, math.ceil(math.log(miss) / math.log(apart)))


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of rows sorted by the first, cut only between its values."""
    rest: tuple[np.ndarray, ...] | None = None
    for b in batches:
        now = tuple(c.to_numpy(zero_copy_only=False) for c in b.columns)
        if rest is not None:
            now = tuple(np.concatenate(x) for x in zip(rest, now, strict=True))
        if not len(now[0]):
            continue
        if cut := int(np.searchsorted(now[0], now[0][-1])):
            yield tuple(x[:cut] for x in now)
        rest = tuple(x[cut:] for x in now)
    if rest is not None:
        yield rest


def near_rows(x: np.ndarray, y: np.ndarray, home: np.ndarray, most: int, cells: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of homes, some at a time, and which others differ from each in at most `most` bits of the two words."""
    rows = np.flatnonzero(home)
    step = max(1, cells // max(1, len(x)))
    for at in range(0, len(rows), step):
        some = rows[at : at + step]
        near = np.bitwise_count(x[some, None] ^ x) + np.bitwise_count(y[some, None] ^ y) <= most
        near[np.arange(len(some)), some] = False
        yield some, near


def pairs_met(batches: Iterator[pa.RecordBatch], most: int, crowd: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of classes, a < b, from rows sorted by anchor: anchor, cls, two words of fingerprint, home.

    A group in which no row has more than `crowd` near ones gives all near pairs. Of a denser one come links (dense)
    from the least class to each other of those that chains of near pairs connect, but for classes that the task has
    linked before: what they connect is verified in blocks."""
    found: list[np.ndarray] = []
    forest, held = Forest(), 0

    def rows(pairs: np.ndarray, dense: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), pa.array([dense] * len(pairs))], ["a", "b", "dense"])

    for anchor, cls, x, y, home in whole_groups(batches):
        x, y = x.view(np.uint64), y.view(np.uint64)
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(anchor)], strict=True):
            if z - a < 2 or not home[a:z].any():
                continue
            c, group, parts, dense = cls[a:z], (x[a:z], y[a:z], home[a:z]), [], False
            for some, near in near_rows(*group, most):
                if dense := bool(len(near) and near.sum(axis=1).max() > crowd):
                    break
                i, j = np.nonzero(near)
                parts.append((some[i], j))
            if dense:
                label = np.arange(z - a)
                for some, near in near_rows(*group, most):
                    for i, others in zip(some.tolist(), near, strict=True):
                        names = np.unique(label[others])
                        if len(names) and (len(names) > 1 or names[0] != label[i]):
                            label[np.isin(label, names)] = label[i]
                order = np.lexsort((c, label))
                heads = np.flatnonzero(np.diff(label[order], prepend=-1))
                parts = [(np.repeat(order[heads], np.diff(np.r_[heads, len(order)])), order)]
            i, j = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
            pairs = np.stack([np.minimum(c[i], c[j]), np.maximum(c[i], c[j])], axis=1)
            pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
            if dense and len(kept := forest.joined(pairs)):
                yield rows(np.array(kept, np.int64), True)
            elif not dense and len(pairs):
                found.append(pairs)
                held += len(pairs)
        if held > 200_000:
            yield rows(np.unique(np.concatenate(found), axis=0), False)
            found, held = [], 0
    if held:
        yield rows(np.unique(np.concatenate(found), axis=0), False)


def links_in_blocks(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that connect all classes of two blocks of a crowd whose sets have at least this similarity, from
    rows sorted by block (crowd, two numbers), side, cls and set: one of each two blocks, and of a block with itself."""

    def links(side: np.ndarray, cls: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        ends = np.cumsum(sizes)
        names, number = np.unique(np.concatenate(sets), return_inverse=True)
        first, forest, out = np.flatnonzero(side == 0), Forest(), []
        second = np.flatnonzero(side == 1) if (side == 1).any() else first
        begin = int(ends[second[0]] - sizes[second[0]])  # rows of a side stand together
        there, starts = number[begin : int(ends[second[-1]])], ends[second] - sizes[second] - begin
        mark = np.zeros(len(names), np.int32)
        for i in first.tolist():
            own = number[ends[i] - sizes[i] : ends[i]]
            mark[own] = 1
            both = np.add.reduceat(mark[there], starts)
            mark[own] = 0
            near = second[(both >= least * (sizes[i] + sizes[second] - both) - 1e-9) & (both > 0) & (second != i)]
            out += forest.joined(np.stack([np.full(len(near), cls[i]), cls[near]], axis=1))
        return out

    key, held = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            found = links(*(np.array([h[k] for h in held], np.int64) for k in (0, 1)), [np.frombuffer(h[2], np.uint64) for h in held])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    for b in batches:
        for *now, side, cls, grams in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            if now != key:
                yield from flush()
                key, held = now, []
            held.append((side, cls, grams))
    yield from flush()


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose sets of shingles have at least this Jaccard similarity; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                p, q = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = 0
                if min(len(p), len(q)) >= least * max(len(p), len(q)) - 1e-9:
                    both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(both > 0 and both >= least * (len(p) + len(q) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok, pa.bool_())), b.column(1).filter(pa.array(ok, pa.bool_()))], ["a", "b"])

    one = sets.select(F.col("cls").alias("a"), F.col("grams").alias("x"))
    other = sets.select(F.col("cls").alias("b"), F.col("grams").alias("y"))
    return materialize(pairs.join(one, "a").join(other, "b").select("a", "b", "x", "y").mapInArrow(lean(run), "a bigint, b bigint"), "simhash-verified")


def similar(docs: DataFrame, **options) -> DataFrame:
    """doc_id and component_id of classes_of_similar()."""
    return classes_of_similar(docs, **options).select("doc_id", "component_id")


def classes_of_similar(
    docs: DataFrame, words: int = 5, least: float = 0.8, miss: float = 0.006, seed: int = 42, crowd: int = 8, hot_rows: int = 50_000, most_sent: int = 1_000_000,
    block_rows: int = 1024, block_bytes: int = 16_000_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, cls (of its words) and component_id, the smallest id that links of pairs of at least this Jaccard
    similarity of word shingles reach, itself included. A pair at `least` meets at no anchor with a chance of at most
    about miss, a nearer one with less; a pair that links is verified on its whole sets. Classes in groups of many near
    ones are verified crowd by crowd, all pairs, so that work (not rows) grows with the square of a crowd. Null texts and texts of white
    space only are of one class. A null id gets its component's smallest id (null if there is none). Repeated rows stay
    repeated. An empty table gives an empty result. Other columns are not read.
    """
    text = F.col(text_col).cast("string")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    cut, lanes = lane_plan(docs.count(), least, miss)
    keys = np.random.default_rng(seed).integers(0, 2**63, lanes, dtype=np.uint64)
    # of two lanes: what a pair at `least` has, and 2.4 standard deviations; one that meets at an anchor, with a block
    # that differs in one bit at most, has more with a chance of 0.001
    p = disagreement(least)
    most = int(128 * p + 2.4 * math.sqrt(128 * p * (1 - p)))

    def lane_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                some = b.slice(at, 500)
                parts = [normal(x.as_py()) for x in some.column(1)]
                fps = [lane_fingerprints(shingles(p, words, seed), keys).tobytes() for p in parts]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(map(class_of, parts), pa.int64()), pa.array(fps, pa.binary())], ["doc_id", "cls", "fp"])

    def replicate(batches: Iterator[pa.RecordBatch], parts: dict[int, int]) -> Iterator[pa.RecordBatch]:
        names = np.array(sorted(parts), np.int64)
        shares = np.array([parts[a] for a in names.tolist()], np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 2_000):
                some = b.slice(at, 2_000)
                cls = some.column("cls").to_numpy()
                fps = np.frombuffer(b"".join(some.column("fp").to_pylist()), np.uint64).reshape(-1, lanes)
                for k in range(lanes):
                    anchor, row, home = replicas(fps[:, k], cut, k * len(cut))
                    if len(names):
                        slot = np.minimum(np.searchsorted(names, anchor), len(names) - 1)
                        n = np.where(names[slot] == anchor, shares[slot], 1)
                        every = np.repeat(np.arange(len(anchor)), n)
                        part = np.arange(len(every)) - np.repeat(np.cumsum(n) - n, n)
                        anchor, row, own = anchor[every], row[every], part == cls[row[every]].view(np.uint64) % n[every].astype(np.uint64)
                        anchor, home = anchor | part << np.int64(32), home[every] & own  # a code word has 32 bits at most
                    columns = [anchor, cls[row], fps[row, k].view(np.int64), fps[row, (k + 1) % lanes].view(np.int64), home]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["anchor", "cls", "x", "y", "home"])

    def grams(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # classes that this task has given
        for b in batches:
            for at in range(0, b.num_rows, 500):
                out: dict[int, bytes] = {}
                for x in b.column(b.schema.names.index("text")).slice(at, 500):
                    parts = normal(x.as_py())
                    cls = class_of(parts)
                    if cls not in done and (wanted is None or (k := int(np.searchsorted(wanted, cls))) < len(wanted) and wanted[k] == cls):
                        done.add(cls)
                        out[cls] = shingles(parts, words, seed).tobytes()
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.binary())], ["cls", "grams"])

    found = materialize(rows.mapInArrow(lean(lane_rows), f"doc_id {kind}, cls bigint, fp binary"), "simhash-lanes")
    classes = materialize(found.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("fp").alias("fp")), "simhash-lane-classes")
    some = classes.select("cls", "fp").where(F.col("fp") != F.lit(bytes(8 * lanes)))  # without words there is no shingle
    replica = "anchor bigint, cls bigint, x bigint, y bigint, home boolean"
    # a hot anchor's homes are dealt to several tasks, its visitors go to each; a 64th of the classes tells which are hot
    sampled = some.where(F.pmod(F.xxhash64("cls"), F.lit(64)) == 0).mapInArrow(lean(lambda it: replicate(it, {})), replica)
    hot = sampled.groupBy("anchor").agg((64 * F.count("*")).alias("n")).where(F.col("n") > 2 * hot_rows).orderBy(F.desc("n")).limit(100_000)
    parts = {r["anchor"]: min(1000, r["n"] // hot_rows) for r in hot.collect()}
    dealt = some.mapInArrow(lean(lambda it: replicate(it, parts)), replica).repartition("anchor").sortWithinPartitions("anchor")
    met = materialize(dealt.mapInArrow(lean(lambda it: pairs_met(it, most, crowd)), "a bigint, b bigint, dense boolean"), "simhash-met")
    pairs = materialize(met.where("NOT dense").select("a", "b").distinct(), "simhash-pairs")
    crowds = components(met.where("dense").select("a", "b"))

    def with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([class_of(normal(x.as_py())) for x in b.column(0)], pa.int64()), b.column(0)], ["cls", "text"])

    # the classes' sets are made where their texts are read: the classes' numbers travel with the tasks while they are
    # few; of more, each document's number and text meet them in a join
    need = pairs.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(crowds.select(F.col("node").alias("cls"))).distinct()
    need = materialize(need, "simhash-need")
    if need.count() <= most_sent:
        wanted = np.sort(np.array([r[0] for r in need.collect()], np.int64))
        made = rows.select("text").mapInArrow(lean(lambda it: grams(it, wanted)), "cls bigint, grams binary")
    else:
        named = rows.select("text").mapInArrow(lean(with_class), "cls bigint, text string")
        texts = named.join(need, "cls", "left_semi").groupBy("cls").agg(F.first("text").alias("text"))
        made = texts.select("text").mapInArrow(lean(lambda it: grams(it, None)), "cls bigint, grams binary")
    sets = materialize(made.groupBy("cls").agg(F.first("grams").alias("grams")), "simhash-sets")

    # a crowd is cut into blocks of so many classes or bytes, and each two blocks meet in one task
    members = materialize(crowds.join(sets, F.col("node") == F.col("cls")).select("root", "cls", "grams"), "simhash-crowds")
    n = F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum(F.octet_length("grams")) / block_bytes)).cast("int")
    cuts = members.groupBy("root").agg(n.alias("n"))
    placed = members.join(cuts, "root").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("n")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    low, high = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    blocks_ = placed.select("root", low, high, (F.col("own") > F.col("other")).cast("int").alias("side"), "cls", "grams")
    blocks_ = blocks_.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "side", "cls")
    dense = materialize(blocks_.mapInArrow(lean(lambda it: links_in_blocks(it, least)), "a bigint, b bigint"), "simhash-crowd-links")
    nodes = components(verified(pairs, sets, least).unionByName(dense))
    linked = classes.join(nodes, F.col("cls") == F.col("node"), "left").select("cls", "rep", F.coalesce("root", "cls").alias("root"))
    tops = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    ends = materialize(linked.join(tops, "root").select("cls", "component_id"), "simhash-lane-components")
    discard(classes, met, pairs, need, sets, members, dense)
    return found.join(ends, "cls").select("doc_id", "cls", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 5, least: float = 0.8, seed: int = 42, most_sent: int = 500_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of similar() rows: the one of the smallest id. Rows with a null id stay as they
    are, as do rows that repeat a kept id with the same words; columns are those of docs. Up to most_sent pairs of an id
    and a class that go are sent to the tasks."""
    found = classes_of_similar(docs, words=words, least=least, seed=seed, id_col=id_col, text_col=text_col)
    gone = materialize(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__id"), F.col("cls").alias("__gone")).distinct(), "simhash-gone")
    named = docs.withColumn("__cls", F.pandas_udf(lambda texts: texts.map(lambda t: class_of(normal(t))), "bigint")(F.col(text_col).cast("string")))
    few = gone.count() <= most_sent  # then texts stay where they are
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__cls") == F.col("__gone"))
    return named.join(F.broadcast(gone) if few else gone, same, "left_anti").drop("__cls")


def op9_simhash_anchors(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
