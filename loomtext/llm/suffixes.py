"""Removal of repeated passages by column-wise multi-document construction of suffix order.

What repeats is found by inserting one symbol per document and round: round c puts the symbol before each suffix in
front of it, in the order the suffixes have so far (that row of symbols is the round's part of the collection's
Burrows-Wheeler transform), sorts it stably, and derives the new longest common prefixes from the old ones. Suffixes
whose neighbours share `length` symbols are equal windows; all but the first of each are marked.

At scale not all suffixes need meet. Each window of `length` bytes picks an anchor, the least k-gram in it by hash;
equal windows pick equal anchors at equal places. So:

1. Chunks of documents send the distinct hashes of their anchors to buckets and learn which occur elsewhere.
2. Each occurrence of a repeated anchor gives a context, the bytes of all windows that picked it. Contexts that a chunk
   holds more than once leave it once (the first occurrence; later ones repeat it whole). A bucket's contexts, aligned
   at their anchors, are the collection: equal windows stand in the same column, so each round orders one column's
   suffixes. Columns, order and prefixes are read and written front to back; a bucket is small, so these sequential
   files are arrays in the task's memory and no local folder is needed.
3. The marks return to the chunks, which cut the bytes.

An anchor with very many different contexts (a common line shorter than a window) would crowd one bucket: its windows
are sent one by one, dealt by their own hash. Nothing is capped, and documents of any length are taken whole, a
very long one in overlapping parts. The number of buckets follows the bytes of the collection. Hashes only choose
what is compared: bytes are removed where bytes are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import expand, lean, materialize, squeeze

U64 = np.uint64
LENGTH, GRAM = 100, 40
#: Bytes that are hashed at once; longer texts are cut, parts overlap by a window less a byte.
PART = 1_000_000
#: Bytes of text for each bucket.
BUCKET_BYTES = 4_000_000
#: More distinct contexts of one anchor than this are dealt window by window.
CROWD = 4096


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Rolling:
    """64-bit hashes of any spans of a buffer: differences of one prefix sum, brought to a common power of the base."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)
    VALUES = np.random.default_rng(100).integers(1, 1 << 63, 256, dtype=U64)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data) + 1
        self.down = self.powers(self.INVERSE, n)
        self.sums = np.zeros(n, U64)
        np.cumsum(self.VALUES[data] * self.powers(self.BASE, n)[:-1], out=self.sums[1:])

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, U64)
        done = 1
        while done < n:
            more = min(done, n - done)
            out[done : done + more] = out[:more] * U64(pow(base, done, 1 << 64))
            done += more
        return out

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


class Anchored:
    """Anchors and contexts of some texts: per occurrence the anchor's place, the first and last window that picked it
    (places in the joined buffer), the text's number, and hashes of the anchor and of the whole context."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> None:
        self.length = length
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        parts = []
        first = 0
        while first < len(texts):  # pieces, so that temporary arrays stay small: whole texts, or windows of a long one
            last = max(first + 1, int(np.searchsorted(self.ends, (self.ends[first - 1] if first else 0) + PART)))
            begin, end = int(self.ends[first] - self.sizes[first]), int(self.ends[last - 1])
            for at in range(begin, max(begin + 1, end), PART):
                parts.append(self.part(first, last, at, min(end, at + PART + length - 1), gram))
            first = last
        columns = zip(*parts, strict=True) if parts else [[np.zeros(0, np.int64)]] * 4 + [[np.zeros(0, U64)]] * 2
        self.anchor, self.first, self.last, self.text, self.hash, self.whole = (np.concatenate(c) for c in columns)

    def part(self, a: int, z: int, begin: int, end: int, gram: int) -> tuple[np.ndarray, ...]:
        """Of the windows within the bytes begin to end, which lie in texts a to z."""
        n = self.length
        data = self.data[begin:end]
        windows = len(data) - n + 1
        if windows < 1:
            return tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (U64,) * 2)
        rolling = Rolling(data)
        at = np.arange(len(data) - gram + 1)
        hashes = rolling.of(at, at + gram)
        least = (hashes & U64(0xFFFFFFFF00000000)) | at.astype(U64)
        width, span = 1, n - gram + 1
        while width < span:
            step = min(width, span - width)
            least = np.minimum(least[: len(least) - step], least[step:])
            width += step
        text = np.full(windows, a) if z - a == 1 else np.repeat(np.arange(a, z), self.sizes[a:z])[:windows]
        inside = np.flatnonzero(np.arange(begin + n, begin + n + windows) <= self.ends[text])
        picked, text = (least[inside] & U64(0xFFFFFFFF)).astype(np.int64), text[inside]
        new = np.flatnonzero((np.diff(picked, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
        first, last = inside[new], inside[np.r_[new[1:], len(inside)] - 1] if len(new) else inside[:0]
        anchor = picked[new]
        whole = rolling.of(first, last + n) ^ mixed((anchor - first).astype(U64) << U64(32) | (last - first).astype(U64))
        return anchor + begin, first + begin, last + begin, text[new], hashes[anchor], whole

    def covered(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The union of spans as ascending maximal runs, none of which goes on in the next text."""
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], np.maximum.accumulate(end[order]) if len(order) else end
        text = np.searchsorted(self.ends, begin, side="right")
        new = np.r_[True, (begin[1:] > end[:-1]) | (text[1:] != text[:-1])] if len(begin) else np.zeros(0, bool)
        heads = np.flatnonzero(new)
        return begin[heads], end[np.r_[heads[1:], len(end)] - 1] if len(heads) else end

    def bytes_of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        total = int(size.sum())
        return self.data[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(total)]


def distinct_anchors(a: Anchored) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, how many distinct contexts each has here, occurrences of each."""
    order = np.lexsort((a.whole, a.hash))
    h, w = a.hash[order], a.whole[order]
    new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
    other = new | np.r_[True, w[1:] != w[:-1]] if len(h) else new
    starts = np.flatnonzero(new)
    if not len(starts):
        return h, np.zeros(0, np.uint32), np.zeros(0, np.int64)
    contexts = np.add.reduceat(other.astype(np.int64), starts)
    return h[starts], contexts.astype(np.uint32), np.diff(np.r_[starts, len(h)])


class Contexts:
    """What a chunk sends to the buckets, in an order that each pass makes alike."""

    def __init__(self, a: Anchored, ids: np.ndarray, codes: np.ndarray, buckets: int) -> None:
        """codes: of the sorted distinct hashes; 0 occurs nowhere else, 1 does, 2 has a crowd of contexts."""
        hashes, _, times = distinct_anchors(a)
        slot = np.searchsorted(hashes, a.hash)
        code = np.where(codes[slot] > 0, codes[slot], times[slot] > 1) if len(slot) else np.zeros(0, np.int64)
        one, many = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        n = a.last[many] - a.first[many] + 1
        many = np.repeat(many, n)
        start = a.first[many] + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.anchor = np.concatenate([a.anchor[one], a.anchor[many]])
        self.first = np.concatenate([a.first[one], start])
        self.last = np.concatenate([a.last[one], start])
        self.text = np.concatenate([a.text[one], a.text[many]])
        alone = np.empty(len(many), U64)
        for at in range(0, len(many), 10_000):
            some = start[at : at + 10_000]
            places = a.length * np.arange(len(some))
            rolling = Rolling(a.bytes_of(some, np.full(len(some), a.length)))
            alone[at : at + 10_000] = rolling.of(places, places + a.length) ^ mixed((a.anchor[many[at : at + 10_000]] - some).astype(U64))
        key = np.concatenate([a.hash[one], alone])
        whole = np.concatenate([a.whole[one], alone])
        order = np.lexsort((self.anchor, ids[self.text], whole))
        new = np.r_[True, whole[order][1:] != whole[order][:-1]] if len(order) else np.zeros(0, bool)
        again = np.flatnonzero(~new)
        new[again[~self.equal(a, order[again], order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))[again]])]] = True
        self.again = order[~new]  # the chunk has them earlier
        self.sent = order[new]
        bucket = (key[self.sent] >> U64(17)) % U64(buckets)
        self.sent = self.sent[np.argsort(bucket, kind="stable")]
        self.bucket = np.sort(bucket).astype(np.int64)


    def equal(self, a: Anchored, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Whether contexts of equal hash are equal: windows around the anchor, and bytes."""
        size = self.last[one] - self.first[one] + a.length
        out = (size == self.last[other] - self.first[other] + a.length) & (self.anchor[one] - self.first[one] == self.anchor[other] - self.first[other])
        for at in range(0, len(one), 10_000):
            some = np.flatnonzero(out[at : at + 10_000]) + at
            if len(some):
                differ = a.bytes_of(self.first[one[some]], size[some]) != a.bytes_of(self.first[other[some]], size[some])
                out[some] = np.add.reduceat(differ, np.cumsum(size[some]) - size[some], dtype=np.int64) == 0
        return out


def repeated_windows(starts: np.ndarray, sizes: np.ndarray, data: np.ndarray, left: np.ndarray, rank: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Per context a bit mask: bit b is set if the window that begins b - (length - gram) bytes after the anchor is
    also in a context of lower rank. left: bytes of the context before its anchor."""
    n, reach = len(starts), length - gram
    width = reach + length
    columns = np.zeros((width, n), np.uint8)
    for a in range(0, n, 4096):
        some = slice(a, min(n, a + 4096))
        rows = np.repeat(np.arange(some.start, some.stop), sizes[some])
        base = int(starts[a])
        at = np.arange(base, base + len(rows))
        columns[at - np.repeat(starts[some] - (reach - left[some]), sizes[some]), rows] = data[at]
    begin, end = reach - left, reach - left + sizes  # the context's columns
    by_end, by_begin = np.argsort(end, kind="stable"), np.argsort(begin, kind="stable")
    end_at, begin_at = end[by_end], begin[by_begin]
    masks = np.zeros(n, U64)
    order, lcp = np.zeros(0, np.int64), np.zeros(0, np.uint8)
    for c in range(width - 1, -1, -1):
        gone = by_begin[np.searchsorted(begin_at, c + 1) : np.searchsorted(begin_at, c + 2)]
        if len(gone) and len(order):
            stay = np.ones(n, bool)
            stay[gone] = False
            kept = np.flatnonzero(stay[order])
            if len(kept):
                lcp = np.minimum.reduceat(lcp[: kept[-1] + 1], np.r_[0, kept[:-1] + 1])
                lcp[0] = 0
            else:
                lcp = lcp[:0]
            order = order[kept]
        fresh = by_end[np.searchsorted(end_at, c + 1) : np.searchsorted(end_at, c + 2)]
        if len(fresh):
            order, lcp = np.concatenate([fresh, order]), np.concatenate([np.zeros(len(fresh), np.uint8), lcp])
        if not len(order):
            continue
        symbols = columns[c][order]  # this round's part of the transform
        turn = np.argsort(symbols, kind="stable")
        order, symbols = order[turn], symbols[turn]
        common = np.zeros(len(order), np.uint8)
        same = np.flatnonzero(symbols[1:] == symbols[:-1]) + 1
        if len(same):
            low, high = turn[same - 1] + 1, turn[same] + 1
            near = high - low == 1
            least = lcp[np.minimum(low, len(lcp) - 1)]
            if not near.all():
                pairs = np.stack([low[~near], high[~near]], axis=1).ravel()
                least[~near] = np.minimum.reduceat(np.append(lcp, np.uint8(0)), pairs)[::2]
            common[same] = np.minimum(least, width) + 1
        lcp = common
        if c <= reach and (lcp >= length).any():
            head = np.flatnonzero(lcp < length)
            group = np.cumsum(lcp < length) - 1
            ranks = rank[order]
            masks[order[ranks > np.minimum.reduceat(ranks, head)[group]]] |= U64(1) << U64(c)
    return masks


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, buckets: int | None = None, chunk_bytes: int = 8_000_000,
    crowd: int = CROWD, written: bool = False, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, prefix: str = "",
) -> DataFrame:
    """The columns `carry` of docs (all by default), with n_bytes, n_removed, n_spans and kept (binary: the bytes of
    the text that no window of `length` bytes covers that also begins earlier, at a smaller id or earlier in the same
    document), each name after `prefix`. Columns of docs with these four names are replaced.

    docs is read thrice: unless `written` says that it is a plain scan of written files, it is written first. Ids are
    integers; a null id counts as smaller than all; of rows with one id, those read first count as earlier. Null and
    empty texts and texts shorter than `length` lose nothing. An empty table gives an empty result.
    """
    if not 0 < length - gram < 64:
        raise ValueError("a window has 1 to 63 more bytes than its anchor")
    spark = docs.sparkSession
    made = [prefix + n for n in ("n_bytes", "n_removed", "n_spans", "kept")]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in made]
    inputs = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("__id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("__text"),
        *[F.col(c) for c in keep],
    )
    if not written:
        inputs = materialize(inputs, "suffix-docs")
    if not buckets:
        size = inputs.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
        buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    slim = inputs.select("__id", "__text", F.spark_partition_id().cast("long").alias("__scan"))
    full = inputs.withColumn("__scan", F.spark_partition_id().cast("long"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
        """Chunks of a scan partition's rows; every pass over the same files cuts alike."""
        number, held, size = None, [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if number is None:
                number = b.column("__scan")[0].as_py() << 24
            ends = np.cumsum(np.diff(np.frombuffer(b.column("__text").buffers()[1], np.int32)[b.column("__text").offset :][: b.num_rows + 1]))
            at = 0
            while at < b.num_rows:
                done = int(ends[at - 1]) if at else 0
                to = min(b.num_rows, int(np.searchsorted(ends, done + chunk_bytes - size)) + 1)
                held.append(b.slice(at, to - at))
                size += int(ends[to - 1]) - done
                at = to
                if size >= chunk_bytes:
                    yield number, held
                    number, held, size = number + 1, [], 0
        if held:
            yield number, held

    def texts_of(held: list[pa.RecordBatch]) -> list[bytes]:
        return [t for b in held for t in b.column("__text").to_pylist()]

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in numbered(batches):
            hashes, contexts, _ = distinct_anchors(Anchored(texts_of(held), length, gram))
            bucket = (hashes >> U64(17)) % U64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                rows = order[cuts[k] : cuts[k + 1]]
                yield row_of(k, number, squeeze(hashes[rows], contexts[rows]))

    def row_of(k: int, number: int, blob: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([number]), pa.array([blob], pa.binary())], ["bucket", "chunk", "blob"])

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
        bucket, rows = None, []
        for b in batches:
            for k, number, blob in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if k != bucket and rows:
                    yield bucket, rows
                    rows = []
                bucket = k
                rows.append((number, blob))
        if rows:
            yield bucket, rows

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in by_bucket(batches):
            parts = [expand(blob, "<u8", "<u4") for _, blob in rows]
            hashes, contexts = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, place, times = np.unique(hashes, return_inverse=True, return_counts=True)
            crowds = np.bincount(place, contexts) > crowd
            codes = np.where(crowds[place], 2, times[place] > 1).astype(np.uint8)
            at = 0
            for (number, _), (h, _) in zip(rows, parts, strict=True):
                yield row_of(k, number, squeeze(codes[at : at + len(h)]))
                at += len(h)

    def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in numbered(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                for b in held:
                    w.write_batch(b)
            yield row_of(buckets, number, sink.getvalue().to_pybytes())

    def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch], np.ndarray, list[tuple[int, bytes]], Anchored, np.ndarray]]:
        """Rows of a chunk come by bucket: codes and marks first, the documents last."""
        chunk, before = None, []
        for b in batches:
            for k, number, blob in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if number != chunk:
                    chunk, before = number, []
                if k < buckets:
                    before.append((k, blob))
                    continue
                held = list(pa.ipc.open_stream(blob))
                a = Anchored(texts_of(held), length, gram)
                ids = np.concatenate([x.column("__id").to_numpy() for x in held])
                yield number, held, before, a, ids

    def codes_of(a: Anchored, told: list[tuple[int, bytes]]) -> np.ndarray:
        hashes, _, _ = distinct_anchors(a)
        order = np.argsort((hashes >> U64(17)) % U64(buckets), kind="stable")
        codes = np.zeros(len(hashes), np.uint8)
        if told:
            codes[order] = np.concatenate([expand(blob, "u1")[0] for _, blob in told])
        return codes

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, told, a, ids in by_chunk(batches):
            x = Contexts(a, ids, codes_of(a, told), buckets)
            cuts = np.searchsorted(x.bucket, np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                rows = x.sent[cuts[k] : cuts[k + 1]]
                size = x.last[rows] - x.first[rows] + length
                left = (x.anchor[rows] - x.first[rows]).astype(np.uint8)
                at = x.anchor[rows] - (a.ends - a.sizes)[x.text[rows]]
                yield row_of(k, number, squeeze(ids[x.text[rows]], at, x.text[rows].astype(np.uint32), size.astype(np.uint16), left, a.bytes_of(x.first[rows], size)))

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in by_bucket(batches):
            parts = [expand(blob, "<i8", "<i8", "<u4", "<u2", "u1", "u1") for _, blob in rows]
            ids, at, text, size, left, data = (np.concatenate(x) for x in zip(*parts, strict=True))
            chunk = np.repeat([number for number, _ in rows], [len(p[0]) for p in parts])
            rank = np.empty(len(ids), np.int64)
            rank[np.lexsort((at, text, chunk, ids))] = np.arange(len(ids))
            size = size.astype(np.int64)
            masks = repeated_windows(np.cumsum(size) - size, size, data, left.astype(np.int64), rank, length, gram)
            done = 0
            for (number, _), p in zip(rows, parts, strict=True):
                yield row_of(k, number, squeeze(masks[done : done + len(p[0])]))
                done += len(p[0])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, told, a, ids in by_chunk(batches):
            codes = codes_of(a, [(k, blob[1:]) for k, blob in told if blob[:1] == b"c"])
            x = Contexts(a, ids, codes, buckets)
            marks = [expand(blob[1:], "<u8")[0] for _, blob in told if blob[:1] == b"m"]
            masks = np.concatenate(marks) if marks else np.zeros(0, U64)
            hit = np.flatnonzero(masks)
            bits = np.unpackbits(masks[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            which, bit = np.nonzero(bits)
            begin, end = a.covered(np.r_[x.first[x.again], x.anchor[x.sent[hit[which]]] + bit - (length - gram)], np.r_[x.last[x.again] + length, x.anchor[x.sent[hit[which]]] + bit - (length - gram) + length])
            of = np.searchsorted(a.ends, begin, side="right")
            upto = np.searchsorted(of, np.arange(len(a.ends) + 1))
            done = 0
            for b in held:
                n, out, removed, spans = b.num_rows, [], [], []
                for k in range(done, done + n):
                    at, left = int(a.ends[k] - a.sizes[k]), []
                    mine = slice(upto[k], upto[k + 1])
                    for s, e in zip(begin[mine].tolist(), end[mine].tolist(), strict=True):
                        left.append(a.data[at:s])
                        at = e
                    left.append(a.data[at : int(a.ends[k])])
                    out.append(b"".join(left))
                    removed.append(int((end[mine] - begin[mine]).sum()))
                    spans.append(upto[k + 1] - upto[k])
                own = [pa.array(a.sizes[done : done + n]), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *own], [*keep, *made])
                done += n

    rows = "bucket int, chunk bigint, blob binary"
    to_bucket = lambda df: df.repartition("bucket").sortWithinPartitions("bucket", "chunk")
    to_chunk = lambda df: df.repartition("chunk").sortWithinPartitions("chunk", "bucket")
    codes = materialize(to_bucket(slim.mapInArrow(lean(anchors), rows)).mapInArrow(lean(elsewhere), rows), "suffix-codes")
    met = to_chunk(codes.unionByName(slim.mapInArrow(lean(boxed), rows)))
    marks = materialize(to_bucket(met.mapInArrow(lean(contexts), rows)).mapInArrow(lean(ordered), rows), "suffix-marks")
    tag = lambda df, mark: df.withColumn("blob", F.concat(F.lit(mark).cast("binary"), "blob"))
    last = to_chunk(tag(codes, "c").unionByName(tag(marks, "m")).unionByName(full.mapInArrow(lean(boxed), rows)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.select(*keep).schema)
    return last.mapInArrow(lean(cut), (f"{fields}, " if keep else "") + "{} bigint, {} bigint, {} bigint, {} binary".format(*made))


def drop_repeats(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs with the repeated passages taken out of the text, columns as in docs; n_chars, if there, follows the text.
    What is left of a character that was cut in two becomes U+FFFD. A null text stays null."""
    out = remove_repeats(docs.withColumn("__null", F.col(text_col).isNull()), text_col=text_col, prefix="__", **options)
    text = F.when(~F.col("__null"), F.make_valid_utf8(F.col("__kept").cast("string")))
    out = out.withColumn(text_col, text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op10_column_wise_suffixes(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, written=True, carry=["doc_id"]).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
