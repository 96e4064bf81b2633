"""Byte-level BPE by a global shuffle of distinct words.

1. Documents are cut into pre-tokens. A chunk of documents (some 12 million characters in one task) keeps a dictionary of its
   distinct words, and each document becomes the sequence of its words' places in that dictionary: words exploded with
   positions, pre-aggregated, so that a frequent word leaves a task once a chunk.
2. The dictionaries are dealt by a hash of the word. Whoever gets a word encodes it once, whatever the number of
   chunks that sent it, and returns the ids under (chunk, place in the dictionary).
3. Ids and documents meet by chunk; each document is put together by position.
4. Decoding looks each id up in the token-byte table, which the vocabulary bounds.

Words, ids and positions travel as compressed blocks, one row for each chunk and word bucket.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import expand, lean, materialize, squeeze

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text for each bucket of words.
BUCKET_BYTES = 4_000_000


@lru_cache(maxsize=1)
def splitter():
    """The public pattern, white space named by its Unicode property: what \\s means differs between regex engines."""
    return regex.compile(public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s+", r"\p{White_Space}+"))


@lru_cache(maxsize=1)
def ranks(path: str | None = None) -> dict[bytes, int]:
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=1)
def encoding(path: str | None = None) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=1)
def token_bytes(path: str | None = None) -> list[bytes]:
    table = [b""] * (max(ranks(path).values()) + 1)
    for token, i in ranks(path).items():
        table[i] = token
    return table


class Chunks:
    """Cuts the documents of a task, in the order they are read, into chunks of about most_chars characters. The chunk
    number holds the scan partition's number, so both passes over the same table number alike."""

    def __init__(self, most_chars: int) -> None:
        self.most, self.number, self.chars = most_chars, 0, 0
        self.places: dict[str, int] = {}

    def sequence(self, text: str | None) -> np.ndarray:
        places, words = self.places, splitter().findall(text or "")
        self.chars += len(text or "")
        try:
            return np.fromiter(map(places.__getitem__, words), np.uint32, len(words))
        except KeyError:
            for w in words:
                if w not in places:
                    places[w] = len(places)
            return np.fromiter(map(places.__getitem__, words), np.uint32, len(words))

    def within(self, scan: int) -> None:
        if not self.number:
            self.number = 1 + (scan << 24)

    def full(self) -> bool:
        return self.chars >= self.most

    def next(self) -> None:
        self.number, self.chars, self.places = self.number + 1, 0, {}


def encode(
    docs: DataFrame, buckets: int | None = None, chunk_chars: int = 12_000_000, path: str | None = None, written: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id and ids (binary: little-endian unsigned 32-bit integers), one row per input row.

    docs is read twice and must be the same both times: unless `written` says that it is a plain scan of written files,
    its ids and texts are written first. Null and empty texts give no ids; null ids and repeated rows are kept. An
    empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if not written:
        named = materialize(named, "bpe-docs")
    if not buckets:  # as many as the texts ask for: what a bucket's task remembers stays the same
        size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    named = named.withColumn("scan", F.spark_partition_id().cast("long"))

    def dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunks(chunk_chars)

        def flush() -> Iterator[pa.RecordBatch]:
            if chunk.places:
                words = [w.encode() for w in chunk.places]
                bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for k in range(buckets):
                    rows = order[cuts[k] : cuts[k + 1]]
                    if len(rows):
                        some = [words[i] for i in rows.tolist()]
                        sizes = np.fromiter(map(len, some), np.uint32, len(some))
                        blob = squeeze(rows.astype(np.uint32), sizes, np.frombuffer(b"".join(some), np.uint8))
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([chunk.number]), pa.array([blob], pa.binary())], ["bucket", "chunk", "blob"])
            chunk.next()

        for b in batches:
            for text, scan in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                chunk.within(scan)
                chunk.sequence(text.as_py())
                if chunk.full():
                    yield from flush()
        yield from flush()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = encoding(path)._core_bpe
        bucket, known = None, {}
        for b in batches:
            for at, chunk, blob in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if at != bucket:
                    bucket, known = at, {}
                places, sizes, data = expand(blob, "<u4", "<u4", "u1")
                data, ends, out = data.tobytes(), np.cumsum(sizes), []
                for a, z in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
                    word = data[a:z]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = core.encode_single_piece(word)
                    out.append(ids)
                n = np.fromiter(map(len, out), np.uint32, len(out))
                flat = np.fromiter((i for ids in out for i in ids), np.uint32, int(n.sum()))
                back = squeeze(places, n, flat)
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([0], pa.int32()), pa.nulls(1, id_type), pa.array([back], pa.binary())], ["chunk", "part", "doc_id", "blob"])

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunks(chunk_chars)
        for b in batches:
            numbers, blobs = [], []
            for text, scan in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                chunk.within(scan)
                blobs.append(squeeze(chunk.sequence(text.as_py())))
                numbers.append(chunk.number)
                if chunk.full():
                    chunk.next()
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([1] * len(blobs), pa.int32()), b.column(0), pa.array(blobs, pa.binary())], ["chunk", "part", "doc_id", "blob"])

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, table, parts = None, None, []
        def batch(b: pa.RecordBatch, keys: list[int], out: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(keys)), pa.array(out, pa.binary())], ["doc_id", "ids"])

        for b in batches:
            keys, out, size = [], [], 0
            numbers, kinds, blobs = b.column("chunk").to_numpy(), b.column("part").to_numpy(), b.column("blob")
            for i in range(b.num_rows):
                if numbers[i] != chunk:
                    chunk, table, parts = numbers[i], None, []
                if kinds[i] == 0:
                    parts.append(expand(blobs[i].as_py(), "<u4", "<u4", "<u4"))
                    continue
                if table is None:
                    table, parts = _table(parts), []
                keys.append(i)
                out.append(b"".join(map(table.__getitem__, expand(blobs[i].as_py(), "<u4")[0].tolist())))
                size += len(out[-1])
                if size >= 4_000_000:
                    yield batch(b, keys, out)
                    keys, out, size = [], [], 0
            if keys:
                yield batch(b, keys, out)

    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    dealt = named.mapInArrow(lean(dictionaries), "bucket int, chunk bigint, blob binary").repartition("bucket").sortWithinPartitions("bucket", "chunk")
    words = dealt.mapInArrow(lean(encoded), f"chunk bigint, part int, doc_id {kind}, blob binary")
    texts = named.mapInArrow(lean(sequences), f"chunk bigint, part int, doc_id {kind}, blob binary")
    met = words.unionByName(texts).repartition("chunk").sortWithinPartitions("chunk", "part")
    return met.mapInArrow(lean(assembled), f"doc_id {kind}, ids binary")


def _table(parts: list[list[np.ndarray]]) -> list[bytes]:
    """Ids of a chunk's words by place."""
    out = [b""] * sum(len(p[0]) for p in parts)
    for places, n, flat in parts:
        data, ends = flat.tobytes(), 4 * np.cumsum(n, dtype=np.int64)
        for i, a, z in zip(places.tolist(), (ends - 4 * n.astype(np.int64)).tolist(), ends.tolist(), strict=True):
            out[i] = data[a:z]
    return out


def decode(ids: bytes, path: str | None = None) -> bytes:
    """The bytes of ids as encode() gives them."""
    return b"".join(map(token_bytes(path).__getitem__, np.frombuffer(ids, "<u4").tolist()))


def op5_distinct_word_bpe(spark, sf_dir: str) -> DataFrame:
    coded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), written=True)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                ids = b.column(1).to_pylist()
                sha = [[hashlib.sha256(x).hexdigest() for x in xs] for xs in (ids, map(decode, ids, repeat(None)))]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), *map(pa.array, sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return coded.mapInArrow(lean(digest), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
