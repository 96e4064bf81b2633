"""Fill-in-the-middle transformation (succinct rank and select).

The bytes of a batch's texts have one packed vector of bits, set where a code point begins, with a directory of set bits
before each block. Its counts give every text's length in code points, and two selects give the bytes at which a text is
cut, so no text is decoded or walked. Where a text is cut, and in which form it is written, follows from a hash of its id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, text_bytes

MARKS = ("<P>", "<S>", "<M>")


class Boundaries:
    """Bits of the bytes that begin a code point, packed in words of 64, and the count of set bits before each block."""

    BLOCK = 8  # words

    def __init__(self, data: np.ndarray) -> None:
        packed = np.packbits((data & 0xC0) != 0x80, bitorder="little")
        size = -(-(len(packed) + 1) // (8 * self.BLOCK)) * 8 * self.BLOCK  # one bit at least is behind the last byte
        self.words = np.concatenate([packed, np.zeros(size - len(packed), np.uint8)]).view(np.uint64)
        self.within = np.bitwise_count(self.words).reshape(-1, self.BLOCK)
        self.before = np.concatenate([[0], np.cumsum(self.within.sum(axis=1, dtype=np.int64))])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Code points that begin before these bytes."""
        word = at >> 6
        block, inside = word // self.BLOCK, word % self.BLOCK
        earlier = np.where(np.arange(self.BLOCK) < inside[:, None], self.within[block], 0).sum(axis=1, dtype=np.int64)
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + earlier + np.bitwise_count(self.words[word] & mask)

    def select(self, k: np.ndarray, end: int) -> np.ndarray:
        """The byte at which the k-th code point (from 0) begins; `end` if there is none."""
        some = k < self.before[-1]
        k = np.where(some, k, 0)
        block = np.searchsorted(self.before, k, "right") - 1
        block = np.minimum(block, len(self.within) - 1)
        left = k - self.before[block]
        upto = np.cumsum(self.within[block], axis=1, dtype=np.int64)
        word = (upto <= left[:, None]).sum(axis=1).clip(max=self.BLOCK - 1)
        left = left - np.where(word > 0, np.take_along_axis(upto, np.maximum(word - 1, 0)[:, None], 1)[:, 0], 0)
        bits = np.unpackbits(self.words[block * self.BLOCK + word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bit = (np.cumsum(bits, axis=1) <= left[:, None]).sum(axis=1)
        return np.where(some, 64 * (block * self.BLOCK + word) + bit, end)


def draws(key: object, seed: int) -> tuple[int, ...]:
    """Four numbers of 32 bits: the first groups of the hash of the seed and an id (a null one is empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def _marks(marks: tuple[str, str, str]) -> list[bytes]:
    """Marks can be found again if none begins inside another: each begins with a character that stands nowhere else in them."""
    if len(set(marks)) < 3 or any(not m or m[0] in x[1:] for m in marks for x in marks):
        raise ValueError("marks must differ, and the first character of each must stand nowhere else in them")
    return [m.encode() for m in marks]


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, seed: int = 1, plain: int = 10, spm: int = 20, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The columns `carry` of docs (all by default) with n (code points), form, prefix_chars, middle_chars and output.

    A text is cut after two of its code points into prefix, middle and suffix, and written as psm (mark, prefix, mark, suffix,
    mark, middle) or, `spm` times of 100, as spm (suffix, prefix, middle). It stays plain, with null counts, if it is empty
    or null, if it holds a mark, and `plain` times of 100. The outcome follows from the id, the text and the seed: repeated
    rows get equal ones. An empty table gives an empty result. Columns of docs that have the names of the results are
    replaced.
    """
    first, second, third = _marks(marks)
    made = ["n", "form", "prefix_chars", "middle_chars", "output"]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in made]
    inputs = docs.select(*keep, F.col(id_col).cast("string").alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("__text")
            data, starts = text_bytes(texts)
            bits = Boundaries(data)
            rank = bits.rank(starts)
            n = np.diff(rank)
            drawn = np.array([draws(x, seed) for x in b.column("__id").to_pylist()], np.int64).reshape(-1, 4)
            cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
            bare = (n == 0) | (drawn[:, 2] % 100 >= 100 - plain)
            for m in marks:
                bare |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
            at = [np.minimum(bits.select(rank[:-1] + cuts[:, i], len(data)), starts[1:]) for i in (0, 1)]
            turned = drawn[:, 3] % 100 < spm
            whole, out = memoryview(data), []
            for a, p, m, z, is_bare, is_turned in zip(starts[:-1].tolist(), *(x.tolist() for x in (*at, starts[1:], bare, turned)), strict=True):
                if is_bare:
                    out.append(bytes(whole[a:z]))
                elif is_turned:
                    out.append(b"".join((second, whole[m:z], first, whole[a:p], third, whole[p:m])))
                else:
                    out.append(b"".join((first, whole[a:p], second, whole[m:z], third, whole[p:m])))
            form = np.where(bare, "plain", np.where(turned, "spm", "psm"))
            found = [pa.array(n), pa.array(form, pa.string()), pa.array(cuts[:, 0], mask=bare), pa.array(cuts[:, 1] - cuts[:, 0], mask=bare), pa.array(out, pa.binary()).cast(texts.type)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *found], [*keep, *made])

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return inputs.mapInArrow(lean(run), f"{fields}n long, form string, prefix_chars long, middle_chars long, output string")


def restored(rows: DataFrame, output: str = "output", form: str = "form", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """rows with `restored`: the text that an output was made of, rebuilt from it and its form alone; null where either is null."""
    first, second, third = marks
    _marks(marks)
    text = F.col(output)
    at = lambda m: F.instr(text, m)
    part = lambda m, end: F.substring(text, at(m) + len(m), end - at(m) - len(m))
    after = F.length(text) + 1
    psm = F.concat(part(first, at(second)), part(third, after), part(second, at(third)))
    spm = F.concat(part(first, at(third)), part(third, after), part(second, at(first)))
    return rows.withColumn("restored", F.when(F.col(form) == "plain", text).when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm))


def op13_succinct_infill(spark, sf_dir: str) -> DataFrame:
    done = restored(rearrange(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"]))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"))
