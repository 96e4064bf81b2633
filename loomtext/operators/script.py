"""Conversion of a script by a table of phrases: at each place the longest phrase of the table is replaced, from left to right."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lattice import DoubleArray, batches_of

#: Rows of a table that travels with the tasks. Tables of phrases have some ten thousand.
MOST = 1_000_000


class Converter:
    """Of equal phrases the last one counts; empty ones are left out."""

    def __init__(self, pairs: list[tuple[str, str]]) -> None:
        table = dict(sorted((a, b) for a, b in dict(pairs).items() if a))
        self.out = list(table.values())
        self.alphabet = np.array(sorted({ord(c) for p in table for c in p}), np.uint32)
        number = {int(c): i + 1 for i, c in enumerate(self.alphabet)}
        self.trie = DoubleArray([tuple(number[ord(c)] for c in p) for p in table])
        self.longest = max(map(len, table), default=1)

    @classmethod
    def read(cls, table: DataFrame) -> Converter:
        """Of a table with src and dst of at most MOST rows; of equal phrases that with the greatest dst counts."""
        rows = table.where("src IS NOT NULL").groupBy("src").agg(F.max(F.coalesce("dst", F.lit(""))).alias("dst")).limit(MOST + 1).collect()
        if len(rows) > MOST:
            raise ValueError(f"a table of phrases has at most {MOST} rows")
        return cls([tuple(r) for r in rows])

    def convert(self, texts: list[str]) -> list[str]:
        out: list[str] = []
        for some in batches_of(texts):
            codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
            sizes = np.array([len(t) for t in some], np.int64)
            ends = np.cumsum(sizes)
            at = np.minimum(np.searchsorted(self.alphabet, codes), max(0, len(self.alphabet) - 1))
            labels = np.where(self.alphabet[at] == codes, at + 1, 0) if len(self.alphabet) else np.zeros(len(codes), np.int64)
            found = self.trie.walk(labels, np.repeat(ends, sizes), self.longest)
            size = np.where(found >= 0, np.arange(1, self.longest + 1)[:, None], 0).max(axis=0)
            places = np.flatnonzero(size)
            spots = np.searchsorted(places, [0, *ends.tolist()])
            for text, first, low, high in zip(some, (ends - sizes).tolist(), spots[:-1], spots[1:], strict=True):
                parts, done = [], 0
                for p in places[low:high].tolist():
                    if (begin := p - first) >= done:
                        parts += [text[done:begin], self.out[found[size[p] - 1, p]]]
                        done = begin + int(size[p])
                out.append("".join([*parts, text[done:]]))
        return out

    def column(self, name: str) -> Column:
        """A column of texts, converted; null stays null."""

        def run(texts: pd.Series) -> pd.Series:
            held = texts.dropna()
            return pd.Series(self.convert(list(held)), held.index, dtype=object).reindex(texts.index)

        return F.pandas_udf(run, "string")(name)
