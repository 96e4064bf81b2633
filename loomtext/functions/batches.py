"""Arrow batches in slices of a bounded number of rows and characters, so that a worker never holds the objects of a whole batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import functions as F

#: Rows and characters of a slice; a longer text is one of its own.
ROWS, CHARS = 500, 1 << 18


def slices(sizes: Iterable[int], rows: int = ROWS, chars: int = CHARS) -> Iterator[tuple[int, int]]:
    """(first, behind the last) of consecutive slices of items of these sizes."""
    first = end = total = 0
    for size in sizes:
        if end > first and (end - first >= rows or total + size > chars):
            yield first, end
            first, total = end, 0
        end, total = end + 1, total + size
    if end > first:
        yield first, end


def by_slices(run: Callable[[pd.Series], pd.Series], kind: str):
    """A column function of texts that works on one slice after the other."""

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for a, b in slices([len(t or "") for t in batch]):
                yield run(batch.iloc[a:b])

    return F.pandas_udf(each, kind)
