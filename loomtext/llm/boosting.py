"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of every whole text are computed once, in Arrow batches, and written. A bounded sample of the labelled ones
trains the trees on the driver: values become bins by quantiles, each level's nodes sum gradients and curvatures per bin,
and the best cut by gain splits. The trees are flattened into arrays of one complete binary tree each, and numpy walks all
documents of a batch through a tree at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize, text_bytes

#: Classes of bytes, each a statistic (its share of the text's bytes). Bytes that continue a character are in none.
GROUPS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b"\t\x0b\x0c\r ", "line": b"\n",
    "stop": b".!?", "pause": b",;:", "quote": b"'\"`", "bracket": b"()[]{}<>", "mark": b"#*$%&|~^=+@_", "slash": b"/\\-", "other": bytes([*range(9), *range(14, 32), 127]), "beyond": bytes(range(0xC0, 0x100)),
}
GROUP = np.full(256, len(GROUPS), np.uint8)
for _i, _members in enumerate(GROUPS.values()):
    GROUP[list(_members)] = _i
STATISTICS = [
    *GROUPS, "log_bytes", "log_words", "word_bytes", "capital_words", "shouted_words", "marked_words", "short_words", "long_words", "distinct_words", "top_word", "repeated_pairs",
    "repeated_windows", "lines_per_word", "repeated_lines", "unstopped_lines", "packed", "exclaimed_words",
]


def _words(text: bytes) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 10
    codes = {}
    ids = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    counts = np.bincount(ids)
    pairs = ids[:-1] * n + ids[1:]
    windows = np.zeros(max(0, n - 7), np.uint64)
    for k in range(8 if n > 7 else 0):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + ids[k : n - 7 + k].astype(np.uint64)
    repeated = lambda x: 1 - len(np.unique(x)) / len(x) if len(x) else 0.0
    distinct = list(codes)
    share = lambda test: float(counts[[i for i, w in enumerate(distinct) if test(w)]].sum()) / n
    return [
        share(lambda w: w[:1].isupper()), share(lambda w: len(w) > 1 and w.isupper()), share(lambda w: w[-1] in b"#*$%&|"), share(lambda w: len(w) < 4), share(lambda w: len(w) > 20),
        len(codes) / n, float(counts.max()) / n, repeated(pairs), repeated(windows), share(lambda w: w[-1] in b"!"),
    ]


def _lines(text: bytes) -> list[float]:
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    if not lines:
        return [0.0] * 3
    return [float(len(lines)), 1 - len(set(lines)) / len(lines), sum(x[-1] not in b".!?:;\"')" for x in lines) / len(lines)]


def statistics(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each of the texts that stand one after the other in data."""
    out = np.zeros((len(starts) - 1, len(STATISTICS)), np.float32)
    whole = GROUP[data]
    buffer = data.tobytes()
    pack = zstandard.ZstdCompressor(level=1)
    for i, (a, z) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        if a == z:
            continue
        text, size = buffer[a:z], z - a
        shares = np.bincount(whole[a:z], minlength=len(GROUPS) + 1)[: len(GROUPS)] / size
        capital, shouted, marked, short, long_, distinct, top, pairs, windows, exclaimed = _words(text)
        n_words = len(text.split())
        n_lines, same, unstopped = _lines(text)
        out[i] = [
            *shares, np.log1p(size), np.log1p(n_words), size / max(1, n_words), capital, shouted, marked, short, long_, distinct, top, pairs,
            windows, n_lines / max(1, n_words), same, unstopped, len(pack.compress(text)) / size, exclaimed,
        ]
    return out


def described(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns keep of docs with __x, the statistics of the whole text; written."""
    inputs = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(*text_bytes(b.column("__text")))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32()), pa.array(x.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], lists], [*keep, "__x"])

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return materialize(inputs.mapInArrow(lean(run), f"{fields}__x array<float>"), "quality-statistics")


@dataclass
class Trees:
    """Complete binary trees of one depth: node i's children are 2 i + 1 (value <= cut) and 2 i + 2. A node that doesn't
    split has an infinite cut."""

    feature: np.ndarray  # tree, inner node
    cut: np.ndarray
    leaf: np.ndarray  # tree, leaf
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, ridge: float = 1.0, least: int = 10) -> Trees:
    """Newton boosting of the logistic loss. least: rows in a leaf. Without rows the trees say 1/2."""
    n, width = x.shape
    share = float(y.mean()) if n else 0.5
    share = min(max(share, 1 / (n + 2)), 1 - 1 / (n + 2))
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves))
    if not n or y.min() == y.max():
        return Trees(feature, cut, leaf, base)
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins, method="lower")).astype(np.float32) for f in range(width)]
    code = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)  # value <= edge[c] for codes up to c
    flat = code + np.arange(width) * bins
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (width * bins) + flat).ravel()
            sums = lambda w: np.bincount(place, np.repeat(w, width), many * width * bins).reshape(many, width, bins).cumsum(axis=2)  # noqa: B023, E731
            gl, hl, nl = sums(g), sums(h), sums(np.ones(n))
            ga, ha, na = gl[:, :1, -1:], hl[:, :1, -1:], nl[:, :1, -1:]
            gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
            gain[(nl < least) | (na - nl < least)] = -1
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = -1
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in np.flatnonzero(gain.reshape(many, -1).max(axis=1) > 1e-9):
                f, c = divmod(int(best[k]), bins)
                feature[t, first + k], cut[t, first + k] = f, edges[f][c]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        at = node - inner
        leaf[t] = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + ridge)
        margin += leaf[t, at]
    return Trees(feature, cut, leaf, base)


def sampled(table: DataFrame, labels: DataFrame, learn: Column, id_col: str, label: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most `most` labelled rows, those of least hash of the id. An id whose labels contradict
    each other, or that isn't whole, teaches nothing; labels are those of rows for which `learn` holds."""
    known = labels.where(F.col(label).isin(0, 1) & learn).groupBy(id_col).agg(F.min(label).alias("__y"), F.max(label).alias("__max")).where("__y = __max")
    met = table.where(learn).select(id_col, "__x").join(known.select(id_col, "__y"), id_col)
    rows = met.orderBy(F.xxhash64(id_col), id_col, "__x").limit(most).select("__x", "__y").toArrow()
    x = rows.column("__x").combine_chunks()
    flat = (x.flatten() if isinstance(x, pa.ListArray) else pa.concat_arrays([c.flatten() for c in x.chunks])) if len(rows) else pa.array([], pa.float32())
    return flat.to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS)), rows.column("__y").to_numpy().astype(np.float64)


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
    held_out: int = 5, most_labelled: int = 20_000, threshold: float = 0.3, **options,
) -> DataFrame:
    """The columns `carry` of docs (all by default) with held_out, score (probability of label 1) and predicted.

    Rows whose crc32(id as text) is divisible by held_out are held out: neither they nor their labels are learned from (a null
    id is not held out, and has no label). At most most_labelled labelled rows train the trees; `options` go to fit(). A score
    depends on the text alone: equal texts have equal ones; null counts as empty, and empty texts are scored, too. Without
    labels every score is 1/2, with those of one kind all are equal. An empty table gives an empty result. Columns of
    docs that have the names of the results are replaced.
    """
    made = ["held_out", "score", "predicted"]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in made]
    out_of = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(held_out)) == 0, F.lit(False))
    table = described(docs, text_col, list(dict.fromkeys([*keep, id_col])))
    trees = fit(*sampled(table, labels, ~out_of, id_col, label, most_labelled), **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            score = trees.score(x)
            found = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in [*keep, "held_out"]], *found], [*keep, *made])

    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return table.select(*keep, out_of.alias("held_out"), "__x").mapInArrow(lean(run), f"{fields}held_out boolean, score double, predicted int")


def op12_boosted_quality(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=["doc_id"])
