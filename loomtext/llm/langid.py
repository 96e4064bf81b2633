"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled documents, in windows of
`STEPS` bytes. It labels every byte of a text: whole texts are cut into segments of `SEGMENT` bytes, both directions
run over each segment and the `CONTEXT` bytes on either side of it, so that no label stands at the edge of what the
states have seen, and the probabilities of the positions are averaged per document. The weights are a few kilobytes
and travel with the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

STEPS, SEGMENT, CONTEXT, UNDETERMINED = 64, 448, 32, "und"
HAS_LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    languages: list[str]
    weights: dict[str, np.ndarray]


def new_weights(n_out: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    """Per direction: x (gates of each byte, biases included) and u (gates of the state); out, bias of the labels.
    Gates stand in the order update, reset, candidate."""
    rng = np.random.default_rng(seed)
    w = {}
    for d in "fb":
        w[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        w[f"u{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
    w["out"], w["bias"] = rng.normal(0, 0.3, (2 * hidden, n_out)), np.zeros(n_out)
    return {k: v.astype(np.float32) for k, v in w.items()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def run_direction(x: np.ndarray, u: np.ndarray, data: np.ndarray, real: np.ndarray, back: bool, trace: list | None = None) -> np.ndarray:
    """States (steps, windows, hidden). data: (steps, windows) bytes; real: 1 where there is a byte, else 0."""
    steps, n = data.shape
    h = u.shape[0]
    states, state = np.empty((steps, n, h), np.float32), np.zeros((n, h), np.float32)
    for t in range(steps - 1, -1, -1) if back else range(steps):
        a, s = x[data[t]], state @ u
        gates = sigmoid(a[:, : 2 * h] + s[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        c = np.tanh(a[:, 2 * h :] + r * s[:, 2 * h :])
        new = (c + z * (state - c)) * real[t][:, None]
        if trace is not None:
            trace.append((t, state, z, r, c, s[:, 2 * h :]))
        states[t] = state = new
    return states


def position_probabilities(w: dict[str, np.ndarray], data: np.ndarray, real: np.ndarray, traces: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    both = [run_direction(w[f"x{d}"], w[f"u{d}"], data, real, d == "b", traces[i] if traces else None) for i, d in enumerate("fb")]
    states = np.concatenate(both, axis=2)
    logits = states @ w["out"] + w["bias"]
    p = np.exp(logits - logits.max(axis=2, keepdims=True))
    return p / p.sum(axis=2, keepdims=True), states


def gradients(w: dict[str, np.ndarray], data: np.ndarray, real: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of all positions and its gradients by backpropagation through time."""
    traces: tuple[list, list] = ([], [])
    p, states = position_probabilities(w, data, real, traces)
    h = w["uf"].shape[0]
    share = real * weight
    share = share / share.sum()
    rows = np.arange(len(label))
    loss = -float((np.log(p[:, rows, label] + 1e-9) * share).sum())
    d = p.copy()
    d[:, rows, label] -= 1
    d *= share[:, :, None]
    g = {"out": np.einsum("tbh,tbo->ho", states, d), "bias": d.sum(axis=(0, 1))}
    d_states = d @ w["out"].T
    for i, side in enumerate("fb"):
        x, u = np.zeros_like(w[f"x{side}"]), np.zeros_like(w[f"u{side}"])
        carry = np.zeros((len(label), h), np.float32)
        for t, before, z, r, c, s in reversed(traces[i]):
            dh = (d_states[t][:, i * h : (i + 1) * h] + carry) * real[t][:, None]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (before - c) * z * (1 - z)
            dr = dc * s * r * (1 - r)
            da = np.concatenate([dz, dr, dc], axis=1)
            ds = np.concatenate([dz, dr, dc * r], axis=1)
            np.add.at(x, data[t], da)
            u += before.T @ ds
            carry = dh * z + ds @ w[f"u{side}"].T
        g[f"x{side}"], g[f"u{side}"] = x, u
    return loss, g


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int, rounds: int, seed: int) -> Network:
    """Adam on batches of 192 windows, languages weighted alike."""
    w = new_weights(len(languages), hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    rng = np.random.default_rng(seed + 1)
    balance = 1.0 / np.maximum(1, np.bincount(labels, minlength=len(languages)))
    for n in range(1, rounds + 1):
        rows = rng.integers(0, len(windows), 192)
        real = (np.arange(windows.shape[1])[:, None] < lengths[rows]).astype(np.float32)
        _, g = gradients(w, windows[rows].T, real, labels[rows], balance[labels[rows]].astype(np.float32))
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        for k in w:
            step = g[k] * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * step
            second[k] = 0.99 * second[k] + 0.01 * step * step
            w[k] -= (0.02 * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
    return Network(languages, w)


def fit(labelled: DataFrame, sample_docs: int = 4000, per_doc: int = 8, hidden: int = 8, rounds: int = 250, seed: int = 7, text_col: str = "text", lang_col: str = "lang") -> Network:
    """Trained on windows at hashed places in at most sample_docs documents (distinct pairs of text and language, those
    of least hash, so that the same rows give the same sample however they are stored), so at most sample_docs *
    per_doc windows of 64 bytes reach the driver. A count sets a threshold of the hash first, so that no task sends
    more than its share of the sample. Null or empty texts and null languages are left out. No labelled rows: a network
    without languages, which predicts nothing."""
    raw = F.col(text_col).cast("binary")
    fit_for = labelled.where(F.col(lang_col).isNotNull() & (F.length(raw) > 0))
    n = fit_for.count()
    top = int(-(1 << 63) + min(1.0, 2 * sample_docs / max(1, n)) * ((1 << 64) - 1))
    row_hash = F.xxhash64(F.lit(seed), F.col(text_col), lang_col)
    some = fit_for.withColumn("__h", row_hash).where(F.col("__h") <= min(top, (1 << 63) - 1)).dropDuplicates(["__h"])
    start = lambda k: (F.pmod(F.xxhash64("__h", k), F.greatest(F.lit(1), F.length(raw) - STEPS + 1)) + 1).cast("int")
    pieces = F.transform(F.sequence(F.lit(1), F.lit(per_doc)), lambda k: F.substring(raw, start(k), F.lit(STEPS)))
    rows = some.select("__h", F.col(lang_col).alias("lang"), pieces.alias("pieces")).orderBy("__h").limit(sample_docs).collect()
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return Network([], {})
    pairs = [(languages.index(r["lang"]), bytes(p)) for r in rows for p in r["pieces"]]
    windows = np.zeros((len(pairs), STEPS), np.uint8)
    for i, (_, p) in enumerate(pairs):
        windows[i, : len(p)] = np.frombuffer(p, np.uint8)
    labels, lengths = np.array([a for a, _ in pairs]), np.array([len(p) for _, p in pairs])
    return train(windows, lengths, labels, languages, hidden, rounds, seed)


def classify(network: Network, texts: list[str | None], most: int = 1024) -> tuple[list[str], list[float]]:
    """Language and pooled probability of each whole text; und and 0 for null, without a letter, or untrained. Segments
    are run `most` at a time, those of like length together."""
    raw = [(t or "").encode() for t in texts]
    known = np.array([bool(network.languages and t and HAS_LETTER.search(t)) for t in texts], bool)
    sizes = np.where(known, np.fromiter(map(len, raw), np.int64, len(raw)), 0)
    counts = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(raw)), counts)
    at = SEGMENT * (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts))
    begin, end = np.maximum(0, at - CONTEXT), np.minimum(sizes[owner], at + SEGMENT + CONTEXT)
    order = np.argsort(end - begin, kind="stable")
    pooled = np.zeros((len(raw), max(1, len(network.languages))))
    for a in range(0, len(order), most):
        some = order[a : a + most]
        lengths = end[some] - begin[some]
        data = np.zeros((len(some), int(lengths.max())), np.uint8)
        for row, i, x, n in zip(data, owner[some].tolist(), begin[some].tolist(), lengths.tolist(), strict=True):
            row[:n] = np.frombuffer(raw[i], np.uint8, n, x)
        step = np.arange(data.shape[1])[:, None]
        p, _ = position_probabilities(network.weights, np.ascontiguousarray(data.T), (step < lengths).astype(np.float32))
        own = (step >= at[some] - begin[some]) & (step < np.minimum(at[some] + SEGMENT, sizes[owner[some]]) - begin[some])
        np.add.at(pooled, owner[some], np.einsum("tbo,tb->bo", p, own.astype(np.float32)))
    best = pooled.argmax(axis=1)
    top = pooled[np.arange(len(raw)), best] / np.maximum(1, sizes)
    names = [network.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist(), strict=True)]
    return names, [min(1.0, float(s)) if k else 0.0 for s, k in zip(top, known.tolist(), strict=True)]


def predict(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, one row per input row. Null texts and texts without a letter are `und` with score 0;
    null ids and repeated rows are kept; an empty table gives an empty result. Only the text is an input."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                names, scores = classify(network, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(lean(run), f"doc_id {kind}, lang_pred string, score double")


def op2_bidirectional_gru(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    network = fit(docs.where(~held_out).select("text", "lang"))
    return predict(docs, network).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
