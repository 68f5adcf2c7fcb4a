"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader updates, sparse dot products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.llm.common import LOWER, mix, slices, stored, text_buffer, tidied, word_hashes

BUCKETS = 1 << 18
#: Labelled documents that training takes, about (thinned by a hash of the id); passes over them.
TRAIN_DOCS = 12_000
EPOCHS = 2
#: FTRL-proximal: learning rate, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.5

_BLANK = np.zeros(256, bool)
_BLANK[:33] = True
#: Classes of bytes for word shapes: lower case and other letters, capitals, digits, and each mark as it is.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text: sorted bucket numbers, and values of length 1 in all (log counts).

    The n-grams: words, pairs of words (a word twice over is one n-gram whatever the word), and the same of the words' shapes, in which runs of one class count once."""
    buf, offsets = text_buffer(column)
    words, at = word_hashes(LOWER[buf], offsets, _BLANK)
    shape = _SHAPE[buf]
    # One byte of each run of a class stays; ends of texts also end runs.
    stay = np.ones(len(shape), bool)
    stay[1:] = shape[1:] != shape[:-1]
    inner = offsets[1:-1]
    stay[inner[inner < len(shape)]] = True
    before = np.concatenate([[0], np.cumsum(stay)])
    shapes, at2 = word_hashes(shape[stay], before[offsets], _BLANK)
    for i in range(len(column)):
        w, s = words[at[i] : at[i + 1]], shapes[at2[i] : at2[i + 1]]
        parts = [w, mix(s ^ np.uint64(1))]
        if len(w) > 1:
            parts.append(np.where(w[1:] == w[:-1], np.uint64(12345), mix(w[:-1] * np.uint64(3) + w[1:])))
            parts.append(mix(s[:-1] * np.uint64(5) + s[1:]))
        key, n = np.unique((np.concatenate(parts) % np.uint64(BUCKETS)).astype(np.int32), return_counts=True)
        v = np.log1p(n)
        yield key, v / max(np.sqrt((v * v).sum()), 1e-12)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        got = list(features(b.column("text")))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([k for k, _ in got], pa.list_(pa.int32())), pa.array([v for _, v in got], pa.list_(pa.float64()))], ["doc_id", "y", "k", "v"])


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) after passes over the examples in their order."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weight(k: np.ndarray) -> np.ndarray:
        zk = z[k]
        return np.where(np.abs(zk) <= L1, 0.0, -(zk - np.sign(zk) * L1) / ((BETA + np.sqrt(n[k])) / ALPHA + L2))

    for _ in range(epochs):
        for k, v, y in examples:
            k, v = np.append(k, BUCKETS), np.append(v, 1.0)
            w = weight(k)
            p = 1 / (1 + np.exp(-np.clip(w @ v, -35, 35)))
            g = (p - y) * v
            s = (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / ALPHA
            z[k] += g - s * w
            n[k] += g * g
    return weight(np.arange(BUCKETS + 1))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples = [(np.asarray(k.values), np.asarray(v.values), y.as_py()) for b in batches for k, v, y in zip(b.column("k"), b.column("v"), b.column("y"), strict=True)]
    if examples:
        w = ftrl(examples)
        full = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(w[full])], ["k", "w"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", train: Column | None = None, train_docs: int = TRAIN_DOCS) -> np.ndarray:
    """Weights for documents whose label is not 0, from labels (doc_id, <label>) of ids for which train holds.

    Null ids and labels are left out; an id with several labels takes the more frequent, 1 on a tie. No label: zero weights, with which every score is 0.5. Training takes about train_docs labelled documents, chosen by a hash of the id (the documented bound, so the labels can be broadcast and one task can train), in the order of that hash."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if train is not None:
        rows = rows.where(F.coalesce(train, F.lit(False)))
    rows = rows.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.avg((F.col(label) != 0).cast("int")) >= 0.5).cast("int").alias("y"))
    total = rows.count()
    if total > train_docs:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * train_docs / total))
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(rows), "doc_id")
    ready = stored(found.select("doc_id", "y", "text").mapInArrow(tidied(_extract), "doc_id bigint, y int, k array<int>, v array<double>"), "examples")
    got = ready.repartition(1).sortWithinPartitions(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id", F.hash("k")).mapInArrow(tidied(_train), "k bigint, w double").toArrow()
    w = np.zeros(BUCKETS + 1)
    w[got.column("k").to_numpy()] = got.column("w").to_numpy()
    return w


def _score(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in slices(batches, "_q_text"):
            dots = np.array([w[k] @ v for k, v in features(b.column("_q_text"))]) + w[BUCKETS]
            score = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(score)], [*columns, "score"])

    return run


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns of docs (default: all but score and predicted, which are replaced), with score (0 to 1) and predicted (1 if score >= threshold) for each row's whole text.

    Null and empty texts score by the bias alone. Repeated rows are scored alike; an empty table gives no rows. The weights (2^18 + 1 doubles, 2 MB) are broadcast."""
    columns = keep or [c for c in docs.columns if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    ready = docs.select(*(F.col(f"`{c}`") for c in columns), F.coalesce("text", F.lit("")).alias("_q_text"))
    schema = docs.select(*(F.col(f"`{c}`") for c in columns)).schema.add("score", "double")
    return ready.mapInArrow(tidied(_score(shared, columns)), schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
