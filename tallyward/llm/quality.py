"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

1. Random indexing over *all* texts: every token falls in one of ``WORDS`` buckets by
   hash, each bucket has a sparse random index vector, and a bucket's context
   vector is the sum of the index vectors of its tokens' neighbours. Partial sums are
   merged in two rounds; their size is fixed, and they are whole numbers, so the result does
   not depend on the order of tasks.
2. A document is pooled from the unit context vectors of its tokens: their mean, the mean
   with square roots of the counts (which repetition moves away from the first), the number
   of tokens and the share of different ones.
3. A two-layer network is fitted in numpy on a bounded sample of labelled rows
   (``TRAIN_ROWS``); a temperature fitted on the fifth of them that was kept back
   calibrates its probabilities.

Rows: a null or empty text has zero vectors and the score the network gives those; each
repeated row is scored; a null doc_id is scored and, as crc32 of empty text, held out; without
labelled rows of both kinds every score is 0.5; an empty table gives no rows;
columns other than doc_id and text are no input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.common import Flat, flat_slices, fold, span_hash, tokens_of
from tallyward.llm.labelled import Fold, sample

TRAIN_ROWS = 12_000
WORDS = 1 << 12
DIM = 64
NONZERO = 2
REACH = 2
HIDDEN = 32
SEED = 7

#: A block of context vectors: what one merged row holds.
BLOCK_WORDS = WORDS // 16


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs (WORDS, NONZERO) of the random index vectors."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIM, (WORDS, NONZERO)), rng.choice([-1, 1], (WORDS, NONZERO))


def buckets_of(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Word bucket and row of every token."""
    tokens = tokens_of(flat)
    h = span_hash(flat.data, tokens.starts, tokens.ends)
    return (h >> np.uint64(64 - int(np.log2(WORDS)))).astype(np.int64), tokens.docs


def add_contexts(total: np.ndarray, words: np.ndarray, docs: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add to each word the index vectors of its neighbours in the same row."""
    for step in range(1, REACH + 1):
        same = docs[step:] == docs[:-step]
        left, right = words[:-step][same], words[step:][same]
        for a, b in ((left, right), (right, left)):
            for j in range(NONZERO):
                flat = np.bincount(a * DIM + places[b, j], weights=signs[b, j], minlength=WORDS * DIM)
                total += flat.astype(np.int64)


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (part, block, sums) added up by key inside each partition of a repartition by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, block, raw in zip(*(c.to_pylist() for c in batch.columns)):
                key = (part if "part" in keys else 0, block)
                sums[key] = sums.get(key, 0) + np.frombuffer(raw, np.int64)
        out = [(p, b, s.tobytes()) for (p, b), s in sums.items()]
        columns = list(zip(*out)) if out else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())], names=["part", "block", "sums"])

    return rows.repartition(*keys).mapInArrow(run, "part int, block int, sums binary")


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors (WORDS, DIM) of the tokens of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(WORDS * DIM, np.int64)
        for batch in batches:
            for flat in flat_slices(batch.column(0)):
                add_contexts(total, *buckets_of(flat), places, signs)
        blocks = total.reshape(-1, BLOCK_WORDS * DIM)
        names = ["part", "block", "sums"]
        numbers = pa.array(range(len(blocks)), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([0] * len(blocks), pa.int32()), numbers, pa.array([b.tobytes() for b in blocks], pa.binary())], names=names)

    texts = docs.select(F.col("text").cast("string").alias("text"))
    partial = texts.mapInArrow(run, "part int, block int, sums binary")
    partial = partial.withColumn("part", (F.spark_partition_id() / 64).cast("int"))  # 64 tasks' sums meet, then those of all
    rows = _merged(_merged(partial, ["part", "block"]), ["block"]).collect()  # one row for each block
    total = np.zeros((WORDS // BLOCK_WORDS, BLOCK_WORDS * DIM))
    for row in rows:
        total[row["block"]] += np.frombuffer(bytes(row["sums"]), np.int64)
    vectors = total.reshape(WORDS, DIM)
    return (vectors / np.maximum(1e-9, np.linalg.norm(vectors, axis=1, keepdims=True))).astype(np.float32)


def pooled(flat: Flat, vectors: np.ndarray) -> np.ndarray:
    """Features (rows, 2 * DIM + 2) of the texts of a Flat."""
    words, docs = buckets_of(flat)
    out = np.zeros((len(flat), 2 * DIM + 2), np.float32)
    for at in range(0, len(flat), 128):
        rows = min(128, len(flat) - at)
        lo, hi = np.searchsorted(docs, [at, at + rows])
        counts = np.bincount((docs[lo:hi] - at) * WORDS + words[lo:hi], minlength=rows * WORDS).reshape(rows, WORDS).astype(np.float32)
        n = counts.sum(axis=1, keepdims=True)
        different = (counts > 0).sum(axis=1, keepdims=True)
        out[at : at + rows, :DIM] = counts @ vectors / np.maximum(1, n)
        np.sqrt(counts, out=counts)
        out[at : at + rows, DIM : 2 * DIM] = counts @ vectors / np.maximum(1, counts.sum(axis=1, keepdims=True))
        out[at : at + rows, 2 * DIM :] = np.concatenate([np.log1p(n), different / np.maximum(1, n)], axis=1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x).astype(np.float64) / self.temperature)


def fit_network(x: np.ndarray, y: np.ndarray, steps: int = 2000, batch: int = 256, decay: float = 1e-4) -> Network:
    """Adam on the cross entropy; the last fifth of the (shuffled) rows fits the temperature."""
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(x))
    x, y = x[order], y[order].astype(np.float32)
    kept_back = len(x) // 5
    fit_x, fit_y = x[kept_back:], y[kept_back:]
    net = Network(fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-4, rng.normal(0, (1 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), np.zeros(HIDDEN, np.float32), float(np.log((fit_y.mean() + 1e-3) / (1 - fit_y.mean() + 1e-3))))
    z = ((fit_x - net.mean) / net.scale).astype(np.float32)
    params = [net.w1, net.b1, net.w2, np.array([net.b2], np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < batch:  # another pass over the rows
            order = np.concatenate([order, rng.permutation(len(z))])
        rows, order = order[:batch], order[batch:]
        hidden = np.tanh(z[rows] @ params[0] + params[1])
        error = (_sigmoid(hidden @ params[2] + params[3]) - fit_y[rows])[:, None] / len(rows)
        back = error * params[2] * (1 - hidden * hidden)
        slopes = [z[rows].T @ back + decay * params[0], back.sum(axis=0), (hidden * error).sum(axis=0) + decay * params[2], error.sum(axis=0)]
        rate = 0.004 * (1 - step / (steps + 1))
        for p, g, m, v in zip(params, slopes, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if kept_back >= 20:
        logits, truth = net.logits(x[:kept_back]).astype(np.float64), y[:kept_back]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
        loss = [-np.mean(np.log(np.where(truth == 1, p := _sigmoid(logits / t), 1 - p) + 1e-12)) for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network | None


def fit_quality(docs: DataFrame, labels: DataFrame, column: str = "quality", held: Fold = (5, 0), train_rows: int = TRAIN_ROWS) -> QualityModel:
    vectors = word_vectors(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [pooled(flat, vectors) for flat in flat_slices(batch.column(0))]
            raw = [r.tobytes() for p in parts for r in p]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), batch.column(1), batch.column(2)], names=["x", "label", "doc_id"])

    rows = sample(docs, labels, column, held, train_rows).select("text", "label", "doc_id")
    rows = rows.mapInArrow(run, "x binary, label int, doc_id long").collect()  # bounded by train_rows
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    y = np.array([r["label"] for r in rows])
    if len(set(y.tolist())) < 2:
        return QualityModel(vectors, None)
    return QualityModel(vectors, fit_network(np.array([np.frombuffer(bytes(r["x"]), np.float32) for r in rows]), y))


def score_quality(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: the probability of label 1, from the text alone."""
    docs = docs.select(*[F.col(c) for c in docs.columns if c != name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            score = np.full(batch.num_rows, 0.5)
            for flat in flat_slices(column) if model.network else ():
                score[flat.first : flat.first + len(flat)] = model.network.probabilities(pooled(flat, model.vectors))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify_quality(docs: DataFrame, labels: DataFrame, held: Fold = (5, 0), threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score_quality(rows, fit_quality(docs, labels, held=held)).drop("text")
    return scored.select("doc_id", (fold("doc_id", held[0]) == held[1]).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
