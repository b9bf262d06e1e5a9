"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is a fixed list of insults and, learned from the fitted sample, the words that
are far more frequent in its toxic texts than in the others. Features of a text:
lexicon densities (listed, learned, strongest, summed weight), how near lexicon words
stand to a second person, shares of capitals and of capitalised words, punctuation
rates, and obfuscation rates (digits inside words, spaced-out letters, words that are
in the lexicon only when digits are read as letters).

Trees are fitted in numpy on a bounded sample of labelled rows (``TRAIN_ROWS``); the third
of them that was kept back from trees and lexicon fits the isotonic calibration.

Rows: a null or empty text has all features zero and the score the trees give that;
each repeated row is scored; a null doc_id is scored; without labelled rows of both kinds
every score is 0.5; an empty table gives no rows; columns other than doc_id and text
are no input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.common import LOWER, Flat, flat_slices, fold, hash_word, mix, prefix_hash, span_hash, tokens_of
from tallyward.llm.labelled import Fold, sample

TRAIN_ROWS = 12_000
#: Learned words at most, and texts of the sample that must hold one.
LEARNED_WORDS = 256
LEAST_TEXTS = 4
#: Words between a lexicon word and a second person that still count as near.
NEAR = 4

# Insults, and second-person words of the corpus's languages.
INSULTS = "arse asshole bastard bitch cretin damn disgusting dumb dumbass fool freak garbage hate hateful idiot idiotic imbecile jerk kill loser lunatic maggot moron moronic nasty parasite pathetic pig repulsive retard rubbish scum shit shut sick stupid suck terrible trash ugly useless vermin vile worthless"
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch sie tu toi te ton ta tes vous votre vos ti tus usted ustedes vosotros os"

_LEET = LOWER.copy()
for _digit, _letter in zip(b"013457", b"oieast"):
    _LEET[_digit] = _letter

N_FEATURES = 19


def _table(words: str) -> np.ndarray:
    return np.sort(np.array([hash_word(w) for w in words.split()], np.uint64))


LISTED, PERSONS = _table(INSULTS), _table(SECOND_PERSON)


@dataclass
class Lexicon:
    """Hashes of learned words, ascending, and their weights (log odds)."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def weight(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.weights[at], 0.0)


def _in(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h


def word_hashes(flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Hash (lower case) and row of every word."""
    tokens = tokens_of(flat)
    words = tokens.is_word
    return span_hash(LOWER[flat.data], tokens.starts[words], tokens.ends[words]), tokens.docs[words]


def features(flat: Flat, lexicon: Lexicon) -> np.ndarray:
    """Dense features (rows, N_FEATURES)."""
    n = len(flat)
    out = np.zeros((n, N_FEATURES))
    data, tokens = flat.data, tokens_of(flat)
    word = tokens.is_word
    starts, ends, docs = tokens.starts[word], tokens.ends[word], tokens.docs[word]
    count = lambda of, values=None: np.bincount(of, weights=values, minlength=n)
    n_words, n_bytes = np.maximum(1, count(docs)), np.maximum(1, np.diff(flat.offsets))

    lower = LOWER[data]
    h = span_hash(lower, starts, ends)
    listed, weight = _in(LISTED, h), lexicon.weight(h)
    digit = (data >= 0x30) & (data <= 0x39)
    digits = np.concatenate([[0], np.cumsum(digit)])
    upper = (data >= 0x41) & (data <= 0x5A)
    uppers = np.concatenate([[0], np.cumsum(upper)])
    size = ends - starts
    with_digit = digits[ends] - digits[starts]
    mixed = (with_digit > 0) & (with_digit < size)
    disguised = np.zeros(len(h), bool)
    if mixed.any():
        total, down = prefix_hash(_LEET[data])
        leet = mix((total[ends[mixed]] - total[starts[mixed]]) * down[starts[mixed]])
        disguised[mixed] = _in(LISTED, leet) | (lexicon.weight(leet) > 0)
    hit = listed | (weight > 0) | disguised

    person = np.flatnonzero(_in(PERSONS, h))
    near = np.zeros(len(h), bool)
    if len(person) and hit.any():
        at = np.flatnonzero(hit)
        k = np.searchsorted(person, at)
        for side in (np.maximum(k - 1, 0), np.minimum(k, len(person) - 1)):
            other = person[side]
            near[at] |= (np.abs(other - at) <= NEAR) & (docs[other] == docs[at])

    marks = ~word
    mark_docs, mark_size = tokens.docs[marks], (tokens.ends - tokens.starts)[marks]
    single = (size == 1) & (data[starts] >= 0x41) if len(starts) else np.zeros(0, bool)
    spaced = single.copy()
    if len(single) > 2:
        spaced[1:-1] = single[1:-1] & single[:-2] & single[2:]
        spaced[[0, -1]] = False
    row_of = np.repeat(np.arange(n), np.diff(flat.offsets))
    strongest = np.zeros(n)
    np.maximum.at(strongest, docs, weight)

    out[:, 0] = np.log1p(count(docs))
    out[:, 1] = count(docs, listed)
    out[:, 2] = out[:, 1] / n_words
    out[:, 3] = count(docs, weight > 0)
    out[:, 4] = out[:, 3] / n_words
    out[:, 5] = count(docs, weight)
    out[:, 6] = out[:, 5] / n_words
    out[:, 7] = strongest
    out[:, 8] = count(docs[person]) / n_words
    out[:, 9] = count(docs, near)
    out[:, 10] = out[:, 9] / n_words
    out[:, 11] = count(row_of, upper) / n_bytes
    out[:, 12] = count(docs, (size > 1) & (uppers[ends] - uppers[starts] == size)) / n_words
    out[:, 13] = count(mark_docs) / n_words
    out[:, 14] = count(row_of, data == 0x21) / n_bytes
    out[:, 15] = count(mark_docs, mark_size > 1) / n_words
    out[:, 16] = count(docs, mixed) / n_words
    out[:, 17] = count(docs, disguised)
    out[:, 18] = count(docs, spaced) / n_words
    return out


# --- trees ------------------------------------------------------------------


@dataclass
class Trees:
    """Complete trees of one depth: a node's children are 2i + 1 and 2i + 2."""

    depth: int
    start: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, leaves)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**self.depth - 1)]
        return total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, ridge: float = 1.0, bins: int = 48) -> Trees:
    """Boosted trees on the logistic loss, split by histograms of quantile bins."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    prior = (y.sum() + 1) / (len(y) + 2)
    model = Trees(depth, float(np.log(prior / (1 - prior))), *(np.zeros((trees, 2**depth - 1), t) for t in (np.int64, np.float64)), np.zeros((trees, 2**depth)))
    model.cut[:] = np.inf
    margin = np.full(len(y), model.start)
    for t in range(trees):
        p = _sigmoid(margin)
        slope, curve = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            base, width = 2**level - 1, 2**level
            own = node - base
            best = np.zeros(width)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = own * (len(e) + 1) + binned[:, f]
                g = np.bincount(key, slope, width * (len(e) + 1)).reshape(width, -1)
                c = np.bincount(key, curve, width * (len(e) + 1)).reshape(width, -1)
                left_g, left_c = np.cumsum(g, axis=1)[:, :-1], np.cumsum(c, axis=1)[:, :-1]
                all_g, all_c = g.sum(axis=1, keepdims=True), c.sum(axis=1, keepdims=True)
                right_g, right_c = all_g - left_g, all_c - left_c
                gain = left_g**2 / (left_c + ridge) + right_g**2 / (right_c + ridge) - all_g**2 / (all_c + ridge)
                gain[(left_c < 0.5) | (right_c < 0.5)] = 0
                at = gain.argmax(axis=1)
                better = gain[np.arange(width), at] > best + 1e-9
                best[better] = gain[np.arange(width), at][better]
                model.feature[t, base : base + width][better] = f
                model.cut[t, base : base + width][better] = e[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), model.feature[t, node]] > model.cut[t, node])
        leaf = node - (2**depth - 1)
        g, c = np.bincount(leaf, slope, 2**depth), np.bincount(leaf, curve, 2**depth)
        model.leaf[t] = rate * g / (c + ridge)
        margin += model.leaf[t][leaf]
    return model


@dataclass
class Isotonic:
    """A rising piecewise-linear map of the trees' probability."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, p: np.ndarray) -> np.ndarray:
        return np.interp(p, self.at, self.value)


def fit_isotonic(p: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; a block's value is its share of label 1."""
    at, first = np.unique(p, return_inverse=True)
    weight, total = np.bincount(first).astype(float), np.bincount(first, y)
    blocks: list[list[float]] = []  # weight, label sum, probability sum
    for a, w, s in zip(at, weight, total):
        blocks.append([w, s, a * w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [x + z for x, z in zip(blocks[-1], last)]
    return Isotonic(np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks]))


# --- fitting and scoring ----------------------------------------------------


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Trees | None
    calibration: Isotonic | None

    def scores(self, flat: Flat) -> np.ndarray:
        if self.trees is None:
            return np.full(len(flat), 0.5)
        p = _sigmoid(self.trees.margin(features(flat, self.lexicon)))
        return np.clip(0.98 * self.calibration(p) + 0.02 * p, 0, 1)  # the trees order what a block ties


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words that are much likelier in texts (text, label) of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for flat in flat_slices(batch.column(0)):
                h, docs = word_hashes(flat)
                pairs = np.unique(np.stack([h, docs.astype(np.uint64)]), axis=1)
                toxic = label[flat.first + pairs[1].astype(np.int64)]
                words, which = np.unique(pairs[0], return_inverse=True)
                ones = np.bincount(which, toxic).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(ones), pa.array(np.bincount(which) - ones)], names=["word", "ones", "zeros"])

    counts = rows.select("text", "label").mapInArrow(run, "word long, ones long, zeros long")
    counts = counts.groupBy("word").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    total = rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    ones, zeros = (total[0] or 0) + 1, (total[1] or 0) + 1
    odds = F.log((F.col("ones") + 0.5) / ones) - F.log((F.col("zeros") + 0.5) / zeros)
    found = counts.where(F.col("ones") >= LEAST_TEXTS).withColumn("weight", odds).where("weight > 1.5")
    kept = found.orderBy(F.desc(F.col("weight") * F.sqrt("ones")), "word").limit(LEARNED_WORDS).collect()
    hashes = np.array([r["word"] for r in kept], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], np.array([r["weight"] for r in kept])[order])


def fit_toxicity(docs: DataFrame, labels: DataFrame, column: str = "toxic", held: Fold = (3, 1), train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    # the sample is bounded: it is cached while lexicon and features are read from it
    rows = sample(docs, labels, column, held, train_rows).withColumn("part", fold("doc_id", 101) % 3).persist()
    try:
        lexicon = learn_lexicon(rows.where("part > 0"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw = [r.tobytes() for flat in flat_slices(batch.column(0)) for r in features(flat, lexicon)]
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), *batch.columns[1:]], names=["x", "label", "part", "doc_id"])

        got = rows.select("text", "label", F.col("part").cast("int"), "doc_id").mapInArrow(run, "x binary, label int, part int, doc_id long").collect()
    finally:
        rows.unpersist()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    y, back = np.array([r["label"] for r in got], float), np.array([r["part"] == 0 for r in got], bool)
    if len(set(y[~back].tolist())) < 2:
        return ToxicityModel(lexicon, None, None)
    x = np.array([np.frombuffer(bytes(r["x"])) for r in got])
    trees = fit_trees(x[~back], y[~back])
    held_back = back if len(set(y[back].tolist())) == 2 else ~back
    return ToxicityModel(lexicon, trees, fit_isotonic(_sigmoid(trees.margin(x[held_back])), y[held_back]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: the probability of label 1, from the text alone."""
    docs = docs.select(*[F.col(c) for c in docs.columns if c != name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.scores(flat) for flat in flat_slices(batch.column(batch.schema.get_field_index("text")))]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify_toxicity(docs: DataFrame, labels: DataFrame, held: Fold = (3, 1), threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score_toxicity(rows, fit_toxicity(docs, labels, held=held)).drop("text")
    return scored.select("doc_id", (fold("doc_id", held[0]) == held[1]).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
