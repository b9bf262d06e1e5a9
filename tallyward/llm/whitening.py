"""Embedding whitening from a bit-sliced scatter matrix.

Entries become integers x = floor(256 c). Every distinct vector counts once in the fit: rows
travel as packed bytes and are combined in the task before the shuffle, so a vector that a third
of all rows have is one row a task.

``scatter`` takes the exact cross-products of a block of vectors: each dimension is shifted
to begin at 0, its bit planes are packed across the rows into 64-bit words, and the sum of x_i x_j is
the sum over planes a, b of 2^(a+b) times the set bits of plane a of i AND plane b of j. Blocks
and tasks add up as integers of any size; to the driver go the sums alone, of which a dimension d has
d (d + 3) / 2 + 1, however many vectors there are. There they are centred as integers,
n XX - S S', and divided by n squared before ``eigh``.

Whitening is a second pass over the rows: (n x - S) / n, projected on the first components and divided
by the root of their eigenvalues.

Rows: vectors null or holding null or non-finite entries are dropped, empty ones have no components; a
null vec_id stays null; repeated rows are whitened each; vectors of different dimensions are
whitened apart; components whose eigenvalue is 0 (to rounding) do not exist, so equal vectors have
no rows, nor has a vector of a dimension that was not fitted; x beyond 64 bits is the largest or smallest long; a deviation over 38 digits is null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Vectors whose bit planes are packed at once.
BLOCK = 4096
#: Words that a step of the popcounts may hold.
STEP_WORDS = 1 << 18
#: Bits of a part of an integer on its way through an aggregate: 2^23 tasks fit a long.
LIMB = 40

_SUMS = "dim int, i int, j int, limb int, value long"
_WHITENED = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def quantised(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their integers (rows, dim), for each dimension in it."""
    there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    lists = column.take(pa.array(there))
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # null is nan
    offsets = lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    sizes = np.diff(offsets)
    good = wrong[offsets[1:]] == wrong[offsets[:-1]]
    for dim in np.unique(sizes[good & (sizes > 0)]).tolist():
        rows = np.flatnonzero(good & (sizes == dim))
        with np.errstate(over="ignore"):
            y = np.floor(SCALE * values[offsets[rows, None] + np.arange(dim)])
        x = np.clip(y, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
        x[y >= 2.0**63] = np.iinfo(np.int64).max
        yield there[rows], x


def packed(x: np.ndarray) -> Iterator[pa.Array]:
    """Each vector as bytes: its width and its integers, in two bytes each where they fit."""
    small = (x == x.astype(np.int16)).all(axis=1)
    for rows, kind in ((x[small], "<i2"), (x[~small], "<i8")):
        if len(rows):
            width = np.dtype(kind).itemsize
            data = np.empty((len(rows), 1 + width * rows.shape[1]), np.uint8)
            data[:, 0] = width
            data[:, 1:] = rows.astype(kind).view(np.uint8)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(data.shape[1])
            yield pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(column: pa.Array) -> Iterator[np.ndarray]:
    """The vectors of a batch of packed ones, those of a length and width together."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    sizes, widths = np.diff(offsets), data[offsets[:-1]]
    for width in (2, 8):
        for size in np.unique(sizes[widths == width]).tolist():
            rows = offsets[:-1][(widths == width) & (sizes == size)]
            body = data[rows[:, None] + np.arange(1, size)]
            yield body.view(f"<i{width}").astype(np.int64)


def _set_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(d, d): set bits of each row of a AND each row of b."""
    out = np.empty((len(a), len(b)), np.int64)
    step = max(1, STEP_WORDS // max(1, b.size))
    for at in range(0, len(a), step):
        out[at : at + step] = np.bitwise_count(a[at : at + step, None, :] & b[None, :, :]).sum(axis=-1, dtype=np.int64)
    return out


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums S (d) and cross-products XX (d, d) of the rows of x, as Python integers."""
    n, dim = x.shape
    low = x.min(axis=0)
    u = x.astype(np.uint64) - low.astype(np.uint64)  # exact: the difference fits 64 bits without sign
    bits = int(u.max()).bit_length()
    planes = []
    for b in range(bits):
        column = np.packbits(((u >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=0).T
        whole = np.zeros((dim, -(-column.shape[1] // 8) * 8), np.uint8)
        whole[:, : column.shape[1]] = column
        planes.append(whole.view(np.uint64))
    wide = object if 2 * bits + n.bit_length() >= 63 else np.int64
    sums, products = np.zeros(dim, wide), np.zeros((dim, dim), wide)
    for a, plane in enumerate(planes):
        sums += np.bitwise_count(plane).sum(axis=1, dtype=np.int64).astype(wide) * (1 << a)
        products += _set_bits(plane, plane).astype(wide) * (1 << 2 * a)
        for b in range(a + 1, bits):
            both = _set_bits(plane, planes[b])
            products += (both + both.T).astype(wide) * (1 << (a + b))
    sums, products, low = sums.astype(object), products.astype(object), low.astype(object)
    cross = np.outer(low, sums)
    return sums + n * low, products + cross + cross.T + n * np.outer(low, low)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, rest, k = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        yield k, sign * (rest & ((1 << LIMB) - 1))
        rest >>= LIMB
        k += 1


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task's vectors: (dim, -1, -1) their number, (dim, -1, j) S, (dim, i, j) XX for i <= j."""
    total: dict[int, list] = {}
    for batch in batches:
        for x in unpacked(batch.column(0)):
            for at in range(0, len(x), BLOCK):
                block = x[at : at + BLOCK]
                s, xx = scatter(block)
                old = total.setdefault(x.shape[1], [0, 0, 0])
                total[x.shape[1]] = [old[0] + len(block), old[1] + s, old[2] + xx]
    names = [f.split()[0] for f in _SUMS.split(", ")]
    for dim, (n, s, xx) in total.items():
        rows = [(dim, -1, -1, *part) for part in _limbs(n)]
        for j in range(dim):
            rows += [(dim, -1, j, *part) for part in _limbs(s[j])]
            rows += [(dim, i, j, *part) for i in range(j + 1) for part in _limbs(xx[i, j])]
        types = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


@dataclass
class Whitening:
    """The components of the vectors of one dimension."""

    n: int
    sums: np.ndarray  # S, Python integers
    values: np.ndarray  # falling eigenvalues
    axes: np.ndarray  # (dim, components), unit
    explained: np.ndarray
    identity_error: float


def components_of(n: int, sums: np.ndarray, products: np.ndarray, most: int) -> Whitening:
    centred = n * products - np.outer(sums, sums)
    square = n * n
    covariance = np.array([[v / square for v in row] for row in centred], np.float64)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    real = values > max(0.0, values[0]) * len(sums) * np.finfo(float).eps
    values, axes = values[real], axes[:, real]
    explained = values / (int(np.trace(centred)) / square) if len(values) else values
    scaled = axes / np.sqrt(values)
    error = np.abs(scaled.T @ covariance @ scaled - np.eye(len(values))).max(initial=0.0)
    return Whitening(n, sums, values, axes, explained, float(error))


def fit_whitening(table: DataFrame, components: int = 4, vector_column: str = "embedding") -> dict[int, Whitening]:
    """The components of each dimension that vectors have."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in quantised(batch.column(0)):
                for keys in packed(x):
                    yield pa.RecordBatch.from_arrays([keys], names=["key"])

    distinct = table.select(F.col(vector_column).cast("array<double>").alias("v")).mapInArrow(pack, "key binary").distinct()
    sums = distinct.mapInArrow(_partial_sums, _SUMS).groupBy("dim", "i", "j", "limb").agg(F.sum("value").alias("value"))
    models: dict[int, list] = {}
    for row in sums.collect():  # as many as a dimension has pairs, whatever the table's size
        dim, value = row["dim"], row["value"] << (LIMB * row["limb"])
        model = models.setdefault(dim, [0, np.zeros(dim, object), np.zeros((dim, dim), object)])
        if row["j"] < 0:
            model[0] += value
        elif row["i"] < 0:
            model[1][row["j"]] += value
        else:
            model[2][row["i"], row["j"]] += value
            if row["i"] != row["j"]:
                model[2][row["j"], row["i"]] += value
    return {dim: components_of(*model, components) for dim, model in models.items()}


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """n x - S as doubles, and the sum of its squares over the dimensions, exact."""
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        off = n * x - sums.astype(np.int64)
        return off.astype(np.float64), pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
    off = n * x.astype(object) - sums
    squares = [v if v < 10**38 else None for v in (off * off).sum(axis=1)]
    return off.astype(np.float64), pa.array([None if v is None else Decimal(v) for v in squares], pa.decimal128(38, 0))


def whiten(table: DataFrame, models: dict[int, Whitening], id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in quantised(batch.column(1)):
                model = models.get(x.shape[1])
                if model is None:  # of another table: no vector of this dimension was fitted
                    continue
                k = len(model.values)
                off, squares = deviations(x, model.n, model.sums)
                white = (off / model.n) @ (model.axes / np.sqrt(model.values))
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                columns = [
                    batch.column(0).take(pa.array(rows)).take(each),
                    pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                    pa.array(np.full(len(each), model.n)),
                    squares.take(each),
                    pa.array(white.reshape(-1)),
                    pa.array(np.tile(model.explained, len(rows))),
                    pa.array(np.full(len(each), model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _WHITENED.split(", ")])

    chosen = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    return chosen.mapInArrow(run, _WHITENED)


def whiten_embeddings(table: DataFrame, components: int = 4) -> DataFrame:
    """``table`` whitened by its own components."""
    return whiten(table, fit_whitening(table, components))
