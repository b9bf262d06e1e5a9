"""Helpers shared by the operators of this subpackage: table access, written
stages, Arrow batches as flat byte arrays, and vectorised tokens over them."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.session import fresh_dir

#: Bytes of text worked on at once inside a task (a longer text is worked on alone).
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch on its way to a Python worker (a longer row travels alone): both sides of
#: the way hold a batch or two.
ARROW_BYTES = 8 << 20


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (local mode, or a
    folder that all machines have; elsewhere the job is submitted with it, ``--py-files``), and
    get their rows in batches of ``ARROW_BYTES`` (a setting of the session, 64 MB by default)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    given = spark.sparkContext.environment
    paths = [p for p in given.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        given["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and a
    lost executor costs a read instead of a recomputation."""
    path = fresh_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, partitions: int, label: str) -> DataFrame:
    """``df`` as a written table bucketed by ``key``: joins by the key shuffle the other side
    only. At least as many buckets as a shuffle has partitions, or joins would not use them.
    The table is scratch like ``written``; where the catalog outlives the session, its
    entry (``llm_<label>_<id>``) stays and may be dropped."""
    spark = df.sparkSession
    name = f"llm_{label}_{uuid.uuid4().hex[:12]}"
    n = max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.write.bucketBy(n, key).sortBy(key).option("path", fresh_dir(spark, f"llm-{label}")).saveAsTable(name)
    return spark.table(name)


def fold(column: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(modulus))


@dataclass
class Flat:
    """Texts of consecutive rows as one byte array; row i is data[offsets[i]:offsets[i+1]]."""

    data: np.ndarray
    offsets: np.ndarray
    first: int  # row of the batch that offsets[0] belongs to

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def row(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def flat_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[Flat]:
    """A string column, null as empty, in runs of rows of about ``slice_bytes``."""
    binary = pc.fill_null(column, "").cast(pa.large_string()).cast(pa.large_binary())
    if not len(binary):
        return
    offsets = np.frombuffer(binary.buffers()[1], dtype=np.int64)[binary.offset : binary.offset + len(binary) + 1]
    buffer = binary.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(binary):
        end = int(np.searchsorted(offsets, offsets[row] + slice_bytes, side="right")) - 1
        end = min(len(binary), max(row + 1, end))
        yield Flat(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], row)
        row = end
    _give_back()


def _give_back() -> None:
    """Return memory that numpy and Arrow have freed to the machine: workers live on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def batch_texts(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


# --- tokens -----------------------------------------------------------------

_SPACE, _WORD, _MARK = 0, 1, 2


def _classes() -> np.ndarray:
    kinds = np.full(256, _MARK, np.uint8)
    kinds[[0x20, *range(0x09, 0x0E)]] = _SPACE
    for lo, hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        kinds[lo:hi] = _WORD
    return kinds


CLASSES = _classes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            if n > 2 * SLICE_BYTES:  # one very long text: not kept
                return _powers(_BASE, n), _powers(_INVERSE, n)
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up[:n], cls.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit hash over all its bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial hash (wrapping 64-bit) and the factors that shift a span to 0."""
    up, down = _Powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return total, down


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total, down = prefix_hash(data)
    return mix((total[ends] - total[starts]) * down[starts])


def hash_word(word: str) -> int:
    """The hash that ``span_hash`` gives the bytes of one word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hash(data, np.array([0]), np.array([len(data)]))[0])


@dataclass
class Tokens:
    """Maximal runs of word characters, and of other visible ones, of a Flat."""

    starts: np.ndarray
    ends: np.ndarray
    kinds: np.ndarray  # _WORD or _MARK
    docs: np.ndarray

    @property
    def is_word(self) -> np.ndarray:
        return self.kinds == _WORD


def tokens_of(flat: Flat) -> Tokens:
    if not len(flat.data):
        none = np.zeros(0, np.int64)
        return Tokens(none, none, np.zeros(0, np.uint8), none)
    kinds = CLASSES[flat.data]
    cut = np.empty(len(kinds), bool)
    cut[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=cut[1:])
    inner = flat.offsets[:-1]
    cut[inner[inner < len(kinds)]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(kinds))
    kind = kinds[starts]
    seen = kind != _SPACE
    starts, ends, kind = starts[seen], ends[seen], kind[seen]
    docs = np.searchsorted(flat.offsets, starts, side="right") - 1
    return Tokens(starts, ends, kind, docs)
