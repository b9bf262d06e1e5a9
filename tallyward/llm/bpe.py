"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the code points cuts each text into chunks whose borders
depend on the text around them alone, so documents that share a passage share
its chunks. A worker encodes a chunk once and keeps its ids (``CHUNK_BYTES`` of
them at most) for the documents and tasks that follow.

A cut may fall inside a word, so chunk joins are repaired: ids agree with those of the
whole text between *sure* places, where white space follows a visible character
and no token can span. A chunk keeps the ids between its first and its last sure
place; what lies around a join, from the last sure place on its left to the
first on its right, is encoded again as one text. A chunk without a sure place is
taken into that text, which so grows until both ends agree.

Reuse is by worker, not by a shuffled chunk table: shipping ids of shared chunks
back to their documents moves more bytes than encoding them costs.

Rows: null and empty texts have no ids; each repeated row gives its own row; a null
doc_id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.codec import Codec
from tallyward.llm.common import batch_texts, mix

#: Code points that decide on a cut, and the mean chunk length they give.
WINDOW = 16
MEAN_CHUNK = 512

#: Bytes of text and ids that a worker's chunk table may hold.
CHUNK_BYTES = 64 << 20

#: Texts are worked on together up to this many code points.
GROUP_CHARS = 1 << 20

# White space that every pattern library knows, after a visible character.
_SURE = re.compile(r"(?<=[^\s\x1c-\x1f\x85])[ \n\t\r]")


def chunk_cuts(text: str) -> np.ndarray:
    """Where the rolling hash of the last WINDOW code points ends a chunk."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(points) <= WINDOW:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = points * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        step = 1
        while step < WINDOW:  # h[i] becomes the sum of the last WINDOW values, each shifted by its age
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
            step *= 2
    cut = np.flatnonzero(mix(h.astype(np.uint64)) % np.uint64(MEAN_CHUNK) == 0) + 1
    return cut[(cut >= WINDOW) & (cut < len(points))]


def chunks(text: str, cuts: np.ndarray) -> list[str]:
    at = [0, *cuts.tolist(), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:])]


def sure_places(chunk: str) -> tuple[int, int] | None:
    """The first and last place of a chunk that no token spans."""
    first = _SURE.search(chunk)
    if not first:
        return None
    last = len(chunk)
    while last > first.start():
        last = max(chunk.rfind(c, 0, last) for c in " \n\t\r")
        if _SURE.match(chunk, last):
            return first.start(), last
    return first.start(), first.start()


class ChunkTable:
    """Ids of the inner part of chunks, the longest unused leave first."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.known: OrderedDict[str, tuple[str, np.ndarray, str] | None] = OrderedDict()
        self.bytes = 0

    def parts(self, wanted: set[str]) -> dict:
        """Chunk -> (head, ids between its sure places, tail), or None if it has none."""
        out, new = {}, []
        for chunk in wanted:
            if chunk in self.known:
                self.known.move_to_end(chunk)
                out[chunk] = self.known[chunk]
            else:
                new.append((chunk, sure_places(chunk)))
        inner = self.codec.encode_many([c[s[0] : s[1]].encode() for c, s in new if s])
        ids = iter(inner)
        for chunk, sure in new:
            # a copy, so that a kept chunk does not keep its whole batch
            out[chunk] = (chunk[: sure[0]], next(ids).copy(), chunk[sure[1] :]) if sure else None
            if len(chunk) <= 16 * MEAN_CHUNK:
                self.known[chunk] = out[chunk]
                self.bytes += 8 * len(chunk) + 300
        while self.bytes > CHUNK_BYTES:
            gone, _ = self.known.popitem(last=False)
            self.bytes -= 8 * len(gone) + 300
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [chunks(t, chunk_cuts(t)) if t else [] for t in texts]
        parts = self.parts({c for own in cut for c in own})
        plans, joints = [], []
        for own in cut:
            plan: list[np.ndarray | int] = []
            pending = ""
            for chunk in own:
                part = parts[chunk]
                if part is None:
                    pending += chunk
                    continue
                head, ids, tail = part
                plan += [len(joints), ids]
                joints.append((pending + head).encode())
                pending = tail
            plan.append(len(joints))
            joints.append(pending.encode())
            plans.append(plan)
        repaired = self.codec.encode_many(joints)
        return [np.concatenate([repaired[x] if isinstance(x, int) else x for x in plan]) for plan in plans]


_TABLES: dict[str, ChunkTable] = {}


def groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about GROUP_CHARS together, with the first one's place."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= GROUP_CHARS:
            yield start, texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def encode_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, token_ids array<int>, decoded string) of every text."""
    return _map(docs, vocabulary, id_column, text_column, "doc_id long, token_ids array<int>, decoded string", lambda codec, doc_id, ids: (doc_id, ids.tolist(), codec.decode(ids)))


def bpe_digests(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digests of ``encode_documents``,
    taken in the task so that the ids need not leave it."""

    def digest(codec: Codec, doc_id, ids: np.ndarray) -> tuple:
        decoded = codec.decode(ids).encode()
        return doc_id, len(ids), hashlib.sha256(codec.as_decimals(ids)).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return _map(docs, vocabulary, id_column, text_column, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


def _map(docs: DataFrame, vocabulary: str, id_column: str, text_column: str, schema: str, row) -> DataFrame:
    types = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    fields = [pa.field(x.split()[0], types[x.split()[1]]) for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _TABLES:
            _TABLES[vocabulary] = ChunkTable(Codec.of(vocabulary))
        table = _TABLES[vocabulary]
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch_texts(batch.column(1))
            for start, some in groups(texts):
                rows = [row(table.codec, doc_ids[start + i], ids) for i, ids in enumerate(table.encode(some))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=pa.schema(fields))

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(run, schema)
