"""Suffix-array dedup by a run-length index: long matches across documents.

A byte is removed if a ``LENGTH``-byte string over it also starts in a document with a smaller
doc_id. All comparisons are on the input; matches never cross documents.

Strings are brought together by content. Every ``LENGTH``-byte window has an *anchor*, the
``K`` bytes in it with the least hash; consecutive windows with one anchor make a *context*
(their bytes together). Equal windows have equal anchors, so:

1. Texts are stored as compressed batches (about ``BATCH_BYTES`` of text), once, in a table
   bucketed by batch: what comes back to a batch is joined without shuffling texts.
2. Batches deal the different anchors that they hold, packed, to buckets by hash. A bucket
   answers each batch with one bit for each anchor: does another document hold it?
3. Batches deal the different contexts of shared anchors, packed, to buckets by anchor.
   A bucket merges equal contexts. Where an anchor has several contexts it builds the
   run-compressed Burrows-Wheeler index of them (``rlbwt.RunIndex``) and streams
   matching statistics; every window gets the smallest doc_id that has it, and a
   batch gets a bit for each window of its contexts: does a smaller doc_id have it?
4. A batch marks the bytes of its windows and keeps the others.

What repeats in a batch leaves it once (a line that all documents share is one context a
batch), rows are packed arrays, and the number of buckets grows with the text. Where such a
line meets the rest of each document, though, its outermost anchors have as many
contexts as there are documents. An anchor whose different contexts, as its batches count them, have
over ``hot_bytes`` bytes is *hot*: no index is larger than about that, at any size of the corpus. Its windows are dealt one by one, by their own hash, to buckets that answer in
the same way, so they spread however many there are.

Rows: a null or empty text has nothing to remove; of rows with equal doc_id none is the
smaller; a null doc_id is neither compared nor cut; an empty table gives no rows; extra
columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.common import Flat, bucketed, flat_slices, mix, prefix_hash, span_hash, written
from tallyward.llm.rlbwt import RunIndex

LENGTH = 50
K = 16
#: K-byte strings in a window.
SPAN = LENGTH - K + 1
BATCH_BYTES = 2 << 20
#: Bytes of text to a bucket, about; bytes of contexts to one index (an anchor's stay together), few
#: enough to be sorted in the processor's cache.
BUCKET_BYTES = 4 << 20
INDEX_BYTES = 1 << 16
#: Bytes that the contexts of an anchor may have and still meet in one bucket, and the most of a context.
HOT_BYTES = 1 << 20
CONTEXT_BYTES = LENGTH + SPAN - 1

_PLACE_BITS = 24  # of a place inside a batch, in the key that finds the least hash
_BLOCK = 1 << 15  # windows whose hashes are made at once, so that they stay in the processor's cache


def _sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of x[i : i + span] for each i that has so many."""
    size = 1
    while 2 * size <= span:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = span - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _anchor_places(total: np.ndarray, down: np.ndarray, n: int) -> np.ndarray:
    """Where the anchor of the ``LENGTH`` bytes at each place begins, by ``prefix_hash`` of n bytes."""
    bits = np.uint64(max(_PLACE_BITS, n.bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    out = np.empty(n - LENGTH + 1, np.int64)
    for a in range(0, len(out), _BLOCK):
        b = min(a + _BLOCK, len(out))
        end = b + SPAN - 1
        keys = mix((total[a + K : end + K] - total[a:end]) * down[a:end])
        keys >>= bits
        keys <<= bits
        keys |= np.arange(a, end, dtype=np.uint64)
        out[a:b] = _sliding_min(keys, SPAN) & low
    return out


class Contexts:
    """The contexts of the texts of a batch: anchor hash, first window, windows, row, hash of the bytes."""

    def __init__(self, flat: Flat, skip: np.ndarray):
        n = len(flat.data)
        self.anchor, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.windows, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.hot, self.hash = np.zeros(0, bool), np.zeros(0, np.uint64)
        if n < LENGTH:
            return
        total, down = prefix_hash(flat.data)
        place = _anchor_places(total, down, n)
        # the last LENGTH - 1 places of a row begin no window, nor does a row that is skipped
        ends = flat.offsets[1:]
        none = np.where(skip, flat.offsets[:-1], np.maximum(flat.offsets[:-1], ends - LENGTH + 1))
        edge = np.zeros(len(place) + 1, np.int32)
        np.add.at(edge, np.minimum(none, len(place)), 1)
        np.add.at(edge, np.minimum(ends, len(place)), -1)
        whole = np.cumsum(edge[:-1], dtype=np.int32) == 0
        # a context ends where the next place has another anchor or begins no window
        cut = np.empty(len(place) + 1, bool)
        cut[0] = cut[-1] = True
        np.not_equal(place[1:], place[:-1], out=cut[1:-1])
        cut[1:-1] |= whole[1:] != whole[:-1]
        self.first = np.flatnonzero(cut[:-1] & whole)
        if not len(self.first):
            return
        self.windows = np.flatnonzero(cut[1:] & whole) + 1 - self.first
        self.row = np.searchsorted(ends, self.first, side="right")
        # least hashes are small numbers: mixed again, they spread over all buckets
        at = place[self.first]
        self.anchor = mix(mix((total[at + K] - total[at]) * down[at]) + np.uint64(0x9E3779B97F4A7C15))
        self.hot = np.zeros(len(at), bool)
        self.hash = mix((total[self.first + self.windows + LENGTH - 1] - total[self.first]) * down[self.first])

    def pick(self, which: np.ndarray) -> Contexts:
        out = object.__new__(Contexts)
        out.anchor, out.first, out.windows, out.row, out.hot, out.hash = (x[which] for x in (self.anchor, self.first, self.windows, self.row, self.hot, self.hash))
        return out


def _bucket(anchor: np.ndarray, bits: int) -> np.ndarray:
    return (anchor >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(anchor), np.int64)


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of equal numbers in an ascending array."""
    at = np.flatnonzero(np.concatenate([[True], np.diff(buckets) != 0])) if len(buckets) else []
    for a, b in zip(at, np.append(at[1:], len(buckets)) if len(buckets) else []):
        yield int(buckets[a]), slice(int(a), int(b))


# --- 1. batches ---------------------------------------------------------------


def _batches(docs: DataFrame) -> DataFrame:
    """(batch, n_bytes, rows): the rows of ``docs`` in order, as compressed Arrow data."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for part in parts:
            for flat in flat_slices(part.column(part.schema.get_field_index("text")), BATCH_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_batch(part.slice(flat.first, len(flat)))
                raw = packer.compress(sink.getvalue())
                yield pa.RecordBatch.from_arrays([pa.array([len(flat.data)], pa.int64()), pa.array([raw], pa.binary())], names=["n_bytes", "rows"])

    packed = docs.mapInArrow(run, "n_bytes long, rows binary")
    return bucketed(packed.select(F.monotonically_increasing_id().alias("batch"), "n_bytes", "rows"), "batch", docs.rdd.getNumPartitions(), "batches")


def _unpack(raw) -> tuple[pa.RecordBatch, Flat, np.ndarray, np.ndarray]:
    """The rows of a batch, their texts, doc ids, and which rows are not compared."""
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(raw.as_py())) as stream:
        rows = stream.read_next_batch()
    (flat,) = flat_slices(rows.column(rows.schema.get_field_index("text")), 1 << 62)
    ids = rows.column(rows.schema.get_field_index("doc_id"))
    return rows, flat, ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)


# --- 2. shared anchors --------------------------------------------------------


def _distinct_anchors(c: Contexts, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different anchors of a batch, ascending, whether two documents hold them, and how many different
    contexts they have, as the power of two that holds them."""
    if not len(c.anchor):
        return c.anchor, np.zeros(0, bool), np.zeros(0, np.uint8)
    order = np.lexsort((c.windows, c.hash, c.anchor))
    doc, anchor, h, windows = ids[c.row][order], c.anchor[order], c.hash[order], c.windows[order]
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    at = np.flatnonzero(new)
    other = np.concatenate([[True], (h[1:] != h[:-1]) | (windows[1:] != windows[:-1])]) | new
    contexts = np.add.reduceat(other.astype(np.int64), at)
    return anchor[at], np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at), np.ceil(np.log2(contexts)).astype(np.uint8)


def _deal_anchors(batches: DataFrame, bits: int) -> DataFrame:
    """(bucket, batch, anchors): five bytes each, the last bit telling of two documents, and one for the contexts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch, raw in zip(part.column(0), part.column(1)):
                _, flat, ids, skip = _unpack(raw)
                anchor, several, contexts = _distinct_anchors(Contexts(flat, skip), ids)
                low = (anchor >> np.uint64(64 - bits - 39)) & np.uint64((1 << 39) - 1)
                packed = ((low << np.uint64(1)) | several).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].copy()
                packed[:, 5] = contexts
                found = [(b, packed[s].tobytes()) for b, s in _by_bucket(_bucket(anchor, bits))]
                columns = list(zip(*found)) if found else [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array([batch.as_py()] * len(found), pa.int64()), pa.array(columns[1], pa.binary())], names=["bucket", "batch", "packed"])

    return batches.select("batch", "rows").mapInArrow(run, "bucket long, batch long, packed binary")


def _shared(hot_bytes: int) -> Callable[[pa.Table], pa.Table]:
    """One bucket: for each batch a bit for each of its anchors (do two documents hold it?)
    and, behind these, another (is it hot?)."""

    def run(rows: pa.Table) -> pa.Table:
        raws = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, 6) for x in rows.column("packed")]
        wide = np.zeros((sum(map(len, raws)), 8), np.uint8)
        wide[:, :6] = np.concatenate(raws)
        contexts = np.left_shift(1, wide[:, 5].astype(np.int64))
        wide[:, 5] = 0
        value = wide.view("<u8").ravel()
        order = np.argsort(value >> np.uint64(1), kind="stable")
        sorted_ = value[order]
        at = np.flatnonzero(np.concatenate([[True], np.diff(sorted_ >> np.uint64(1)) != 0]))
        sizes = np.diff(np.append(at, len(value)))
        several = (sizes > 1) | (np.maximum.reduceat(sorted_ & np.uint64(1), at) > 0)
        bit, hot = np.empty(len(value), bool), np.empty(len(value), bool)
        bit[order] = np.repeat(several, sizes)
        hot[order] = np.repeat(np.add.reduceat(contexts[order], at) * CONTEXT_BYTES > hot_bytes, sizes)
        ends = np.cumsum([len(x) for x in raws])
        bits = [np.packbits(y[e - len(x) : e]).tobytes() for e, x in zip(ends, raws) for y in (bit, hot)]
        answers = [a + b for a, b in zip(bits[::2], bits[1::2])]
        return pa.table({"batch": rows.column("batch"), "bucket": rows.column("bucket"), "answer": pa.array(answers, pa.binary())})

    return run


_ANSWER = "batch long, bucket long, answer binary"


def _answers(dealt: DataFrame, of: Callable[[pa.Table], pa.Table], name: str) -> DataFrame:
    """(batch, <name>): the answers of all buckets to a batch, by bucket. What a batch
    gets is bounded by what it dealt."""
    rows = dealt.groupBy("bucket").applyInArrow(of, _ANSWER)
    return rows.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias(name))


# --- 3. contexts --------------------------------------------------------------


def _joined(answers) -> dict[int, bytes]:
    return {x["bucket"]: x["answer"] for x in answers.as_py() or []}


def _shared_contexts(flat: Flat, ids: np.ndarray, skip: np.ndarray, bits: int, answers: dict[int, bytes]) -> Contexts:
    """The contexts of a batch whose anchors other documents hold."""
    c = Contexts(flat, skip)
    anchor = np.unique(c.anchor)
    shared, hot = np.zeros(len(anchor), bool), np.zeros(len(anchor), bool)
    for b, s in _by_bucket(_bucket(anchor, bits)):
        raw, n = np.frombuffer(answers[b], np.uint8), s.stop - s.start
        shared[s], hot[s] = (np.unpackbits(x, count=n).astype(bool) for x in np.split(raw, 2))
    if len(anchor):
        at = np.searchsorted(anchor, c.anchor)
        c.hot = hot[at]
        c = c.pick(shared[at])
    return c


def _distinct_contexts(c: Contexts, flat: Flat, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which context stands for each different one (the smallest doc_id's), by anchor, and
    the number of each context's."""
    if not len(c.anchor):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((c.first, ids[c.row], c.windows, c.hash, c.anchor))
    a, h, w = c.anchor[order], c.hash[order], c.windows[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _distinct_windows(c: Contexts, flat: Flat, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """The windows of hot contexts: start, row, number of the window among the different ones,
    and for each different one, by hash, its hash, anchor and smallest doc_id."""
    start = np.repeat(c.first, c.windows) + np.arange(int(c.windows.sum())) - np.repeat(np.cumsum(c.windows) - c.windows, c.windows)
    row, anchor = np.repeat(c.row, c.windows), np.repeat(c.anchor, c.windows)
    if not len(start):
        return start, row, start, anchor, anchor, ids[row]
    h = span_hash(flat.data, start, start + LENGTH)
    order = np.lexsort((ids[row], anchor, h))
    new = np.concatenate([[True], (np.diff(h[order]) != 0) | (np.diff(anchor[order]) != 0)])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    one = order[new]
    return start, row, number, h[one], anchor[one], ids[row[one]]


def _deal_contexts(batches: DataFrame, bits: int) -> DataFrame:
    """(bucket, batch, packed): anchor (low half), doc_id, windows and bytes of each different
    context; hash, anchor and doc_id of each different window of hot ones."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for part in parts:
            for batch, raw, answers in zip(*part.columns):
                _, flat, ids, skip = _unpack(raw)
                c = _shared_contexts(flat, ids, skip, bits, _joined(answers))
                *_, h, anchor, doc = _distinct_windows(c.pick(c.hot), flat, ids)
                found = []
                for b, s in _by_bucket(_bucket(h, bits)):  # windows go to buckets behind those of contexts
                    body = [np.array([s.stop - s.start], "<i8"), doc[s].astype("<i8"), h[s].astype("<u8"), anchor[s].astype("<u8")]
                    found.append((b + (1 << bits), packer.compress(b"".join(x.tobytes() for x in body))))
                c = c.pick(~c.hot)
                which, _ = _distinct_contexts(c, flat, ids)
                for b, s in _by_bucket(_bucket(c.anchor[which], bits)):
                    own = which[s]
                    size = c.windows[own] + LENGTH - 1
                    at = np.repeat(c.first[own] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                    body = [np.array([len(own)], "<i8"), ids[c.row[own]].astype("<i8"), (c.anchor[own] & np.uint64(0xFFFFFFFF)).astype("<u4"), c.windows[own].astype(np.uint8), flat.data[at]]
                    found.append((b, packer.compress(b"".join(x.tobytes() for x in body))))
                columns = list(zip(*found)) if found else [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array([batch.as_py()] * len(found), pa.int64()), pa.array(columns[1], pa.binary())], names=["bucket", "batch", "packed"])

    return batches.mapInArrow(run, "bucket long, batch long, packed binary")


def _window_owners(data: np.ndarray, windows: np.ndarray, anchor: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The smallest owner of every window of different contexts (in order of anchor)."""
    sizes = windows + LENGTH - 1
    ends = np.cumsum(sizes)
    out = np.repeat(owner, windows)
    out_ends = np.cumsum(windows)
    groups = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    stops = np.append(groups[1:], len(anchor))
    several = stops - groups > 1  # a context alone with its anchor has its own windows only
    chosen = np.flatnonzero(np.repeat(several, stops - groups))
    if not len(chosen):
        return out
    # whole groups to an index, up to INDEX_BYTES
    group = np.repeat(np.arange(len(groups)), stops - groups)[chosen]
    load = np.cumsum(sizes[chosen])
    part = (load - 1) // INDEX_BYTES
    part = np.maximum.accumulate(part[np.searchsorted(group, group)])  # that of the group's first
    for _, s in _by_bucket(part):
        own = chosen[s]
        at = np.repeat(ends[own] - sizes[own] - (np.cumsum(sizes[own]) - sizes[own]), sizes[own]) + np.arange(int(sizes[own].sum()))
        found = RunIndex(data[at], sizes[own], owner[own], LENGTH).first_owners()
        place = np.arange(len(found)) - np.repeat(np.cumsum(sizes[own]) - sizes[own], sizes[own])
        is_window = place < np.repeat(windows[own], sizes[own])
        to = np.repeat(out_ends[own] - windows[own] - (np.cumsum(windows[own]) - windows[own]), windows[own]) + np.arange(int(windows[own].sum()))
        out[to] = found[is_window]
    return out


def _match(bits: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        of = _match_windows if rows.column("bucket")[0].as_py() >> bits else _match_contexts
        return pa.table({"batch": rows.column("batch"), "bucket": rows.column("bucket"), "answer": pa.array(of(rows), pa.binary())})

    return run


def _match_windows(rows: pa.Table) -> list[bytes]:
    """One bucket of hot windows: for each batch a bit for each window that a smaller doc_id has."""
    unpacker = zstandard.ZstdDecompressor()
    parts = []
    for x in rows.column("packed"):
        raw = np.frombuffer(unpacker.decompress(x.as_py()), np.uint8)
        n = int(raw[:8].view("<i8")[0])
        parts.append((raw[8 : 8 + 8 * n].view("<i8"), raw[8 + 8 * n : 8 + 16 * n].view("<u8"), raw[8 + 16 * n :].view("<u8")))
    doc, h, anchor = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.lexsort((doc, anchor, h))
    at = np.flatnonzero(np.concatenate([[True], (np.diff(h[order]) != 0) | (np.diff(anchor[order]) != 0)]))
    least = np.empty(len(doc), np.int64)
    least[order] = np.repeat(doc[order][at], np.diff(np.append(at, len(doc))))
    ends = np.cumsum([len(p[0]) for p in parts])
    return [np.packbits((least < doc)[e - len(p[0]) : e]).tobytes() for e, p in zip(ends, parts)]


def _match_contexts(rows: pa.Table) -> list[bytes]:
    """One bucket: for each batch, eight bytes a context, a bit for each window that a
    smaller doc_id has."""
    unpacker = zstandard.ZstdDecompressor()
    parts = []
    for x in rows.column("packed"):
        raw = np.frombuffer(unpacker.decompress(x.as_py()), np.uint8)
        n = int(raw[:8].view("<i8")[0])
        at = [8, 8 + 8 * n, 8 + 12 * n, 8 + 13 * n]
        parts.append((raw[at[0] : at[1]].view("<i8"), raw[at[1] : at[2]].view("<u4"), raw[at[2] : at[3]], raw[at[3] :]))
    doc, anchor, windows, data = (np.concatenate([p[i] for p in parts]) for i in range(4))
    windows = windows.astype(np.int64)
    sizes = windows + LENGTH - 1
    begins = np.cumsum(sizes) - sizes
    h = span_hash(data, begins, begins + sizes)
    order = np.lexsort((doc, windows, h, anchor))
    new = np.concatenate([[True], (np.diff(anchor[order].astype(np.int64)) != 0) | (np.diff(h[order]) != 0) | (np.diff(windows[order]) != 0)])
    number = np.empty(len(doc), np.int64)
    number[order] = np.cumsum(new) - 1
    one = order[new]
    at = np.repeat(begins[one] - (np.cumsum(sizes[one]) - sizes[one]), sizes[one]) + np.arange(int(sizes[one].sum()))
    least = _window_owners(data[at], windows[one], anchor[one], doc[one])
    ends = np.cumsum(windows[one])
    # every dealt context against the least owners of its windows
    first = (ends - windows[one])[number]
    where = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
    earlier = least[where] < np.repeat(doc, windows)
    place = np.arange(len(where)) - np.repeat(np.cumsum(windows) - windows, windows)
    bits = np.add.reduceat(earlier.astype(np.uint64) << place.astype(np.uint64), np.cumsum(windows) - windows)
    stops = np.cumsum([len(p[0]) for p in parts])
    return [bits[e - len(p[0]) : e].astype("<u8").tobytes() for e, p in zip(stops, parts)]


# --- 4. what stays ------------------------------------------------------------


def _covered(c: Contexts, flat: Flat, ids: np.ndarray, bits: int, answers: dict[int, bytes]) -> np.ndarray:
    """Bytes of a batch that a window covers which a smaller doc_id has."""
    edge = np.zeros(len(flat.data) + 1, np.int32)

    def mark(start: np.ndarray) -> None:
        edge[start] += 1  # starts are different, and so are the ends
        edge[start + LENGTH] -= 1

    start, row, number, h, _, doc = _distinct_windows(c.pick(c.hot), flat, ids)
    if len(start):
        earlier = np.zeros(len(h), bool)
        for b, s in _by_bucket(_bucket(h, bits)):
            earlier[s] = np.unpackbits(np.frombuffer(answers[b + (1 << bits)], np.uint8), count=s.stop - s.start)
        mark(start[earlier[number] | (ids[row] > doc[number])])

    c = c.pick(~c.hot)
    which, number = _distinct_contexts(c, flat, ids)
    if len(which):
        found = np.zeros(len(which), np.uint64)
        for b, s in _by_bucket(_bucket(c.anchor[which], bits)):
            found[s] = np.frombuffer(answers[b], "<u8")
        later = ids[c.row] > ids[c.row[which]][number]  # the batch itself has a smaller doc_id with this context
        mask = np.where(later, np.uint64((1 << 64) - 1), found[number])
        start = np.repeat(c.first, c.windows)
        place = np.arange(len(start)) - np.repeat(np.cumsum(c.windows) - c.windows, c.windows)
        hit = (np.repeat(mask, c.windows) >> place.astype(np.uint64)) & np.uint64(1)
        mark((start + place)[hit > 0])
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, cut_text: bool = False, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) with n_bytes, n_removed, n_spans and
    ``kept`` (binary: the bytes that stay). With ``cut_text`` the text column is what stays,
    without the remains of code points that a removal cut, and the input's columns
    alone are returned."""
    fields = [f for f in docs.schema.fields if f.name not in ("n_bytes", "n_removed", "n_spans", "kept")]
    docs = docs.select(*[F.col(f.name).cast("long" if f.name == "doc_id" else "string").alias(f.name) if f.name in ("doc_id", "text") else F.col(f.name) for f in fields])
    batches = _batches(docs)
    total = batches.agg(F.sum("n_bytes")).first()[0] or 0
    bits = max(0, (total // BUCKET_BYTES).bit_length())
    flags = written(_answers(_deal_anchors(batches, bits), _shared(hot_bytes), "flags"), "flags")
    flagged = batches.select("batch", "rows").join(flags, "batch", "left")
    marks = written(_answers(_deal_contexts(flagged, bits), _match(bits), "marks"), "marks")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for raw, flags_, marks_ in zip(*part.columns):
                rows, flat, ids, skip = _unpack(raw)
                c = _shared_contexts(flat, ids, skip, bits, _joined(flags_))
                gone = _covered(c, flat, ids, bits, _joined(marks_))
                begins = gone & np.concatenate([[True], ~gone[:-1]]) if len(gone) else gone
                heads = flat.offsets[:-1]
                inner = heads[(heads > 0) & (heads < len(gone))]
                begins[inner] = gone[inner]  # a run ends with its text
                sums = [np.concatenate([[0], np.cumsum(x)])[flat.offsets] for x in (gone, begins)]
                kept_at = flat.offsets - sums[0]
                kept = flat.data[~gone].tobytes()
                texts = [kept[a:b] for a, b in zip(kept_at[:-1].tolist(), kept_at[1:].tolist())]
                if cut_text:
                    at = rows.schema.get_field_index("text")
                    # a null text stays null
                    cut = pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string(), mask=rows.column(at).is_null().to_numpy(zero_copy_only=False))
                    yield rows.set_column(at, rows.schema.field(at), cut)
                    continue
                more = [pa.array(np.diff(x), pa.int64()) for x in (flat.offsets, *sums)] + [pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*rows.schema.names, "n_bytes", "n_removed", "n_spans", "kept"])

    schema = docs.schema if cut_text else T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])
    return flagged.join(marks, "batch", "left").select("rows", "flags", "marks").mapInArrow(run, schema)


def dedup_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    rows = remove_repeats(docs.select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: The contract as DuckDB SQL, by a table of all windows in hex.
ORACLE_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT *, length(h) // 2 AS n FROM docs),
blocks AS (  -- so that no window is sought in a long text
  SELECT rid, doc_id, n, s, substr(h, 2 * s + 1, 2 * (256 + 49)) AS seg
  FROM (SELECT rid, doc_id, n, h, unnest(range(0, n - 49, 256)) AS s FROM sized WHERE n >= 50)),
windows AS MATERIALIZED (
  SELECT rid, doc_id, s + j AS x, substr(seg, 2 * j + 1, 100) AS w
  FROM (SELECT *, unnest(range(0, least(256, n - 49 - s))) AS j FROM blocks)),
first AS (SELECT w, min(doc_id) AS m FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT rid, x FROM windows JOIN first USING (w) WHERE m < doc_id),
steps AS (SELECT rid, x, CASE WHEN x <= lag(x) OVER (PARTITION BY rid ORDER BY x) + 50 THEN 0 ELSE 1 END AS begins FROM hits),
runs AS (SELECT rid, x, sum(begins) OVER (PARTITION BY rid ORDER BY x) AS run FROM steps),
spans AS (SELECT rid, run, min(x) AS a, max(x) + 50 AS b FROM runs GROUP BY rid, run),
gaps AS (SELECT rid, run, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM spans),
cut AS (
  SELECT rid, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(b) AS last,
         CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans
  FROM gaps JOIN sized USING (rid) GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM sized LEFT JOIN cut USING (rid)
"""
