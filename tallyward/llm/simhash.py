"""SimHash near-duplicates through deletion-variant signatures.

The 64-bit fingerprint of a text counts the hashes of its word shingles. Two
fingerprints that differ in at most ``max_bits`` = 4 bits differ in at most one bit
in one of three segments, so both have the same variant of that segment with one
bit taken out (a wildcard). Every distinct fingerprint is indexed under its 64
one-wildcard variants, equal variants meet, and pairs are verified on all bits.

A bucket of many fingerprints is not paired off: it is split further by five blocks of
the bits not yet fixed, one of which must agree (there are at most four
differences). Buckets with over a thousandth of all rows are split so before the shuffle, the
others in their task, and what remains is searched breadth first, which gives each
fingerprint one link into its component instead of all its pairs. Every link
between different fingerprints is thereby kept up to the component it makes. Copies share
a fingerprint and enter once.

Rows: a null or empty text has fingerprint zero, linked like any other; each
repeated row gives its own row; a null doc_id has a fingerprint and a component but
is never the smallest doc_id (the component of null ids alone is null); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import flat_slices, written
from tallyward.llm.components import connected_components

BITS = 64
#: Buckets up to this size are compared pair by pair (in the task, vectorised).
BUCKET = 2048
#: Variants that make a bucket heavy, as a share of all variants: about as many buckets are heavy at most.
HEAVY_SHARE = 1000


def shingle_hashes(text: bytes, n: int, seed: int) -> np.ndarray:
    """XXH64 of the word shingles of a text: lower case A-Z, words between ASCII white
    space, joined by one space; fewer words than a shingle make one."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[: len(words) - n]]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[n - 1 :])], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes; 0 without hashes."""
    if not len(hashes):
        return 0
    set_ = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_ * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, seed: int = 42, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for flat in flat_slices(batch.column(1)):
                for i in range(len(flat)):
                    out[flat.first + i] = simhash(shingle_hashes(flat.row(i), shingle, seed))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fp long")


def segments(max_bits: int) -> list[int]:
    """Bit masks of the fewest segments of which one differs by at most one bit."""
    n = max_bits // 2 + 1
    bounds = [BITS * i // n for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def variants(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp, segment): each fingerprint under each segment with one bit taken out."""
    found = [(i, m) for i, m in enumerate(segments(max_bits)) for _ in range(m.bit_count())]
    masks, numbers = F.array(*[F.lit(_signed(m)) for _, m in found]), F.array(*[F.lit(i) for i, _ in found])
    bit = F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit")
    rows = distinct.select("fp", bit)
    kept = F.expr("~shiftleft(1L, bit)").bitwiseAND(F.col("fp")).bitwiseAND(F.element_at(masks, F.col("bit") + 1))
    return rows.select(F.xxhash64("bit", kept).alias("key"), "fp", F.element_at(numbers, F.col("bit") + 1).alias("segment"))


def blocks(max_bits: int) -> list[list[int]]:
    """For each segment, masks of max_bits + 1 blocks of the bits beyond it: of two
    fingerprints that differ in at most max_bits bits, one block agrees."""
    out = []
    for segment in segments(max_bits):
        free = np.array([b for b in range(BITS) if not segment >> b & 1])
        out.append([sum(1 << int(b) for b in part) for part in np.array_split(free, max_bits + 1)])
    return out


def split_heavy(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp) of the variants of fingerprints, those of heavy buckets once for each block under a
    key of its own. Which buckets are heavy is read from about 64 x HEAVY_SHARE variants of fingerprints
    drawn by hash; a bucket that is judged wrongly is only split elsewhere."""
    total = BITS * distinct.count()
    rate = max(1, total // (64 * HEAVY_SHARE))
    least = max(BUCKET / rate, total / (rate * HEAVY_SHARE))
    drawn = variants(distinct.where(F.pmod(F.xxhash64(F.lit("drawn"), "fp"), F.lit(rate)) == 0), max_bits)
    heavy = drawn.groupBy("key").count().where(F.col("count") > least).select("key")
    heavy = F.broadcast(written(heavy, "heavy"))  # about HEAVY_SHARE keys at most
    rows = variants(distinct, max_bits)
    masks = F.array(*[F.array(*[F.lit(_signed(m)) for m in own]) for own in blocks(max_bits)])
    parts = rows.join(heavy, "key").select("*", F.posexplode(F.element_at(masks, F.col("segment") + 1)).alias("block", "mask"))
    parts = parts.select(F.xxhash64("key", "block", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp")
    return rows.join(heavy, "key", "left_anti").select("key", "fp").union(parts)


class Forest:
    """Union-find over fingerprints."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(p, p)
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def search(fps: np.ndarray, free: int, max_bits: int, forest: Forest) -> None:
    """Join all of ``fps`` (distinct) that are within ``max_bits``. ``free``: the bits
    in which they may differ as far as is known; at most max_bits of them do."""
    if len(fps) < 2:
        return
    bits = [b for b in range(BITS) if free >> b & 1]
    if len(fps) > BUCKET and len(bits) > max_bits:
        for block in np.array_split(np.array(bits, np.uint64), max_bits + 1):
            mask = np.uint64(sum(1 << int(b) for b in block))
            value = fps & mask
            order = np.argsort(value, kind="stable")
            for part in np.split(fps[order], np.flatnonzero(np.diff(value[order])) + 1):
                search(part, free & ~int(mask), max_bits, forest)
        return
    left = fps
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            near = _distance(left, node) <= max_bits
            if near.any():
                for other in left[near].tolist():
                    forest.join(int(node), other)
                frontier += list(left[near])
                left = left[~near]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, fps) of sorted rows, cut so that no key is in two parts."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        if last or (kept and kept[0][0][0] != keys[0]):
            kept.append((keys[:last], fps[:last]))
            yield np.concatenate([k for k, _ in kept]), np.concatenate([f for _, f in kept])
            kept = []
        kept.append((keys[last:], fps[last:]))
    if kept:
        yield np.concatenate([k for k, _ in kept]), np.concatenate([f for _, f in kept])


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): edges that connect all fingerprints within ``max_bits``, one for each
    fingerprint and task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for keys, fps in _whole_groups(batches):
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, len(keys)))
            small = np.repeat((sizes > 1) & (sizes <= 16), sizes)
            k, f = keys[small], fps[small]
            for step in range(1, 16):
                near = (k[step:] == k[:-step]) & (_distance(f[step:], f[:-step]) <= max_bits)
                for a, b in zip(f[:-step][near].tolist(), f[step:][near].tolist()):
                    forest.join(a, b)
            for i in np.flatnonzero(sizes > 16):
                group = np.unique(fps[starts[i] : starts[i] + sizes[i]])
                search(group, (1 << BITS) - 1, max_bits, forest)
        nodes = np.array(list(forest.parent), np.uint64)
        roots = np.array([forest.root(x) for x in nodes.tolist()], np.uint64)
        other = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[other].view(np.int64)), pa.array(roots[other].view(np.int64))], names=["a", "b"])

    dealt = split_heavy(distinct, max_bits).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document; the ids are those of ``id_column``."""
    marked = written(fingerprints(docs, shingle, id_column=id_column), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    edges = links(classes.select("fp"), max_bits)
    tied = connected_components(edges)
    member = classes.join(tied, classes.fp == tied.a, "left").select("fp", "first_id", F.coalesce("b", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    out = marked.join(named, "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
