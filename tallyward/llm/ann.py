"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors go through fast pseudo-rotations (sign flips and Hadamard transforms); a bucket of a table is
the nearest signed axes after two rotations, joined. A query probes the buckets of each table whose
two axes are nearest to it together. The share of a table's buckets that it probes falls with the number of vectors
(``probe_share``): among more vectors neighbours are nearer and buckets fuller.

Largest inner product becomes largest cosine by one more coordinate: candidates are
scaled by the largest norm and completed to length 1, queries get 0 there. So that
shorter vectors do not crowd round that coordinate, candidates are cut into bands of norm
(a factor of the square root of 2 wide) and each band is scaled by its own largest norm.
The longest bands, together at most ``HEAD`` vectors of a dimension, are scored exactly
against all queries: there a neighbour may have almost any angle. A query then probes every
other band but those whose largest norm times its own is under the k-th best score it has,
which hold none of its neighbours.

Through the shuffle go a vector's bytes of 8 bits for each table, and a query for each *range* of a
table's buckets that it probes (a range has about ``RANGE`` candidates, so a small table is one). What a
query meets is scored on these bytes with a bound of the rounding; those that the bound does not rule
out, few over k, are joined with the vectors and scored exactly, in double precision, once.

Ranges are split: blocks of at most ``RANGE`` candidates meet blocks of at most
``BLOCK`` of the queries that probe them, so a bucket that holds a third of all vectors is
many groups. Nothing is left out. Queries that met fewer than ``k`` candidates are scored against
all rows, in blocks.

Rows: vectors null, empty, zero or holding null or non-finite components, and rows
without vec_id, take no part; a repeated (vec_id, vector) counts once, and a query's
own vec_id is never its neighbour; vectors meet only those of their own
dimension; ties go to the smaller vec_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import written

BLOCK = 4096
#: Candidates of a range of buckets, about.
RANGE = 1 << 16
#: Pairs scored in one step.
STEP_PAIRS = 1 << 16
#: Signed axes of a rotation that a query may probe, nearest first.
NEAREST_AXES = 64
#: Vectors of the longest bands of a dimension that are scored exactly.
HEAD = 1024
#: Bands of norm to a factor of 2.
BANDS = 2
SEED = 20_240_611

#: Share of a table's buckets that are probed among 2,000 vectors, and how it falls with their number.
SHARE, FALL = 0.035, 0.38

_FOUND = "query_id long, vec_id long, score double"


def valid_vectors(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vec array<double>, norm, dim, band) of the rows that take part."""
    vec = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id is not null and vec is not null")
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(good, F.lit(False))).dropDuplicates(["vec_id", "vec"])
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.withColumn("norm", norm).where("norm > 0")
    # rounded, so that norms about 1 are not cut at 1
    return rows.withColumn("dim", F.size("vec")).withColumn("band", F.floor(F.log2("norm") * BANDS + 0.5).cast("int"))


def norm_bands(vectors: DataFrame) -> DataFrame:
    """(dim, band, largest, n, exact): the bands that have rows, their largest norm and number of rows, and whether they are scored exactly."""
    bands = vectors.groupBy("dim", "band").agg(F.max("norm").alias("largest"), F.count("*").alias("n"))
    longer = Window.partitionBy("dim").orderBy(F.col("band").desc())
    return bands.select("dim", "band", "largest", "n", (F.sum("n").over(longer) <= HEAD).alias("exact"))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix (unnormalised), by butterflies."""
    n, dim = x.shape
    step = 1
    while step < dim:
        pairs = x.reshape(n, dim // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, dim)
        step *= 2
    return x


def rotated(unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Two pseudo-rotations of unit vectors, those of a table."""
    n, dim = unit.shape
    size = 1 << max(1, int(np.ceil(np.log2(dim))))
    padded = np.zeros((n, size))
    padded[:, :dim] = unit
    rng = np.random.default_rng([SEED, table])
    out = []
    for _ in range(2):
        y = padded
        for _ in range(3):
            y = hadamard(y * rng.choice([-1.0, 1.0], size)) / np.sqrt(size)
        out.append(y)
    return out[0], out[1]


def bucket_of(unit: np.ndarray, table: int) -> np.ndarray:
    """The bucket of each vector: its nearest signed axes, joined."""
    axes = [np.concatenate([y, -y], axis=1).argmax(axis=1) for y in rotated(unit, table)]
    return axes[0] * (2 * _size(unit.shape[1])) + axes[1]


def _size(dim: int) -> int:
    return 1 << max(1, int(np.ceil(np.log2(dim))))


def probed(unit: np.ndarray, table: int, probes: int) -> np.ndarray:
    """(rows, probes): the buckets whose two axes are nearest together, of the nearest axes of each."""
    both = [np.concatenate([y, -y], axis=1) for y in rotated(unit, table)]
    width = both[0].shape[1]
    near = min(width, NEAREST_AXES)
    axes = [np.argpartition(-y, near - 1, axis=1)[:, :near] for y in both]
    value = [np.take_along_axis(y, x, 1) for y, x in zip(both, axes)]
    total = (value[0][:, :, None] + value[1][:, None, :]).reshape(len(unit), -1)
    count = min(probes, total.shape[1])
    best = np.argpartition(-total, count - 1, axis=1)[:, :count]
    first, second = np.take_along_axis(axes[0], best // near, 1), np.take_along_axis(axes[1], best % near, 1)
    return first * width + second


def probe_share(n: int) -> float:
    """Share of a table's buckets that a query probes among n vectors."""
    return min(1.0, SHARE * (2000 / max(n, 1)) ** FALL)


def _units(vec: np.ndarray, largest: np.ndarray | None) -> np.ndarray:
    """Queries (without ``largest``) and candidates as unit vectors with one more coordinate."""
    if largest is None:
        norm = np.sqrt((vec * vec).sum(axis=1))
        return np.column_stack([vec / norm[:, None], np.zeros(len(vec))])
    scaled = vec / largest[:, None]
    return np.column_stack([scaled, np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))])


def in_bytes(vec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors as 8-bit integers with their scale, and the length of what rounding took."""
    scale = np.abs(vec).max(axis=1) / 127
    rounded = np.rint(vec / scale[:, None]).astype(np.int8)
    off = vec - rounded * scale[:, None]
    return rounded, scale, np.sqrt((off * off).sum(axis=1)) * (1 + 1e-9)


def _by_dim(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their vectors, for each dimension in it."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield rows, lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


_RANGE = ["band", "tbl", "part"]
_CANDIDATE = "band int, tbl long, part int, vec_id long, bucket long, bytes binary, scale double, off double"
_QUERY = "band int, tbl long, part int, vec_id long, vec array<double>"


def _dealt_candidates(vectors: DataFrame, tables: int) -> DataFrame:
    """Each vector in the range of its bucket, once a table; the dimension is part of tbl."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vec in _by_dim(batch, 1):
                largest, parts = (batch.column(i).to_numpy(zero_copy_only=False)[rows] for i in (3, 4))
                unit, (data, scale, off) = _units(vec, largest), in_bytes(vec)
                taken = pa.array(rows)
                raw = pa.array([r.tobytes() for r in data], pa.binary())
                n_buckets = (2 * _size(unit.shape[1])) ** 2
                for t in range(tables):
                    bucket = bucket_of(unit, t)
                    columns = [batch.column(2).take(taken), pa.array(np.full(len(rows), vec.shape[1] * tables + t)), pa.array((bucket * parts // n_buckets).astype(np.int32))]
                    columns += [batch.column(0).take(taken), pa.array(bucket), raw, pa.array(scale), pa.array(off)]
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _CANDIDATE.split(", ")])

    return vectors.select("vec_id", "vec", "band", "largest", "parts").mapInArrow(run, _CANDIDATE)


def _dealt_queries(queries: DataFrame, tables: int) -> DataFrame:
    """Each query in the ranges of a band and table that it probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vec in _by_dim(batch, 1):
                probes, parts = (batch.column(i).to_numpy(zero_copy_only=False)[rows] for i in (3, 4))
                unit = _units(vec, None)
                n_buckets = (2 * _size(unit.shape[1])) ** 2
                for t in range(tables):
                    found: list[tuple[np.ndarray, np.ndarray]] = []
                    for count, n in np.unique(np.stack([probes, parts]), axis=1).T.tolist():  # one pair a band
                        own = np.flatnonzero((probes == count) & (parts == n))
                        for at in range(0, len(own), 256):
                            some = own[at : at + 256]
                            part = probed(unit[some], t, count) * n // n_buckets if n > 1 else np.zeros((len(some), 1), np.int64)
                            each = np.unique(np.stack([np.repeat(some, part.shape[1]), part.reshape(-1)]), axis=1)
                            found.append((each[0], each[1]))
                    own, part = (np.concatenate([f[i] for f in found]) for i in (0, 1))
                    taken = pa.array(rows[own])
                    columns = [batch.column(2).take(taken), pa.array(np.full(len(own), vec.shape[1] * tables + t)), pa.array(part.astype(np.int32))]
                    columns += [batch.column(0).take(taken), batch.column(1).take(taken)]
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _QUERY.split(", ")])

    return queries.select("vec_id", "vec", "band", "probes", "parts").mapInArrow(run, _QUERY)


def not_ruled_out(query: np.ndarray, score: np.ndarray, bound: np.ndarray, k: int) -> np.ndarray:
    """Of pairs sorted by query, those that may be among its k best: their score and bound reach the
    k-th best score less its bound."""
    order = np.lexsort((-(score - bound), query))
    first = np.flatnonzero(np.concatenate([[True], query[order][1:] != query[order][:-1]])) if len(query) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(query)))
    at = first + np.minimum(sizes, k) - 1
    least = np.where(sizes >= k, (score - bound)[order[at]], -np.inf)
    return order[(score + bound)[order] >= np.repeat(least, sizes)]


def _met(candidates: pa.Table, queries: pa.Table, k: int, tables: int, probes: dict[tuple[int, int], int]) -> pa.Table:
    """(query_id, vec_id, score, bound) of what queries meet in a block of a range, less what is ruled out."""
    none = pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=["query_id", "vec_id", "score", "bound"])
    if not candidates.num_rows or not queries.num_rows:
        return none
    dim, table = divmod(queries.column("tbl")[0].as_py(), tables)
    count = probes[(dim, queries.column("band")[0].as_py())]
    bucket = candidates.column("bucket").to_numpy()
    order = np.argsort(bucket, kind="stable")
    bucket, c_ids = bucket[order], candidates.column("vec_id").to_numpy()[order]
    scale, off = (candidates.column(c).to_numpy()[order] for c in ("scale", "off"))
    data = np.frombuffer(b"".join(candidates.column("bytes").to_pylist()), np.int8).reshape(-1, dim)[order].astype(np.float32)
    q_ids = queries.column("vec_id").to_numpy()
    q_vec = queries.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    length = np.sqrt((q_vec * q_vec).sum(axis=1))
    found = []
    for at in range(0, len(q_ids), 64):
        vec = q_vec[at : at + 64]
        wanted = probed(_units(vec, None), table, count)
        low, high = np.searchsorted(bucket, wanted), np.searchsorted(bucket, wanted, side="right")
        sizes = (high - low).reshape(-1)
        rows = np.repeat(np.repeat(np.arange(len(vec)), wanted.shape[1]), sizes)
        ends = np.cumsum(sizes)
        which = np.arange(int(ends[-1])) + np.repeat(low.reshape(-1) - (ends - sizes), sizes)
        other = q_ids[at + rows] != c_ids[which]
        rows, which = rows[other], which[other]
        score = np.empty(len(rows))
        small = vec.astype(np.float32)
        for i in range(0, len(rows), STEP_PAIRS):
            r, w = rows[i : i + STEP_PAIRS], which[i : i + STEP_PAIRS]
            score[i : i + STEP_PAIRS] = np.einsum("ij,ij->i", small[r], data[w])
        score *= scale[which]
        own = length[at + rows]
        # rounding to bytes, and to single precision on the way
        bound = own * off[which] + own * scale[which] * (127 * dim**1.5 * 2.0**-23)
        keep = not_ruled_out(rows, score, bound, k)
        found.append((q_ids[at + rows[keep]], c_ids[which[keep]], score[keep], bound[keep]))
    return pa.table([pa.array(np.concatenate([f[i] for f in found])) for i in range(4)], names=none.column_names)


def _split(candidates: DataFrame, queries: DataFrame, key: list[str], c_most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``c_block`` and ``q_block``: each row in a block of its group, once for every
    block of the other side."""
    size = lambda df, name, most: df.groupBy(*key).agg(F.ceil(F.count("*") / F.lit(most)).alias(name))
    groups = size(candidates, "c_block_n", c_most).join(size(queries, "q_block_n", BLOCK), key)

    def side(rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id"), F.col(f"{own}_n")).cast("int").alias(own)
        theirs = F.explode(F.sequence(F.lit(0), (F.col(f"{other}_n") - 1).cast("int"))).alias(other)
        return rows.join(groups, key).select(*rows.columns, mine, theirs)

    return side(candidates, "c_block", "q_block"), side(queries, "q_block", "c_block")


def _best(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of each query of a block."""
    q_ids, c_ids = (t.column("vec_id").to_numpy() for t in (queries, candidates))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(q_ids) and len(c_ids):
        q_vec, c_vec = (t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) for t in (queries, candidates))
        order = np.argsort(c_ids, kind="stable")
        c_ids, c_vec = c_ids[order], c_vec[order]
        for at in range(0, len(q_ids), 256):
            some, vec = q_ids[at : at + 256], q_vec[at : at + 256]
            rough = vec @ c_vec.T
            rough[some[:, None] == c_ids[None, :]] = -np.inf
            if len(c_ids) > k:  # the rough k-th best, less its rounding error
                least = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
                scale = np.abs(vec).sum(axis=1) * np.abs(c_vec).max()
                near = (rough >= (least - 1e-12 * scale)[:, None]) & (rough > -np.inf)
            else:
                near = rough > -np.inf
            qi, ci = np.nonzero(near)
            score = np.sum(vec[qi] * c_vec[ci], axis=1)  # in one order wherever a pair meets
            by = np.lexsort((ci, -score, qi))
            qi, ci, score = qi[by], ci[by], score[by]
            first = np.searchsorted(qi, qi)
            top = np.arange(len(qi)) - first < k
            found.append((some[qi[top]], c_ids[ci[top]], score[top]))
    columns = [np.concatenate([f[i] for f in found]) if found else [] for i in range(3)]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})


def _scored(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of each query among all (dim, vec_id, vec) of its dimension, block by block."""
    key = ["dim", "c_block", "q_block"]
    c, q = _split(candidates, queries, ["dim"], BLOCK)
    return c.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(lambda a, b: _best(b, a, k), _FOUND)


def _hashed(candidates: DataFrame, queries: DataFrame, vectors: DataFrame, k: int, tables: int, probes: dict[tuple[int, int], int], small: bool) -> DataFrame:
    """(query_id, vec_id, score): what queries meet in the buckets they probe, exactly scored; of each
    query all that may be among its k best of these. ``small``: no range has more than a block of either."""
    key = [*_RANGE, "c_block", "q_block"]
    c, q = _dealt_candidates(candidates, tables), _dealt_queries(queries, tables)
    if small:
        c, q = (df.withColumns({"c_block": F.lit(0), "q_block": F.lit(0)}) for df in (c, q))
    else:
        c, q = _split(c, q, _RANGE, RANGE)
    met = c.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(lambda a, b: _met(a, b, k, tables, probes), "query_id long, vec_id long, score double, bound double")
    # of a query's different candidates, those not ruled out by all it met
    each = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.max("bound").alias("bound"))
    own = each.groupBy("query_id").agg(F.collect_list(F.struct("vec_id", "score", "bound")).alias("met"))
    lows = F.sort_array(F.transform("met", lambda x: x.score - x.bound), asc=False)
    own = own.withColumn("least", F.coalesce(F.get(lows, F.lit(k - 1)), F.lit(float("-inf"))))
    pairs = own.select("query_id", F.explode(F.filter("met", lambda x: x.score + x.bound >= F.col("least"))).alias("one")).select("query_id", "one.vec_id")
    pairs = pairs.join(vectors.select("vec_id", F.col("vec").alias("c_vec")), "vec_id")
    pairs = pairs.join(queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q_vec")).dropDuplicates(["query_id", "q_vec"]), "query_id")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, c_vec in _by_dim(batch, 2):
                q_vec = batch.column(3).take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
                taken = pa.array(rows)
                score = np.sum(q_vec * c_vec, axis=1)  # in one order wherever a pair meets
                yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(score)], names=["query_id", "vec_id", "score"])

    same = pairs.where(F.size("c_vec") == F.size("q_vec"))
    return same.select("query_id", "vec_id", "c_vec", "q_vec").mapInArrow(exact, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best distinct candidates of each query, by arrays that merge before the shuffle's end."""
    best = F.slice(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k)
    rows = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("pos", "one"))
    return rows.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "one.vec_id", (-F.col("one.minus")).alias("score"))


def nearest(table: DataFrame, every: int, k: int, tables: int = 10, probes: int | None = None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id is
    divisible by ``every``, among all other rows. ``probes``: buckets of a table that a query probes in
    a band, by default the share of ``probe_share``."""
    vectors = written(valid_vectors(table, id_column, vector_column), "vectors")
    queries = written(vectors.where(F.col("vec_id") % every == 0).select("vec_id", "vec", "norm", "dim"), "queries")
    bands = written(norm_bands(vectors), "bands")
    sizes = {(r["dim"], r["band"]): r["n"] for r in bands.where("not exact").collect()}  # a row a band
    width = lambda dim: (2 * _size(dim + 1)) ** 2
    counts = {key: probes or int(np.ceil(width(key[0]) * probe_share(n))) for key, n in sizes.items()}
    plan = [(dim, band, counts[(dim, band)], -(-n // RANGE)) for (dim, band), n in sizes.items()]
    banded = vectors.join(bands, ["dim", "band"])
    head = written(_scored(banded.where("exact").select("dim", "vec_id", "vec"), queries.select("dim", "vec_id", "vec"), k), "head")
    top = head
    if plan:
        plan = vectors.sparkSession.createDataFrame(plan, "dim int, band int, probes int, parts int")
        kth = _ranked(head, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))
        wanted = queries.join(bands.where("not exact"), "dim").join(F.broadcast(plan), ["dim", "band"]).join(kth, "vec_id", "left")
        # a score is rounded by far less than this
        reach = F.col("norm") * F.col("largest") * (1 + 1e-9)
        wanted = wanted.where(F.col("kth").isNull() | (reach >= F.col("kth")))
        wanted = written(wanted.select("vec_id", "vec", "band", "probes", "parts"), "wanted")
        rest = banded.where("not exact").join(F.broadcast(plan), ["dim", "band"])
        small = max(sizes.values()) <= RANGE and wanted.count() <= BLOCK
        top = head.union(_hashed(rest, wanted, vectors, k, tables, counts, small))
    top = written(_ranked(top, k), "nearest")
    few = queries.join(top.groupBy("query_id").count().where(F.col("count") >= k), queries.vec_id == F.col("query_id"), "left_anti")
    few = written(few.select("dim", "vec_id", "vec"), "few")
    if few.isEmpty():
        return top
    rest = _ranked(_scored(vectors.select("dim", "vec_id", "vec"), few, k), k)
    return top.join(few, top.query_id == few.vec_id, "left_anti").union(rest)
