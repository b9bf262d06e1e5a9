"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is a sequence of units: pieces of up to ``UNIT`` code points of its words, cut from each word's
beginning. A k-mer of ``SPAN`` units is an *anchor* (a closed syncmer) when the least of its
units, by hash, is its first or its last. That depends on the k-mer alone, so an edit
changes only the anchors that it touches, and equal passages have equal anchors at equal distances. Of
any ``SPAN - 1`` k-mers that follow each other at least one is an anchor, so
no passage of twice SPAN units is without, in texts of any length. A text too short for a k-mer has one
anchor, its whole sequence.

The fingerprint is all anchors in order, nine hexadecimal digits each: the hash, and the distance
to the anchor before (of the first, its place). ``likeness`` compares *marks*: every different anchor, and every two
that follow each other with their distance, so a match needs the same k-mers, and more so the same
relative places. It is twice the number of common marks through the number of both (0 to 1): two
thirds for a text of which one third was replaced, and above 0 whenever two texts share a passage of
twice SPAN units, cut alike, however long they are.

``next_document`` gives every row the text of the row with the next smaller id without a
global sort: ids are cut at quantiles into buckets, a bucket's largest id is dealt to
the bucket above it as well, and windows run inside buckets.

Rows: a null text is empty; an empty text has an empty fingerprint, like (1.0) another
empty one only; a null doc_id comes after the smallest; repeated rows each count, equal ids in
order of their texts; the only row is its own next; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points of a unit, and units of a k-mer.
UNIT, SPAN = 4, 6
#: Bytes of text to a bucket of neighbouring ids, and buckets at most (their bounds are literals, as a range partitioner's are).
BUCKET_BYTES = 2 << 20
MOST_BUCKETS = 1 << 14

_NONE = "array<struct<hash:bigint,pos:int>>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _anchor(h: Column, pos: Column) -> Column:
    return F.struct(F.shiftrightunsigned(h, 32).alias("hash"), pos.cast("int").alias("pos"))


def anchors(text: Column) -> Column:
    """array<struct<hash, pos>>: every anchor of a text with the unit that it starts at."""

    def of(h: Column) -> Column:
        inner = [h, *[None] * (SPAN - 1)]

        def one(first: Column, i: Column) -> Column:
            inner[0] = first
            for d in range(1, SPAN):
                inner[d] = h[i + d]
            closed = F.least(inner[0], inner[-1]) <= F.least(*inner[1:-1])
            return F.when(closed, _anchor(F.xxhash64(*inner), i))

        found = F.array_compact(F.transform(F.slice(h, 1, F.greatest(F.size(h) - (SPAN - 1), F.lit(0))), one))
        whole = F.when(F.size(h) > 0, F.array(_anchor(F.xxhash64(h), F.lit(0)))).otherwise(F.array().cast(_NONE))
        return F.when(F.size(h) < SPAN, whole).otherwise(found)

    units = F.regexp_extract_all(text, F.lit(rf"\S{{1,{UNIT}}}"), F.lit(0))
    return _let(F.transform(units, lambda u: F.xxhash64(u)), of)


def marks(anchors_: Column) -> Column:
    """What two texts are compared by: different anchors, and pairs of neighbours with their distance."""

    def of(a: Column) -> Column:
        firsts = F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))
        pairs = F.transform(firsts, lambda x, i: F.xxhash64(x["hash"], a[i + 1]["hash"], a[i + 1]["pos"] - x["pos"]))
        return F.array_distinct(F.concat(F.transform(a, lambda x: x["hash"]), pairs))

    return _let(anchors_, of)


def likeness(a: Column, b: Column) -> Column:
    """Twice the common marks through all marks of two texts, 0 to 1."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(a, b)) / F.greatest(both, F.lit(1)))


def as_text(anchors_: Column) -> Column:
    """The fingerprint: hash (8 digits) and distance to the anchor before (1 digit) of each anchor."""

    def of(a: Column) -> Column:
        step = lambda x, i: x["pos"] - F.when(i > 0, a[F.greatest(i - 1, F.lit(0))]["pos"]).otherwise(0)
        return F.array_join(F.transform(a, lambda x, i: F.lower(F.concat(F.lpad(F.hex(x["hash"]), 8, "0"), F.hex(step(x, i))))), "")

    return _let(anchors_, of)


def from_text(fingerprint: Column) -> Column:
    """The anchors of a fingerprint, whose marks ``likeness`` compares."""
    number = lambda text: F.conv(text, 16, 10).cast("bigint")
    items = F.regexp_extract_all(fingerprint, F.lit("[0-9a-f]{9}"), F.lit(0))
    steps = F.transform(items, lambda t: number(F.substring(t, 9, 1)))
    return F.transform(items, lambda t, i: F.struct(number(F.substring(t, 1, 8)).alias("hash"), F.aggregate(F.slice(steps, 1, i + 1), F.lit(0).cast("bigint"), lambda s, x: s + x).cast("int").alias("pos")))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are smaller than the key, found in two steps."""
    width = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    if not groups:
        return F.lit(0)
    lasts = F.array(*[F.lit(g[-1]) for g in groups])
    nested = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])

    def of(full: Column) -> Column:
        own = F.when(full < len(groups), F.get(nested, full))
        return full * width + F.coalesce(F.size(F.filter(own, lambda x: x < key)), F.lit(0))

    return F.least(F.lit(len(bounds)), _let(F.size(F.filter(lasts, lambda x: x < key)), of))


def next_document(docs: DataFrame, with_columns: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """``docs`` (doc_id, text, ...) with next_<column> of the row that follows in
    descending doc_id; after the last comes the first. ``with_columns`` adds columns after the
    shuffle, so that they need not travel."""
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    keyed = docs.withColumn("_key", key)
    size, largest = keyed.agg(F.sum(F.octet_length("text")), F.max("_key")).first()
    n = min(MOST_BUCKETS, max(1, (size or 0) // BUCKET_BYTES + 1))
    bounds: list[int] = []
    if n > 1:
        found = keyed.agg(F.percentile_approx("_key", [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0]
        bounds = sorted({x for x in found or () if x != largest})
    own = _bucket(F.col("_key"), bounds).cast("int")
    is_bound = F.array_contains(F.array(*[F.lit(x) for x in bounds]), F.col("_key")) if bounds else F.lit(False)
    place = lambda bucket, extra: F.struct(bucket.alias("bucket"), F.lit(extra).alias("extra"))
    none = F.slice(F.array(place(F.lit(0), 1)), 1, 0)
    places = F.concat(
        F.array(place(own, 0)),
        F.when(is_bound, F.array(place(own + 1, 1))).otherwise(none),
        F.when(F.col("_key") == F.lit(largest if largest is not None else 0), F.array(place(F.lit(0), 1))).otherwise(none),
    )
    dealt = keyed.withColumn("_place", F.explode(places))
    dealt = dealt.select(*docs.columns, "_key", F.col("_place.bucket").alias("_bucket"), F.col("_place.extra").alias("_extra"))
    # sorted as the window wants it, before columns are added: the texts are shuffled and sorted once
    by = ["_extra", F.col("_key").desc(), "text"]
    dealt = with_columns(dealt.repartition("_bucket").sortWithinPartitions("_bucket", *by))
    order = Window.partitionBy("_bucket").orderBy(*by)
    rows = dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return rows.where("_extra = 0").drop("_key", "_bucket", "_extra")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Every text and its edited form (the last third replaced by the beginning of the
    next document): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (likeness of the fingerprints)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("anchors", anchors(F.col("text"))).withColumn("marks", marks(F.col("anchors")))

    rows = next_document(rows, marked, ["text", "marks"])
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = rows.withColumn("edited", edited)
    rows = rows.withColumn("edited_anchors", anchors(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("anchors")).alias("fingerprint"),
        as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("marks"), marks(F.col("edited_anchors"))).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
