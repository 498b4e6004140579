"""Operator 6: SimHash near-dedup with deletion-variant signatures.

A fingerprint is cut into three segments. Two fingerprints that differ in at most four bits differ in at most one bit of
some segment, so they share one of its variants with one bit wildcarded (taken out). Each distinct fingerprint is
indexed under its 64 variants, members of a variant's bucket meet in an equality join, and the join keeps the pairs whose
bit distance is verified, each in the first variant that the two share.

A bucket of n members has n (n - 1) / 2 pairs. Beyond ``PAIRED`` members its fingerprints are linked without pairs, and
without loss: two fingerprints are within four bits if and only if some point lies within two bits of both, so each
emits the 2,081 points of its ball and is linked to the smallest fingerprint that emits the same point. ``PAIRED`` is
where 64 buckets cost as many rows in pairs as one ball.

Equal texts and equal fingerprints are one fingerprint before any of this, so copies cost one row each.

Defined results: null and empty texts, and texts without words, have fingerprint 0 and are linked like any other; rows
repeated with one doc_id give a row each; a null doc_id is the id of a component only if it has no other; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, hint_broadcast, map_batches
from .components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit, width
PAIRED = 64
#: _BITS[v, b]: whether bit b of byte value v is set.
_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)
_SLOTS = 256 * np.arange(8)
_CHUNK = 1 << 16


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of UTF-8 ``data``."""
    tokens = data.lower().split()  # both ASCII only for bytes
    n = len(tokens)
    if n == 0:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=n) + 1) - 1
    k = min(shingle, n)
    starts = np.concatenate(([0], ends[:n - k] + 1))
    last = ends[k - 1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(2048, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + _CHUNK].tolist(), last[at:at + _CHUNK].tolist())], dtype="<u8")
        counts += np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _SLOTS).ravel(), minlength=2048)
    set_bits = (counts.reshape(8, 256) @ _BITS).ravel() * 2 > len(starts)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t or b"", shingle) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints, pa.int64())],
                                         [*batch.schema.names[1:], "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), fp of every row of ``docs`` (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(text.cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("text_hash"))
    return map_batches(rows, lambda b: _fingerprints(b, shingle), "doc_id long, text_hash long, fp long")


def signatures(fp: Column) -> list[Column]:
    """The 64 one-wildcard variants: variant number above the segment without the wildcarded bit."""
    out = []
    for first, width in SEGMENTS:
        segment = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))
        out += [segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << p))).bitwiseOR(F.lit((first + p) << 22))
                for p in range(width)]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ball() -> list[int]:
    """Masks of at most two bits."""
    return [0, *(_signed(1 << i) for i in range(64)),
            *(_signed(1 << i | 1 << j) for i in range(64) for j in range(i))]


def _first_shared(x: Column, variant: Column) -> Column:
    """Whether ``variant`` is the first that two fingerprints of difference ``x`` share, so that a pair is met once.

    Segments that are equal share all their variants, segments that differ in one bit share that bit's.
    """
    out = F.lit(False)
    for first, width in reversed(SEGMENTS):
        n = F.bit_count(F.shiftrightunsigned(x, first).bitwiseAND(F.lit((1 << width) - 1)))
        inside = (variant >= first) & (variant < first + width) & ((n == 1) | (variant == first))
        out = F.when(n <= 1, inside).otherwise(out)
    return out


def links(distinct: DataFrame, distance: int = DISTANCE, paired: int = PAIRED) -> DataFrame:
    """Edges (a, b) between fingerprints ``fp`` of ``distinct`` that connect all those within ``distance`` <= 4 bits.

    Members of buckets of up to ``paired`` are joined and verified; larger buckets give a star per shared point
    (distance 4 only: below that all buckets are joined).
    """
    signed = distinct.select("fp", F.explode(F.array(*signatures(F.col("fp")))).alias("key"))
    rows, large, n_large = signed, None, 0
    if distance == DISTANCE:
        large = cut(signed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > paired).select("key"))
        n_large = large.count()
    if n_large:
        # taken out first, so that no task of the join below receives a large bucket
        rows = signed.join(hint_broadcast(large, n_large, 16), "key", "left_anti")
    difference = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (rows.select("key", F.col("fp").alias("a")).join(rows.select("key", F.col("fp").alias("b")), "key")
             .where((F.col("a") < F.col("b")) & (F.bit_count(difference) <= distance)
                    & _first_shared(difference, F.shiftright("key", 22))).select("a", "b"))
    if not n_large:
        return pairs
    crowded = cut(signed.join(hint_broadcast(large, n_large, 16), "key").select("fp").distinct())
    masks = F.array(*[F.lit(m) for m in ball()])
    points = crowded.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"))
    centre = cut(points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z")
                 .select("point", "a"))
    stars = points.join(centre, "point").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars)


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, paired: int = PAIRED) -> DataFrame:
    """doc_id, text_hash, fp, root, component_id of every row of ``docs`` (doc_id, text).

    root is the smallest fingerprint of the component, component_id its smallest doc_id.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"three segments with one wildcard cover distances up to {DISTANCE}")
    rows = cut(fingerprints(docs, shingle))
    first = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = components(links(first.select("fp"), distance, paired))
    of_root = cut(first.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
                  .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = of_root.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Written out, so that the join with the rows shuffles both sides and AQE can split a fingerprint of many copies.
    component = cut(of_root.join(smallest, "root").select("fp", "root", "component_id"))
    return rows.join(component, "fp")


def near_components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    return near_groups(docs, shingle, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` per component, with all its columns: the smallest doc_id, and of its rows the smallest hash."""
    found = near_groups(docs, shingle, distance)
    keepers = cut(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
                  .agg(F.first("doc_id").alias("id"), F.min("text_hash").alias("hash")))
    key, side_key = fresh(docs.columns, "near_key", "near_keeper")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("hash")))
    side = keepers.select(F.struct("id", "hash").alias(side_key))
    # The one movement of texts; rows repeated with the keeper's id and text are in its partition already.
    kept = keyed.join(side, keyed[key] == side[side_key], "left_semi")
    return kept.dropDuplicates([key]).select(*docs.columns)
