"""Operator 5: exact dedup through content-defined chunk recipes.

Texts are cut where a rolling hash of the last 16 bytes has its low bits zero, so equal passages are cut alike wherever
they stand. Chunks are deduplicated to verified identifiers: the bytes of every chunk move once, to be grouped with the
equal ones; a chunk hash under which only one content was found identifies that content, and the contents of any other
hash are numbered. Documents are then compared as ordered lists of identifiers, a few bytes per two kilobytes of text.

Defined results: null counts as the empty text, whose recipe is empty; of equal texts the row with the largest doc_id
stays (null doc_id is the smallest); rows repeated with one doc_id count as rows of their group and share its verdict;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_batches

CUT_BITS, MIN_CHUNK, MAX_CHUNK, ROUNDS = 11, 256, 1 << 16, 4  # chunks of about 2 KB; a window of 2**ROUNDS bytes
#: One odd pseudo-random number per byte value.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) | 1 for b in range(256)], dtype=np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """End offsets of the chunks of ``data``; they depend on its content only."""
    h = GEAR[np.frombuffer(data, dtype=np.uint8)]
    for r in range(ROUNDS):  # h[i] becomes the shifted sum over the last 2**(r+1) bytes
        step = 1 << r
        if len(h) > step:
            nxt = h.copy()
            nxt[step:] += h[:-step] << np.uint32(step)
            h = nxt
    ends, last = [], 0
    for end in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        if end - last >= MIN_CHUNK:
            ends += range(last + MAX_CHUNK, end, MAX_CHUNK)
            ends.append(end)
            last = end
    ends += range(last + MAX_CHUNK, len(data), MAX_CHUNK)
    if data and (not ends or ends[-1] < len(data)):
        ends.append(len(data))
    return ends


def chunks(data: bytes, hash_bits: int) -> list[tuple[int, bytes]]:
    out, last = [], 0
    for end in chunk_ends(data):
        piece = data[last:end]
        out.append(((xxhash.xxh3_64_intdigest(piece) >> (64 - hash_bits)) - (1 << (hash_bits - 1)), piece))
        last = end
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        yield doc_id, (text or b"")


def _recipes(batches: Iterator[pa.RecordBatch], hash_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, shas, lists = [], [], []
        for doc_id, data in _texts(batch):
            ids.append(doc_id)
            shas.append(hashlib.sha256(data).hexdigest())
            lists.append([h for h, _ in chunks(data, hash_bits)])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shas, pa.string()),
                                          pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "sha", "hashes"])


def _chunks(batches: Iterator[pa.RecordBatch], hash_bits: int, located: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(doc_id, hashlib.sha256(data).hexdigest() if located else None, seq, h, piece)
                for doc_id, data in _texts(batch) for seq, (h, piece) in enumerate(chunks(data, hash_bits))]
        cols = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
        keep = range(5) if located else (3, 4)
        yield pa.RecordBatch.from_arrays([pa.array(cols[i], kinds[i]) for i in keep],
                                         [["doc_id", "sha", "seq", "h", "content"][i] for i in keep])


def exact_groups(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs`` (doc_id, text).

    Fewer ``hash_bits`` only make hash collisions common, for tests; the result is the same.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    recipes = map_batches(texts, lambda b: _recipes(b, hash_bits), "doc_id long, sha string, hashes array<long>")
    # The only movement of text: equal chunks are merged before and after it.
    distinct = (map_batches(texts, lambda b: _chunks(b, hash_bits, False), "h long, content binary")
                .groupBy("h", "content").agg(F.lit(1).alias("one")))
    ambiguous = cut(distinct.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    if ambiguous.isEmpty():
        ids = recipes.select("doc_id", "sha", F.col("hashes").alias("recipe"))
    else:
        ids = _number_collisions(texts, recipes, distinct, ambiguous, hash_bits)
    # Written out, so that the join below shuffles both sides and AQE can split a group holding much of the corpus.
    groups = cut(ids.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                 .where("group_size > 1"))
    return (ids.join(groups, "recipe", "left")
            .select("doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).alias("group_size"),
                    F.col("doc_id").eqNullSafe(F.coalesce("keep_id", "doc_id")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def _number_collisions(texts: DataFrame, recipes: DataFrame, distinct: DataFrame, ambiguous: DataFrame,
                       hash_bits: int) -> DataFrame:
    """Recipes of (hash, number among the contents of that hash) where a hash has several contents."""
    numbered = (distinct.join(ambiguous, "h")
                .withColumn("n", F.row_number().over(Window.partitionBy("h").orderBy("content")))
                .select("h", "content", "n"))
    located = map_batches(texts, lambda b: _chunks(b, hash_bits, True),
                               "doc_id long, sha string, seq int, h long, content binary").join(ambiguous, "h")
    numbers = (located.join(numbered, ["h", "content"]).groupBy("doc_id", "sha")
               .agg(F.sort_array(F.collect_set(F.struct("seq", "n"))).alias("numbers")))
    return (recipes.alias("r").join(numbers.alias("n"), F.col("r.doc_id").eqNullSafe(F.col("n.doc_id"))
                                    & (F.col("r.sha") == F.col("n.sha")), "left")
            .select("r.doc_id", "r.sha", F.struct("hashes", "numbers").alias("recipe")))
