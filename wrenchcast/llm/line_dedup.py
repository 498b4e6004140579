"""Operator 3: line dedup by pairwise alignment.

Lines are hashed (128 bits, without outer ASCII white space; blank lines have no part); repeated lines are told apart by
their occurrence number, which makes every line unique in its document. Two documents are aligned by patience diff over
all lines that both hold: the longest rising chain of them is the alignment, and its runs of lines that are neighbours in
both documents are the aligned common blocks. Blocks of ``MIN_BLOCK_WORDS`` words or more are deleted from the later
document. A document loses what its alignment with any earlier one deletes.

Not every pair is aligned to find that. Each line of a deleted block is in a run of neighbours, the shortest ones around
it with ``MIN_BLOCK_WORDS`` words, that the earlier document holds as well. So a document is aligned with the earliest
holder of each of its runs, which for nearly all runs deletes them; documents that keep a line of a shared run (the
chain went another way) are aligned with the earliest holder of each two successive shared lines, and then with the
further holders of the runs still open, more of them each round, until every line is deleted or its run has no holder
left. The result is that of all pairs; a run costs a row per holder, however many documents hold it.

Defined results: earlier means a smaller doc_id; rows that share a doc_id are one document (each is aligned by itself,
none against another); n_partners counts the documents whose alignment was asked for and deleted lines; a null doc_id has
no place in the order, so such rows stay as they are and delete nothing; null text stays null; documents of which no line
with a word is left are emptied and ``drop_emptied`` leaves them out (texts that had no word before stay); repeats inside
one document stay; other columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, map_batches

MIN_BLOCK_WORDS = 3
#: Further holders that the first round after the earliest ones asks per run; each later round asks ``_MORE`` times as many.
_FURTHER, _MORE = 8, 4
_SLICES = 32  # parts in which the holders of a run are sorted
_RUNS = "doc_id long, text_hash long, key binary, run array<long>"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "pos", "ordinal", "words", "key"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text_hash, text in zip(*(c.to_pylist() for c in batch.columns)):
            seen: dict[bytes, int] = {}
            ordinal = 0
            for pos, line in enumerate(text.split(b"\n")):
                words = line.split()
                if words:
                    h = xxhash.xxh3_128_digest(line.strip())
                    seen[h] = occ = seen.get(h, 0) + 1
                    key = h if occ == 1 else xxhash.xxh3_128_digest(h, occ)
                    rows.append((doc_id, text_hash, pos, ordinal, len(words), key))
                    ordinal += 1
            if len(rows) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def rising_chain(values: list[int]) -> list[int]:
    """Indices of a longest strictly rising subsequence, by patience sorting."""
    if all(a < b for a, b in zip(values, values[1:])):
        return list(range(len(values)))
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(values)
    for i, v in enumerate(values):
        at = bisect_left(tops, v)
        below[i] = piles[at - 1] if at else -1
        if at == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[at], piles[at] = v, i
    chain, i = [], piles[-1]
    while i >= 0:
        chain.append(i)
        i = below[i]
    return chain[::-1]


def common_blocks(anchors: list[tuple[int, int, int, int]], min_words: int = MIN_BLOCK_WORDS) -> list[int]:
    """Line numbers to delete from the later document.

    ``anchors``: line's ordinal in the later and the earlier document, its line number and words; by the first.
    """
    out: list[int] = []
    block: list[int] = []
    words, last = 0, (-2, -2)
    for i in rising_chain([a[1] for a in anchors]):
        late, early, pos, n = anchors[i]
        if (late, early) != (last[0] + 1, last[1] + 1):
            out += block if words >= min_words else []
            block, words = [], 0
        block.append(pos)
        words += n
        last = late, early
    return out + (block if words >= min_words else [])


def shortest_runs(ordinals: list[int], words: list[int], min_words: int) -> set[tuple[int, int]]:
    """First and last index of the shortest runs of neighbours that have ``min_words`` words, around every line."""
    total = [0]
    for n in words:
        total.append(total[-1] + n)
    out = set()
    low = high = 0  # the lines low to high - 1 are neighbours
    for i, n in enumerate(words):
        if i == high:
            low, high = i, i + 1
            while high < len(words) and ordinals[high] == ordinals[high - 1] + 1:
                high += 1
        if n >= min_words:
            out.add((i, i))
            continue
        end = min(high, i + min_words)  # a line has a word at least
        for start in range(i, low - 1, -1):
            if total[end] - total[start] < min_words:
                continue
            while end - 1 > i and total[end - 1] - total[start] >= min_words:
                end -= 1
            if start == i or total[end] - total[start + 1] < min_words:
                out.add((start, end - 1))
            if total[i + 1] - total[start] >= min_words:
                break
    return out


def _runs(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Identifier and line numbers of each shortest run."""
    for batch in batches:
        rows = []
        for doc_id, text_hash, ordinals, pos, words, keys in zip(*(c.to_pylist() for c in batch.columns)):
            for i, k in shortest_runs(ordinals, words, min_words):
                key = keys[i] if i == k else xxhash.xxh3_128_digest(b"".join(keys[i:k + 1]))
                rows.append((doc_id, text_hash, key, pos[i:k + 1]))
        yield _keyed(rows)


def _successive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identifier of each two shared lines with no shared line between them."""
    for batch in batches:
        rows = []
        for doc_id, text_hash, keys in zip(*(c.to_pylist() for c in batch.columns)):
            rows += [(doc_id, text_hash, xxhash.xxh3_128_digest(a + b), None) for a, b in zip(keys, keys[1:])]
        yield _keyed(rows)


def _keyed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 4, kinds)],
                                      ["doc_id", "text_hash", "key", "run"])


def _align(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doomed = []
        for ordinals, pos, words, keys, early_ordinals, early_keys in zip(*(c.to_pylist() for c in batch.columns[3:])):
            early = dict(zip(early_keys, early_ordinals))
            anchors = [(o, early[k], p, n) for o, p, n, k in zip(ordinals, pos, words, keys) if k in early]
            doomed.append(common_blocks(anchors, min_words) if anchors else [])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(doomed, pa.list_(pa.int64()))],
                                         ["doc_id", "text_hash", "early_id", "doomed"])


def _earliest(keyed: DataFrame) -> DataFrame:
    """``keyed`` with early_id, the earliest document of the key, where that is another one."""
    first = (keyed.groupBy("key").agg(F.min("doc_id").alias("early_id"), F.max("doc_id").alias("last_id"))
             .where("early_id < last_id").drop("last_id"))
    # Written out, so that both sides of the join are shuffled and AQE can split a run that very many documents hold.
    return keyed.join(cut(first), "key").where("doc_id > early_id")


def _aligned(pairs: DataFrame, packed: DataFrame, min_words: int) -> DataFrame:
    """doc_id, text_hash, early_id, doomed of those of ``pairs`` (doc_id, text_hash, early_id) that delete lines."""
    early = packed.select(F.col("doc_id").alias("early_id"), F.col("ordinal").alias("early_ordinal"),
                          F.col("key").alias("early_key"))
    rows = (pairs.select("doc_id", "text_hash", "early_id").distinct().join(early, "early_id")
            .join(packed, ["doc_id", "text_hash"])
            .select("doc_id", "text_hash", "early_id", "ordinal", "pos", "words", "key", "early_ordinal", "early_key"))
    out = map_batches(rows, lambda b: _align(b, min_words),
                      "doc_id long, text_hash long, early_id long, doomed array<long>")
    return cut(out.where(F.size("doomed") > 0))


def _summed(aligned: DataFrame) -> DataFrame:
    """Distinct deleted lines and the number of partners of each document, whose row is no longer than its lines."""
    of = ["doc_id", "text_hash"]
    lines = aligned.select(*of, F.explode("doomed").alias("line"), F.lit(None).cast("long").alias("partner"))
    partners = aligned.select(*of, F.lit(None).cast("long").alias("line"), F.col("early_id").alias("partner"))
    return (lines.unionByName(partners).groupBy(*of, "line", "partner").agg(F.lit(1).alias("one"))
            .repartition(*of).groupBy(*of).agg(F.collect_list("line").alias("doomed"), F.count("partner").alias("n_partners")))


def _nearest(holders: DataFrame, further: int) -> DataFrame:
    """The first ``further`` next_id of each key of ``holders`` (key, next_id), numbered by n from 1. Checkpointed.

    Numbered within slices of a key first, so that a run with very many holders is sorted by ``_SLICES`` tasks.
    """
    first = F.row_number().over(Window.partitionBy("key", "slice").orderBy("next_id"))
    sliced = (holders.withColumn("slice", F.pmod(F.xxhash64("next_id"), F.lit(_SLICES))).repartition("key", "slice")
              .distinct().withColumn("n", first).where(F.col("n") <= further))
    n = F.row_number().over(Window.partitionBy("key").orderBy("next_id"))
    return cut(sliced.select("key", "next_id").withColumn("n", n).where(F.col("n") <= further))


def _open(runs: DataFrame, aligned: DataFrame) -> DataFrame:
    """Those of ``runs`` of which a line is not deleted yet. Checkpointed."""
    left = runs.join(_summed(aligned).drop("n_partners"), ["doc_id", "text_hash"], "left")
    kept = F.col("doomed").isNull() | (F.size(F.array_except("run", "doomed")) > 0)
    return cut(left.where(kept).select(*runs.columns))


def doomed_lines(docs: DataFrame, min_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """doc_id, text_hash, doomed (line numbers to delete), n_partners of the documents that lose lines. Checkpointed."""
    text = F.col("text").cast("string")
    rows = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("text"))
    lines = map_batches(rows, _lines, "doc_id long, text_hash long, pos long, ordinal int, words int, key binary")
    shared = (lines.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
              .where("first_id < last_id").select("key"))
    packed = cut(lines.join(cut(shared), "key").groupBy("doc_id", "text_hash")
                 .agg(F.sort_array(F.collect_set(F.struct("ordinal", "pos", "words", "key"))).alias("lines"))
                 .select("doc_id", "text_hash", *[F.col(f"lines.{c}").alias(c) for c in ("ordinal", "pos", "words", "key")]))
    runs = cut(map_batches(packed, lambda b: _runs(b, min_words), _RUNS))
    first = cut(_earliest(runs))
    aligned = _aligned(first, packed, min_words)

    left = _open(first, aligned)
    if not left.isEmpty():
        successive = map_batches(packed.select("doc_id", "text_hash", "key"), _successive, _RUNS)
        of_left = _earliest(successive).join(left.select("doc_id", "text_hash").distinct(), ["doc_id", "text_hash"])
        aligned = aligned.union(_aligned(of_left, packed, min_words))
        left = _open(left, aligned)
    further = _FURTHER
    while not left.isEmpty():
        # early_id: up to which holder a run has been asked for, the same in all documents
        asked = left.groupBy("key").agg(F.max("early_id").alias("asked"), F.max("doc_id").alias("last_id"))
        holders = _nearest(runs.join(asked, "key").where("doc_id > asked and doc_id < last_id")
                           .select("key", F.col("doc_id").alias("next_id")), further)
        pairs = left.drop("early_id").join(holders.drop("n").withColumnRenamed("next_id", "early_id"), "key")
        aligned = aligned.union(_aligned(pairs.where("doc_id > early_id"), packed, min_words))
        up_to = holders.where(F.col("n") == further).select("key", F.col("next_id").alias("early_id"))
        left = _open(left.drop("early_id").join(up_to, "key").where("doc_id > early_id").select(*left.columns), aligned)
        further *= _MORE
    return cut(_summed(aligned))


def dedup_lines(docs: DataFrame, min_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """doc_id, text (what remains), n_lines, n_deleted, n_partners of every row of ``docs``.

    Texts are read for their lines and shuffled once, to meet the line numbers to delete.
    """
    return _deleted(docs.select("doc_id", "text"), min_words, ["n_lines", "n_deleted", "n_partners"])


def drop_emptied(docs: DataFrame, min_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """``docs``, all columns, with the remaining texts and without the documents of which nothing is left."""
    names = fresh(docs.columns, "n_lines", "n_deleted", "n_partners")
    out = _deleted(docs, min_words, names)
    return out.where((F.col(names[1]) == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(*docs.columns)


def _deleted(docs: DataFrame, min_words: int, names: list[str]) -> DataFrame:
    """``docs`` with the remaining text and the three counts under ``names``."""
    id_, hash_, doomed, partners, lines, left = fresh([*docs.columns, *names], "doomed_id", "doomed_hash", "doomed_lines",
                                                      "doomed_partners", "text_lines", "left_lines")
    side = doomed_lines(docs, min_words).toDF(id_, hash_, doomed, partners)
    text = F.col("text").cast("string")
    met = (F.col("doc_id").cast("long") == F.col(id_)) & (F.xxhash64(text) == F.col(hash_))
    joined = docs.join(side, met, "left").withColumn(lines, F.split(text, "\n"))
    joined = joined.withColumn(left, F.array_except(
        F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), F.col(doomed)))
    new = F.array_join(F.transform(F.col(left), lambda i: F.get(F.col(lines), i.cast("int"))), "\n")
    counts = (F.size(lines), F.size(doomed), F.col(partners))
    remaining = F.when(F.col(doomed).isNull(), text).otherwise(new)
    return joined.select(*[remaining.alias(c) if c == "text" else F.col(c) for c in docs.columns],
                         *[F.coalesce(n, F.lit(0)).cast("long").alias(c) for n, c in zip(counts, names)])
