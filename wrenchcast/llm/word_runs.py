"""Operator 11: periodic run detection with string synchronising sets.

A run is a maximal stretch of words with smallest period q and at least ``EXPONENT`` q words. Texts are handled one by
one inside their tasks (nothing is shuffled); a chunk of texts is one array of exact word numbers, with a separator of
its own after each text.

At a dyadic scale t a position i is selected if the smallest hash among the t-word blocks that start in [i, i + t] is
that of the first or of the last block: a choice that depends on the 2t words from i alone. Blocks of period t / 4 or
less have no hash; they lie inside runs that smaller scales have found. For a run of period p in [t, 2t) this gives:

- its blocks are not all without a hash, so a position is selected in each t + 1 neighbouring ones, and so, the run
  having 4p words, at some i with i + p + 2t still inside it;
- i + p is selected too, as the words are the same, and no position between them has the same context of 2t words (else
  the run had a smaller period). So neighbouring selected positions of equal context propose p.

Selected positions number O(words / t) whatever the text, as equal hashes in a block without a small period are more
than t / 4 apart. Each proposal is extended word by word to both sides, galloping, and kept if it is long enough. The
highly periodic regions that have no selected positions hold the periods below ``SMALLEST``; those are read off the
stretches where words equal the ones p further on. Hashes (64 bits) only order and propose; what is returned has been
compared word by word.

Defined results: null and empty texts have no runs and collapse to the empty text; a text of any length is handled
whole; rows repeated are handled each; input columns other than the text stay, those named ``runs`` or ``collapsed``
are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAK, map_batches

EXPONENT, MIN_LENGTH = 4, 6
SMALLEST = 8  # first scale; smaller periods are found directly
_CHUNK = 1 << 18  # words handled at a time, or one longer text
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_NONE = np.uint64(2**64 - 1)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _C
    x = (x ^ x >> np.uint64(29)) * _A
    return x ^ x >> np.uint64(32)


def _double(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of blocks of twice ``size`` words."""
    return _mix(h[:-size] * _A + (h[size:] ^ _B))


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours; ``width`` is a power of two."""
    size = 1
    while size < width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return h


def _equal_ahead(x: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` on equal those from ``b`` on (a < b)."""
    total, step = 0, 64
    while True:
        right = x[b + total:b + total + step]
        differ = np.flatnonzero(x[a + total:a + total + len(right)] != right)
        if len(differ):
            return total + int(differ[0])
        total += len(right)
        if len(right) < step:
            return total
        step *= 2


def _equal_behind(x: np.ndarray, a: int, b: int) -> int:
    """How many words before ``a`` equal those before ``b`` (a < b)."""
    total, step = 0, 64
    while True:
        n = min(step, a - total)
        differ = np.flatnonzero(x[a - total - n:a - total] != x[b - total - n:b - total])
        if len(differ):
            return total + n - 1 - int(differ[-1])
        total += n
        if n < step:
            return total
        step *= 2


def _small_periods(x: np.ndarray, below: int) -> dict[tuple[int, int], int]:
    """Period of each run (start, end) whose period is less than ``below``."""
    found: dict[tuple[int, int], int] = {}
    for p in range(1, min(below, len(x) // EXPONENT + 1)):
        same = np.zeros(len(x) - p + 2, dtype=np.int8)
        same[1:-1] = x[p:] == x[:-p]
        edge = np.flatnonzero(np.diff(same)).reshape(-1, 2)
        for start, end in edge[edge[:, 1] - edge[:, 0] >= (EXPONENT - 1) * p].tolist():
            found.setdefault((start, end + p), p)
    return found


def selected(h: np.ndarray, scale: int, periodic: list[tuple[int, int]]) -> np.ndarray:
    """Selected positions; ``h`` hashes the blocks of ``scale`` words, ``periodic`` are regions of small period."""
    h = _mix(h ^ np.uint64(scale)) >> np.uint64(1)
    for start, end in periodic:
        h[start:end - scale + 1] = _NONE
    least = np.minimum(_window_min(h, scale)[:len(h) - scale], h[scale:])
    return np.flatnonzero(((least == h[:len(least)]) | (least == h[scale:])) & (least != _NONE))


def word_runs(x: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``x`` by start, then period; no text in it has over ``longest`` words."""
    found = _small_periods(x, SMALLEST)
    h, size = _mix(x.view(np.uint64) * _A + _B), 1
    scale = SMALLEST
    while EXPONENT * scale <= longest:
        while size < scale:
            h, size = _double(h, size), 2 * size
        periodic = [(s, e) for (s, e), p in found.items() if 4 * p <= scale <= e - s]
        at = selected(h, scale, periodic)
        context = _double(h, size)
        at = at[at < len(context)]
        order = np.argsort(context[at], kind="stable")
        key, at = context[at][order], at[order]
        gap = at[1:] - at[:-1]
        near = np.flatnonzero((key[1:] == key[:-1]) & (gap >= scale) & (gap < 2 * scale))
        proposed = np.stack([gap[near], at[near]], axis=1)
        reached: dict[int, int] = {}
        for p, i in proposed[np.lexsort((proposed[:, 1], proposed[:, 0]))].tolist():
            if i + p < reached.get(p, 0):
                continue
            start, end = i - _equal_behind(x, i, i + p), i + p + _equal_ahead(x, i, i + p)
            reached[p] = end
            if end - start >= EXPONENT * p:
                found[start, end] = min(p, found.get((start, end), p))
        scale *= 2
    return sorted((s, e - s, p) for (s, e), p in found.items())


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, given by its words."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    parts, starts = [], [0]
    for k, words in enumerate(texts):
        parts += [np.fromiter(map(number.__getitem__, words), np.int64, len(words)), np.array([-1 - k])]
        starts.append(starts[-1] + len(words) + 1)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if texts:
        found = word_runs(np.concatenate(parts), max(map(len, texts)))
        home = np.searchsorted(starts, [s for s, _, _ in found], side="right") - 1
        for (start, length, period), k in zip(found, home.tolist()):
            if length >= min_length:
                out[k].append((start - starts[k], length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def _rows(texts: list[bytes | None], min_length: int) -> Iterator[tuple[list[dict], bytes]]:
    held: list[list[bytes]] = []
    n = 0
    for k, text in enumerate(texts):
        held.append((text or b"").split())
        n += len(held[-1])
        if n >= _CHUNK or k == len(texts) - 1:
            for words, runs in zip(held, runs_of(held, min_length)):
                yield [dict(zip(("start", "length", "period"), r)) for r in runs], collapse(words, runs)
            held, n = [], 0


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` without the text, with ``runs`` (by start, then period) and the ``collapsed`` text.

    Runs of fewer than ``min_length`` words are left out (and collapse nothing).
    """
    others = [c for c in docs.columns if c != text and c.lower() not in ("runs", "collapsed")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, collapsed = zip(*_rows(batch.column(0).to_pylist(), min_length)) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(runs, pa.list_(RUN)), pa.array(collapsed, pa.binary())],
                [*others, "runs", "collapsed"])

    rows = docs.select(F.col(text).cast("string").cast("binary").alias("_text"), *[F.col(f"`{c}`") for c in others])
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    return map_batches(rows, run, kinds + "runs array<struct<start: bigint, length: bigint, period: bigint>>, "
                                          "collapsed binary").withColumn("collapsed", F.col("collapsed").cast("string"))


def with_periodic_tail(docs: DataFrame) -> DataFrame:
    """doc_id and text, every tenth text (by crc32 of the id) with a periodic tail, as the query's contract puts it.

    A null id leaves its text as it is.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), WORD_BREAK), lambda w: w != "")
    rows = (docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
            .withColumn("w", F.when(F.col("h") % 10 == 0, words))
            .withColumn("n", F.size("w").cast("long")))
    g = F.floor(F.col("h") / 10)
    rows = (rows.withColumn("a", F.when(F.col("n") > 0, g % F.col("n")))
            .withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + g % 8))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), periodic_tail(F.col("w"), "n", "a", "p"))
                       .otherwise(F.col("text")).alias("text"))


def periodic_tail(words: Column, n: str, a: str, p: str) -> Column:
    """The first ``a`` of ``n`` words, then the next ``p`` again and again."""
    tail = F.col(n) - F.col(a)
    times = F.ceil(tail / F.col(p)).cast("int")
    cycle = F.slice(words, (F.col(a) + 1).cast("int"), F.col(p).cast("int"))
    again = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), tail.cast("int"))
    return F.array_join(F.concat(F.slice(words, F.lit(1), F.col(a).cast("int")), again), " ")
