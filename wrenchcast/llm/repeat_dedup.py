"""Operator 9: removal of repeated byte strings with suffix orders built by linear grouping.

Which 400-byte strings start more than once in the corpus is decided in four steps, none of which holds a corpus:

1. Every window of 400 bytes marks its least ``ANCHOR``-byte gram (by hash) as its anchor, so equal windows have equal
   anchors, at one byte in about 150. Anchors are grouped by their hash; only anchors that occur in several places can
   lie in a repeated window. Copies of a whole text count as one text, all of whose windows repeat.
2. All windows with an anchor lie in its context, 700 bytes around it. A context that stands in several places repeats
   as a whole.
3. The different contexts of an anchor are brought together, one copy of each, trimmed to what they share with another,
   joined by separators, and their suffixes ordered (``suffix_order``): equal windows are neighbours in the order and
   are compared by their bytes.
4. The repeated intervals, and those inside one text, which are found where it is read, go back to the texts.

An anchor whose different contexts exceed ``BLOCK`` bytes is not brought together: its windows are cut where the
contexts are read, and equal ones are found by grouping their 128-bit hashes, which spreads over all tasks.

Defined results: null text counts as empty; texts below 400 bytes lose nothing; rows repeated with one text are copies
of it; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, write_out
from .suffix_order import suffix_order

WINDOW, ANCHOR, BLOCK = 400, 100, 1 << 19
CONTEXT = 2 * WINDOW - ANCHOR
_BASE = 0x9E3779B1  # odd, so that it has an inverse
_PART = 1 << 20  # windows of a text hashed at a time


def _powers(base: int, n: int, kind: type) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate(([1], np.full(n, base))).astype(kind), dtype=kind)


_UP, _DOWN = (_powers(x, _PART + WINDOW, np.uint32) for x in (_BASE, pow(_BASE, -1, 1 << 32)))


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """32-bit hash of the ``size`` bytes from each position of at most ``_PART + WINDOW`` bytes."""
    n = len(raw) - size + 1
    with np.errstate(over="ignore"):
        total = np.empty(len(raw) + 1, dtype=np.uint32)
        total[0] = 0
        np.cumsum((raw.astype(np.uint32) + np.uint32(1)) * _UP[:len(raw)], dtype=np.uint32, out=total[1:])
        h = (total[size:] - total[:n]) * _DOWN[:n]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` values from each position: of running minima to the right and left of block borders."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    grid = np.full((blocks, width), np.iinfo(values.dtype).max, dtype=values.dtype)
    grid.ravel()[:len(values)] = values
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def anchors_of(data: bytes) -> np.ndarray:
    """Place of the anchor of each window of ``data``: the leftmost least gram in it. Places never fall."""
    width = WINDOW - ANCHOR + 1
    out = []
    for at in range(0, len(data) - WINDOW + 1, _PART):
        raw = np.frombuffer(data, dtype=np.uint8)[at:at + _PART + WINDOW - 1]
        h = gram_hashes(raw, ANCHOR).astype(np.uint64)
        placed = h << np.uint64(32) | np.arange(len(h), dtype=np.uint64)
        out.append((sliding_least(placed, width) & np.uint64(0xFFFFFFFF)).astype(np.int64) + at)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def repeats_inside(data: bytes, anchors: np.ndarray, places: np.ndarray, hashes: list[int]) -> tuple[list, list]:
    """Windows of ``data`` that start in several of its places: the starts of all, and without the first of each.

    ``places`` are the different ``anchors`` and ``hashes`` those of their grams: only windows whose anchor's gram
    stands in several places are compared.
    """
    if len(set(hashes)) == len(hashes):
        return [], []
    _, number, count = np.unique(np.array(hashes, dtype=np.uint64), return_inverse=True, return_counts=True)
    candidate = np.flatnonzero(count[number][np.searchsorted(places, anchors)] > 1)
    first: dict[bytes, int] = {}
    later, every = [], set()
    for s in candidate.tolist():
        at = first.setdefault(data[s:s + WINDOW], s)
        if at != s:
            later.append(s)
            every.update((at, s))
    return sorted(every), later


def text_key(data: bytes) -> bytes:
    return hashlib.md5(data).digest()


def _key_column(text: Column) -> Column:
    return F.unhex(F.md5(text))


def context(data: bytes, pos: int) -> tuple[int, bytes]:
    """Bytes left of the anchor in its context, and the context."""
    left = min(pos, WINDOW - ANCHOR)
    return left, data[pos - left:pos + WINDOW]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of the windows of each text, of repeated windows only those of the first: rows (t, pos, h, ctx).

    Intervals that repeat inside a text are rows (t, pos, stop).
    """
    rows: list[tuple] = []
    for batch in batches:
        for data in batch.column(0).to_pylist():
            t = text_key(data)
            anchors = anchors_of(data)
            places = anchors[np.concatenate(([True], anchors[1:] != anchors[:-1]))]
            at = places.tolist()
            hashes = [xxhash.xxh3_64_intdigest(data[p:p + ANCHOR]) for p in at]
            every, later = repeats_inside(data, anchors, places, hashes)
            if later:
                rows += [(t, a, b, None, None) for a, b in runs(every)]
                fresh = np.ones(len(anchors), dtype=bool)
                fresh[later] = False
                wanted = set(anchors[fresh].tolist())
                at, hashes = zip(*[(p, h) for p, h in zip(at, hashes) if p in wanted])
            for p, h in zip(at, hashes):
                left, piece = context(data, p)
                rows.append((t, p, None, _signed(h), _signed(xxhash.xxh3_64_intdigest(piece, left))))
            if len(rows) > 20_000:
                yield _batch(rows, _ANCHORS)
                rows = []
    yield _batch(rows, _ANCHORS)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_ANCHORS = [("t", pa.binary()), ("pos", pa.int64()), ("stop", pa.int64()), ("h", pa.int64()), ("ctx", pa.int64())]
_PIECE = [("h", pa.int64()), ("t", pa.binary()), ("pos", pa.int64()), ("several", pa.bool_()),
          ("crowded", pa.bool_()), ("lead", pa.int64()), ("bytes", pa.binary())]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the contexts asked for, of rows (t, text, asked)."""
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for t, data, asked in zip(*(c.to_pylist() for c in batch.columns)):
            for a in asked:
                rows.append((a["h"], t, a["pos"], a["several"], a["crowded"], *context(data, a["pos"])))
                held += CONTEXT
                if held > 4 << 20:
                    yield _batch(rows, _PIECE)
                    rows, held = [], 0
    yield _batch(rows, _PIECE)


def repeated_starts(pieces: list[bytes], places: list[tuple], several: list[bool]) -> list[list[int]]:
    """Per piece, the starts of its windows that start in another place too.

    ``places``: text and position of a piece's first byte, so that overlapping pieces of one text are told apart from
    repeats; a piece that stands in ``several`` places repeats by itself.
    """
    text: list[int] = []
    begins = []
    for k, piece in enumerate(pieces):
        begins.append(len(text))
        text += piece
        text.append(256 + k)  # every separator differs, so no match runs over it
    order = np.array(suffix_order(text))
    piece_of = np.searchsorted(begins, order, side="right") - 1
    start = order - np.array(begins)[piece_of]
    whole = start + WINDOW <= np.array([len(p) for p in pieces])[piece_of]
    found: list[list[int]] = [[] for _ in pieces]
    run: list[tuple[int, int]] = []
    last = None

    def close() -> None:
        if len(run) > 1 and (any(several[k] for k, _ in run)
                             or len({(places[k][0], places[k][1] + s) for k, s in run}) > 1):
            for k, s in run:
                found[k].append(s)

    for k, s in zip(piece_of[whole].tolist(), start[whole].tolist()):
        window = pieces[k][s:s + WINDOW]
        if window != last:
            close()
            run, last = [], window
        run.append((k, s))
    close()
    return [sorted(f) for f in found]


def runs(starts: list[int], offset: int = 0) -> list[list[int]]:
    """Byte intervals that the windows from ``starts`` (rising) cover, moved by ``offset``."""
    out: list[list[int]] = []
    for s in starts:
        if out and s + offset <= out[-1][1]:
            out[-1][1] = s + offset + WINDOW
        else:
            out.append([s + offset, s + offset + WINDOW])
    return out


_RUNS = pa.list_(pa.list_(pa.int64()))


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def longest_shared(parts: list[bytes]) -> list[int]:
    """How many leading bytes each part shares with some other one, which is a neighbour in their order."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        n = common_prefix(parts[i], parts[j])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def repeated_runs(members: list[dict]) -> list[tuple[bytes, list[list[int]]]]:
    """Text and repeated intervals of the different contexts (t, pos, lead, several, bytes) of one anchor.

    A window with the anchor repeats no further to a side than the bytes that its context shares with another on that
    side of the anchor, so contexts are first trimmed to these; what is too short then has no repeat. Equal trimmed
    contexts repeat as a whole; the suffixes of the different ones are ordered to find the windows they share.
    """
    before = longest_shared([m["bytes"][:m["lead"]][::-1] for m in members])
    behind = longest_shared([m["bytes"][m["lead"] + ANCHOR:] for m in members])
    pieces: dict[tuple[int, bytes], list[dict]] = {}
    for m, l, r in zip(members, before, behind):
        if l + ANCHOR + r >= WINDOW:
            pieces.setdefault((l, m["bytes"][m["lead"] - l:m["lead"] + ANCHOR + r]), []).append(m)
    out = []
    single = []
    for (l, piece), at in pieces.items():
        if len(at) > 1 or at[0]["several"]:
            out += [(m["t"], [[m["pos"] - l, m["pos"] - l + len(piece)]]) for m in at if not m["several"]]
        else:
            single.append((at[0]["t"], at[0]["pos"] - l))
    if single and len(pieces) > 1:
        firsts = [(at[0]["t"], at[0]["pos"] - l) for (l, _), at in pieces.items()]
        several = [len(at) > 1 or at[0]["several"] for at in pieces.values()]
        found = repeated_starts([piece for _, piece in pieces], firsts, several)
        out += [(t, runs(starts, at)) for (t, at), many, starts in zip(firsts, several, found) if starts and not many]
    return out


_FOUND = [("t", pa.binary()), ("runs", _RUNS)]


def _sort_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated intervals of the contexts of each anchor, of rows (members)."""
    for batch in batches:
        yield _batch([row for members in batch.column(0).to_pylist() for row in repeated_runs(members)], _FOUND)


_CUT = [("w", pa.binary()), ("t", pa.binary()), ("start", pa.int64()), ("several", pa.bool_())]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows by their hash, of pieces of anchors too crowded for one block."""
    for batch in batches:
        for t, pos, several, lead, data in zip(*(c.to_pylist() for c in batch.columns)):
            yield _batch([(xxhash.xxh3_128_digest(data[s:s + WINDOW]), t, pos - lead + s, several)
                          for s in range(len(data) - WINDOW + 1)], _CUT)


def _cut_out(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, copies, runs) to what is left of the text."""
    for batch in batches:
        rows = []
        for doc_id, data, copies, found in zip(*(c.to_pylist() for c in batch.columns)):
            spans = [(0, len(data))] if copies and len(data) >= WINDOW else removed_spans(len(data), found or [])
            left, at = [], 0
            for a, b in spans:
                left.append(data[at:a])
                at = b
            left.append(data[at:])
            kept = b"".join(left)
            rows.append((doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                         [list(s) for s in spans], kept if with_text else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _RUNS, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


def removed_spans(n_bytes: int, found: list[list[int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the intervals ``found`` in a text."""
    spans: list[tuple[int, int]] = []
    for a, b in sorted((max(0, a), min(n_bytes, b)) for a, b in found):
        if spans and a <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(b, spans[-1][1])
        else:
            spans.append((a, b))
    return spans


def without_repeats(docs: DataFrame, with_text: bool = False, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans and (``with_text``) kept of every row (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    texts = texts.withColumn("t", _key_column(F.col("text")))
    long_texts = texts.where(F.octet_length("text") >= WINDOW)
    rows = write_out(map_batches(long_texts.select("text"), _anchors, "t binary, pos long, stop long, h long, ctx long"))
    inside = rows.where("stop is not null").select("t", F.array("pos", "stop").alias("run"))
    found = rows.where("stop is null").select("t", "pos", "h", "ctx")
    place = F.xxhash64("t", "pos")
    shared = cut(found.groupBy("h").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("p <> q").select("h"))
    places = cut(found.join(shared, "h").withColumn("place", place).distinct())
    contexts = cut(places.groupBy("h", "ctx").agg(F.min("place").alias("p"), F.max("place").alias("q")))
    several = F.col("p") != F.col("q")
    whole = (places.join(contexts.where(several).select("h", "ctx"), ["h", "ctx"])
             .select("t", F.array(F.col("pos") - (WINDOW - ANCHOR), F.col("pos") + WINDOW).alias("run")))

    uneven = cut(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                 .select("h", (F.col("n") * CONTEXT > block).alias("crowded")))
    # One place of each different context, read from the text's first document.
    wanted = (contexts.join(uneven, "h")
              .select("h", "ctx", F.col("p").alias("place"), several.alias("several"), "crowded"))
    asked = (places.join(wanted, ["h", "ctx", "place"]).groupBy("t")
             .agg(F.collect_list(F.struct("h", "pos", "several", "crowded")).alias("asked")))
    owners = cut(long_texts.groupBy("t").agg(F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("copies")))
    asked = cut(asked.join(owners, "t").select("t", "owner", "asked"))
    source = long_texts.alias("x").join(asked.alias("a"), (F.col("x.t") == F.col("a.t"))
                                        & F.col("x.doc_id").eqNullSafe(F.col("a.owner")))
    pieces = cut(map_batches(source.select("x.t", "x.text", "a.asked"), _contexts,
                             "h long, t binary, pos long, several boolean, crowded boolean, lead long, bytes binary"))
    member = F.struct("t", "pos", "lead", "several", "bytes")
    blocks = pieces.where("not crowded").groupBy("h").agg(F.sort_array(F.collect_set(member)).alias("members"))
    sorted_runs = map_batches(blocks.select("members"), _sort_contexts, "t binary, runs array<array<bigint>>")
    windows = map_batches(pieces.where("crowded").select("t", "pos", "several", "lead", "bytes"), _windows,
                          "w binary, t binary, start long, several boolean")
    at = F.xxhash64("t", "start")
    twice = cut(windows.groupBy("w").agg(F.min(at).alias("a"), F.max(at).alias("b"), F.max("several").alias("s"))
                .where("a <> b or s").select("w"))
    hashed_runs = (windows.where("not several").join(twice, "w")
                   .select("t", F.array("start", F.col("start") + WINDOW).alias("run")))
    runs_of = (sorted_runs.select("t", F.explode("runs").alias("run")).unionByName(hashed_runs).unionByName(whole)
               .unionByName(inside)
               .groupBy("t").agg(F.collect_set("run").alias("runs")))
    # Written out, so that AQE can split a text with very many copies in the join with the documents.
    side = cut(runs_of.join(owners.where("copies > 1").select("t", F.lit(True).alias("copied")), "t", "full"))
    joined = (texts.join(side, "t", "left")
              .select("doc_id", "text", F.coalesce("copied", F.lit(False)).alias("copies"), "runs"))
    return map_batches(joined, lambda b: _cut_out(b, with_text),
                       "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                       "spans array<array<bigint>>, kept binary")
