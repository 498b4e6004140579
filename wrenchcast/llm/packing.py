"""Operator 10: packing by order-preserving dynamic programming.

Each partition of documents, in doc_id order, is one run of tokens, every document followed by the end id. A dynamic
program chooses the cuts between sequences at document ends, sentence ends and, in sentences beyond ``LONG`` tokens,
every ``LONG`` tokens. It minimises padding plus a penalty for each cut inside a document, and since the padding of a
window is linear in its two ends, the best predecessor within reach is the head of a monotone queue. A window whose
length is a power of two needs no padding, so those predecessors are tried as well. Documents may be spread over
sequences; no token is dropped. Long runs are cut as they arrive, so a task holds some ``SEGMENT`` tokens.

Defined results: null text counts as empty and gives one piece holding the end id; equal doc_ids are ordered by text and
packed as separate documents; order is kept within a partition, and the result depends on the partitions only; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

LIMIT, END_ID = 2048, 1
SENTENCE_CUT, OTHER_CUT, PER_SEQUENCE = 8, 48, 4  # in tokens of padding
LONG, SEGMENT, CACHED = 512, 1 << 20, 300_000
SPECIAL = "<|endoftext|>"
#: The public byte-level BPE's splitting pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space between two other white-space characters is the one place where a text may not be split before a space.
INSIDE_SPACE = re.compile(r"\s \s")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as characters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def check_spec(spec: dict) -> None:
    """Refuse a tokenizer file that says anything ``Encoder`` does not reproduce."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = [name for name, ok in {
        "model.type": model.get("type") == "BPE",
        "normalizer": spec.get("normalizer") is None,
        "pre_tokenizer": (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) == (
            "ByteLevel", False, True),
        "truncation, padding": spec.get("truncation") is None and spec.get("padding") is None,
        "model options": not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                        "end_of_word_suffix", "byte_fallback", "ignore_merges")),
        "added_tokens": not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip",
                                                                             "normalized")),
    }.items() if not ok]
    # Ids serve as merge ranks: the merges must give all tokens but the bytes, in the order of their ids.
    vocab, special = model["vocab"], {t["content"] for t in spec["added_tokens"]}
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if merged != sorted(i for token, i in vocab.items() if len(token) > 1 and token not in special):
        wrong.append("merges")
    if {token for token in vocab if len(token) == 1} != set(_byte_of_char()):
        wrong.append("byte tokens")
    if wrong:
        raise ValueError(f"tokenizer file not supported: {', '.join(wrong)}")


class Encoder:
    """Ids of a byte-level BPE file, by the word: a text is split before each space, and frequent words are kept."""

    def __init__(self, tokenizer_file: str):
        import tiktoken

        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        check_spec(spec)
        byte = _byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self._bpe = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = list(special)
        self._kept: dict[str, bytes] = {}
        #: Whether a sentence may end after a token: by punctuation or a line break.
        self.ends = np.zeros(max([*ranks.values(), *special.values()]) + 1, dtype=bool)
        for token, i in ranks.items():
            self.ends[i] = token.rstrip(b"\"')]}")[-1:] in (b".", b"!", b"?") or b"\n" in token

    def _ids(self, text: str) -> bytes:
        return np.array(self._bpe.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of ``text``."""
        if any(s in text for s in self.special):
            return np.array(self._bpe.encode(text, allowed_special="all"), dtype="<u4").tobytes()
        if INSIDE_SPACE.search(text):
            return self._ids(text)
        first, *rest = text.split(" ")
        kept = self._kept
        found = list(map(kept.get, rest))
        if None in found:
            if len(kept) > CACHED:
                kept.clear()
            for i, word in enumerate(rest):
                if found[i] is None:
                    found[i] = kept.get(word)
                    if found[i] is None:
                        found[i] = self._ids(" " + word)
                        if len(word) < 64:
                            kept[word] = found[i]
        return (self._ids(first) if first else b"") + b"".join(found)


def choose_cuts(pos: list[int], penalty: list[int], limit: int = LIMIT) -> tuple[list[int], list[float]]:
    """Best predecessor and cost of each boundary; ``pos[0]`` is where the first window starts.

    Neighbouring boundaries are at most ``limit`` apart. A window costs ``limit`` minus its length, or nothing if that is
    a power of two, plus PER_SEQUENCE and the penalty of its right boundary.
    """
    p = np.asarray(pos)
    exact: dict[int, list[int]] = {}
    size = 1
    while size < limit:
        at = np.searchsorted(p, p - size)
        hit = np.flatnonzero(p[np.minimum(at, len(p) - 1)] == p - size)
        for j, i in zip(hit.tolist(), at[hit].tolist()):
            exact.setdefault(j, []).append(i)
        size *= 2
    cost, before = [0.0] * len(pos), [0] * len(pos)
    queue = deque([(pos[0], 0)])  # (cost + position, index), both rising
    for j in range(1, len(pos)):
        here = pos[j]
        while pos[queue[0][1]] < here - limit:
            queue.popleft()
        best, i = queue[0]
        best += limit - here
        if j in exact:
            for k in exact[j]:
                if cost[k] < best:
                    best, i = cost[k], k
        best += PER_SEQUENCE + penalty[j]
        cost[j], before[j] = best, i
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    return before, cost


def binary_tail(length: int, limit: int = LIMIT) -> list[int]:
    """Lengths of the last sequences: powers of two where their cuts cost less than the padding."""
    if 0 < length < limit and length.bit_count() * (OTHER_CUT + PER_SEQUENCE) < limit - length:
        return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    return [length]


class Packer:
    """Packs one partition: documents go in, rows of pieces come out as soon as their sequences are settled."""

    def __init__(self, ends: np.ndarray, sequence_id: int, limit: int = LIMIT, segment: int = SEGMENT):
        self.ends, self.sequence_id, self.limit, self.segment = ends, sequence_id, limit, segment
        self.docs: deque[list] = deque()  # doc_id, ids, ids already packed, all ids
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        n = len(ids) // 4
        self.docs.append([doc_id, ids, 0, n])
        self.held += n
        if self.held >= self.segment:
            yield from self.pack(False)

    def pack(self, last: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        run = np.frombuffer(b"".join(memoryview(d[1])[4 * d[2]:] for d in self.docs), dtype="<u4")
        doc_ends = np.cumsum([d[3] - d[2] for d in self.docs])
        stops = np.union1d(np.flatnonzero(self.ends[run]) + 1, doc_ends)
        long = min(LONG, self.limit)
        stops = np.concatenate(([0], stops))
        wide = np.flatnonzero(np.diff(stops) > long)
        inner = [np.arange(stops[w] + long, stops[w + 1], long) for w in wide]
        pos = np.sort(np.concatenate([stops, *inner]))
        penalty = np.where(self.ends[run[np.maximum(pos - 1, 0)]], SENTENCE_CUT, OTHER_CUT)
        penalty[np.isin(pos, doc_ends)] = 0
        pos = pos.tolist()
        before, cost = choose_cuts(pos, penalty.tolist(), self.limit)
        j = len(pos) - 1
        if not last:  # the best end near the end of the run; windows close to it stay open
            j = min((k for k in range(len(pos)) if pos[k] > pos[-1] - self.limit), key=cost.__getitem__)
        cuts = [j]
        while j:
            j = before[j]
            cuts.append(j)
        cuts = [pos[k] for k in reversed(cuts)]
        if last:
            start = cuts[-2] if len(cuts) > 1 else 0
            cuts[-1:] = (start + np.cumsum(binary_tail(cuts[-1] - start, self.limit))).tolist()
        else:
            cuts = [c for c in cuts if c <= pos[-1] - 4 * self.limit]
        for left, right in zip(cuts, cuts[1:]):
            yield from self.emit(right - left)

    def emit(self, length: int) -> Iterator[tuple]:
        offset = 0
        while offset < length:
            doc_id, ids, start, total = doc = self.docs[0]
            take = min(total - start, length - offset)
            yield doc_id, start, total, self.sequence_id, offset, ids[4 * start:4 * (start + take)]
            doc[2] += take
            offset += take
            if doc[2] == total:
                self.docs.popleft()
        self.held -= length
        self.sequence_id += 1


SCHEMA = "doc_id long, start long, doc_tokens long, sequence_id long, offset long, ids binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_ENCODERS: dict[str, Encoder] = {}


def default_tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _pack(batches: Iterator[pa.RecordBatch], tokenizer_file: str | None, limit: int) -> Iterator[pa.RecordBatch]:
    file = tokenizer_file or default_tokenizer_file()
    encoder = _ENCODERS.get(file) or _ENCODERS.setdefault(file, Encoder(file))
    context = TaskContext.get()
    packer = Packer(encoder.ends, (context.partitionId() if context else 0) << 33, limit)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    rows: list[tuple] = []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows += packer.add(doc_id, encoder.encode(text or "") + end)
            if len(rows) >= 2000:
                yield out(rows)
                rows = []
    rows += packer.pack(True)
    for i in range(0, len(rows), 2000):
        yield out(rows[i:i + 2000])


def pack_documents(docs: DataFrame, tokenizer_file: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, start, doc_tokens, sequence_id, offset, ids.

    ``ids`` are little-endian unsigned 32-bit ids. Nothing is shuffled: each partition is packed by itself, in a fixed
    order, so a task that runs again gives the same pieces.
    """
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .sortWithinPartitions("doc_id", "text"))
    return map_batches(ordered, lambda b: _pack(b, tokenizer_file, limit), SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with their length and the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
