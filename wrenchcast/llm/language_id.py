"""Operator 7: language identification with language-bitmask n-gram filters.

Training counts the letter n-grams of each language over all its rows. A language keeps the n-grams whose relative
frequency in it is at least ``RATIO`` times the highest of any language, so passages in another language leave no mark,
and at least ``MIN_SHARE`` of all its n-grams: what is rarer decides no text. The kept n-grams go to one bit-sliced Bloom filter: a table of slots, each a mask with one bit per language. The AND of
an n-gram's slots names all languages that contain it, in one look-up whatever their number. A text's hits are counted
per language; a language's false-positive rate, known from how full its slice is, corrects the share
(hits / n - rate) / (1 - rate), and the largest share decides.

The filter is the model, and its size is bounded without ranking or dropping by number: at most 1 / ``MIN_SHARE``
n-grams of a language can have that share, however long the corpus. Its slots are made on Spark (a bit-or per slot), and
the masks alone are collected and broadcast.

Defined results: null texts and texts without a letter are ``und`` with score 0; without any training row all are; ties
and texts without a hit go to the language with the most n-grams in training, then by name; a null doc_id is not held
out; rows repeated count each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, hint_broadcast, map_batches, write_out

SIZES = (2, 3)
RATIO, MIN_COUNT, MIN_SHARE = 0.25, 2, 2.0 ** -17
HASHES, SLOTS_PER_GRAM = 3, 8
_CHUNK = 1 << 19  # code points handled at a time
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
SPACE = 32


@cache
def _letter_table() -> np.ndarray:
    """Whether a code point below 2**17 is a letter; higher ones are ideographs up to 2**18."""
    return np.array([chr(i).isalpha() for i in range(1 << 17)])


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, a space for what is no letter, and the position where each text starts.

    Every text starts with a space and the last is followed by one.
    """
    lowered = [" " + t.lower() for t in texts]
    starts = np.cumsum([0, *map(len, lowered)])
    data = ("".join(lowered) + " ").encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(data, dtype="<u4").astype(np.uint64)
    table = _letter_table()
    known = points < len(table)
    is_letter = np.where(known, table[np.where(known, points, 0).astype(np.int64)], points < (1 << 18))
    return np.where(is_letter, points, np.uint64(SPACE)), starts


def grams(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams and their positions: a space may stand at the ends, not inside, and not alone."""
    n = len(points) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    space = points == SPACE
    packed = points[:n].copy()
    inside = np.zeros(n, dtype=bool)
    for k in range(1, size):
        packed = packed << np.uint64(21) | points[k:n + k]
        if k < size - 1:
            inside |= space[k:n + k]
    if size == 2:
        inside = space[:n] & space[1:n + 1]
    at = np.flatnonzero(~inside)
    return packed[at] | np.uint64(size << 61), at


def _chunks(items: list, length: list[int]) -> Iterator[list]:
    part, held = [], 0
    for item, n in zip(items, length):
        part.append(item)
        held += n
        if held >= _CHUNK:
            yield part
            part, held = [], 0
    if part:
        yield part


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            for part in _chunks(texts, [len(t) for t in texts]):
                points, _ = letters(part)
                for size in SIZES:
                    found, n = np.unique(grams(points, size)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)),
                         pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


@dataclass
class Model:
    languages: list[str]  # by falling number of training n-grams
    slots: np.ndarray  # (slots, words) masks
    rates: np.ndarray  # false-positive rate of each language

    @staticmethod
    def of_marks(languages: list[str], bits: int, slot: np.ndarray, word: np.ndarray, mask: np.ndarray) -> Model:
        """The model of ``marks``."""
        slots = np.zeros((1 << bits, max(1, -(-len(languages) // 64))), dtype=np.uint64)
        np.bitwise_or.at(slots, (slot, word), mask.view(np.uint64))
        full = np.array([np.mean(slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(languages))])
        return Model(languages, slots, full ** HASHES)

    @staticmethod
    def places(gram: np.ndarray, bits: int) -> list[np.ndarray]:
        with np.errstate(over="ignore"):
            mixed = [(gram ^ gram >> np.uint64(29)) * m for m in _MIX]
        return [(m >> np.uint64(64 - bits)).astype(np.int64) for m in mixed]

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each language in each text, and whether it has a letter."""
        points, starts = letters(texts)
        bits = len(self.slots).bit_length() - 1
        hits = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        for size in SIZES:
            gram, at = grams(points, size)
            # an n-gram that ends at the next text's leading space belongs to the text where it starts
            edge = np.searchsorted(at, starts[1:])
            first = np.concatenate(([0], edge))
            total += np.diff(first)
            where = self.places(gram, bits)
            for w in range(self.slots.shape[1]):
                mask = self.slots[where[0], w]
                for place in where[1:]:
                    mask = mask & self.slots[place, w]
                for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                    bit = (mask >> np.uint64(i % 64) & np.uint64(1)).astype(np.int64)
                    run = np.concatenate(([0], np.cumsum(bit)))
                    hits[:, i] += run[first[1:]] - run[first[:-1]]
        share = (hits / np.maximum(total, 1)[:, None] - self.rates) / np.maximum(1 - self.rates, 1e-9)
        letter = np.concatenate(([0], np.cumsum(points != SPACE)))
        return np.clip(share, 0, 1), letter[starts[1:]] > letter[starts[:-1]]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        asked = [i for i, t in enumerate(texts) if t]
        if not self.languages:
            return names, scores
        for part in _chunks(asked, [len(texts[i]) for i in asked]):
            share, letter = self.shares([texts[i] for i in part])
            best = share.argmax(axis=1)
            sums = share.sum(axis=1)
            for k, i in enumerate(part):
                if letter[k]:
                    names[i] = self.languages[best[k]]
                    scores[i] = float(share[k, best[k]] / sums[k]) if sums[k] > 0 else 0.0
        return names, scores


def filter_bits(distinct: int) -> int:
    """Address bits of a filter for so many n-grams."""
    return max(6, int(np.ceil(np.log2(max(1, distinct) * SLOTS_PER_GRAM))))


def marks(lang: np.ndarray, gram: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot, word of the slot and mask that n-grams of languages (by number) set."""
    bit = (np.uint64(1) << (lang % 64).astype(np.uint64)).view(np.int64)
    places = Model.places(gram.view(np.uint64), bits)
    return np.concatenate(places), np.tile(lang // 64, HASHES), np.tile(bit, HASHES)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``fold``; false for null."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % folds == fold, F.lit(False))


def train(rows: DataFrame, ratio: float = RATIO, min_share: float = MIN_SHARE) -> Model:
    """Model of ``rows`` (lang, text); rows with a null are left out."""
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = (map_batches(rows.where("lang is not null and text is not null"), _count,
                           "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counted = cut(counted)
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    names = [r["lang"] for r in totals.orderBy(F.desc("total"), "lang").collect()]  # one row per language
    shared = (counted.join(hint_broadcast(totals, len(names), 64), "lang")
              .withColumn("share", F.col("n") / F.col("total")))
    top = shared.groupBy("gram").agg(F.max("share").alias("top"))
    enough = (F.col("n") >= MIN_COUNT) & (F.col("share") >= F.greatest(ratio * F.col("top"), F.lit(min_share)))
    kept = write_out(shared.join(top, "gram").where(enough).select("lang", "gram"))
    bits = filter_bits(kept.select("gram").distinct().count())
    number = {lang: i for i, lang in enumerate(names)}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.fromiter(map(number.get, batch.column(0).to_pylist()), np.int64, batch.num_rows)
            found = marks(lang, batch.column(1).to_numpy(zero_copy_only=False), bits)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["slot", "word", "mask"])

    slots = (map_batches(kept, mark, "slot long, word long, mask long").groupBy("slot", "word")
             .agg(F.bit_or("mask").alias("mask")).toPandas())
    return Model.of_marks(names, bits, *[slots[c].to_numpy(np.int64) for c in ("slot", "word", "mask")])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with lang_pred and score."""
    others = [c for c in docs.columns if c != text and c.lower() not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())], [*others, "lang_pred", "score"])

    rows = docs.select(F.col(text).cast("string").alias(text), *[F.col(f"`{c}`") for c in others])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return map_batches(rows, run, f"{kinds}, lang_pred string, score double")
