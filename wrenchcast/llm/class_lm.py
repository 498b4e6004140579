"""Operator 4: language-model scoring with Brown class-based n-grams.

Training counts every word of the training texts. Clustering has two steps. First the ``CLUSTERED`` most frequent words
and, for all others, ``UNITS`` units of words with equal last three bytes (by checksum) are the elements that the
exchange algorithm assigns to ``CLASSES`` classes, so each word has a class, unseen ones included. Bigrams of elements
are counted over all training texts into a table of at most (elements + 1)**2 rows; each round sums it on Spark to what
each element has before and after it per class, and moves elements, one after the other, to the class that most raises
the likelihood of the class bigrams. Half of the elements move per round, as their sums are those of the round's start.

Then the other frequent words with a count of ``WORD_COUNT`` or more leave their units: Spark counts, per word, the
classes before and after it over all training texts, and each word goes to its class of best exchange gain. All words of
a round move at once, so the gain is taken to first order, from smoothed transitions: the exact gain counts a word's own
bigrams in its new class, which draws very many words into small classes at the same time, and held-out scores fall. The class bigrams are counted again over the texts before
each of the ``WORD_ROUNDS`` rounds and at the end. Only rare and unseen words keep the class of their unit.

P(word | previous) = P(class | previous class) * P(word | class): transitions are interpolated with class frequencies,
emissions are (count + 1/2) / (class count + 1/2 (class words + 1)), the last being a share for unseen words. A text is
scored from the boundary class through its words back to the boundary.

Texts are read twice: for the word counts, and to write each as the codes of its words, which all later steps read. The
frequent words (at most ``CACHED``, as many as have a count above a power of two, of ``WORD_BYTES`` bytes at most) are
broadcast with their counts; all other words meet their counts in a shuffle join and have the class of their unit.

Defined results: null text is empty and has the end as its one token; without training rows all words are unseen; rows
repeated with one doc_id and text give a row each; a null doc_id is in training; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, write_out

CLUSTERED, UNITS, CLASSES, ROUNDS = 2048, 2048, 48, 8
CACHED = 1 << 18
WORD_COUNT, WORD_ROUNDS = 5, 2  # least count of a word that leaves its unit, and rounds of that
SMOOTH = 5.0  # weight of the class frequencies, in counts, where words choose a class
WORD_BYTES = 64  # longer words are not among the frequent ones, so these take a bounded space
BACKOFF = 2.0  # weight of the class frequencies in a transition, in counts
_COUNTED, _PAIRED = 1 << 20, 1 << 22  # tokens counted before rows are handed on


def tokens(data: bytes) -> list[bytes]:
    return data.lower().split()  # both are ASCII only for bytes


def unit(word: bytes) -> int:
    return zlib.crc32(word[-3:]) & (UNITS - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()
    held = 0

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                          ["word", "n"])

    for batch in batches:
        for data in batch.column(0).to_pylist():
            found = tokens(data)
            counts.update(found)
            held += len(found)
            if held > _COUNTED:
                yield rows()
                counts.clear()
                held = 0
    yield rows()


BOUNDARY = CLUSTERED + UNITS
ELEMENTS = BOUNDARY + 1


@dataclass
class Lexicon:
    """The frequent words. A token's code is the index of its word or, behind all words, its unit; -1 is the boundary."""
    words: list[bytes]  # by falling count
    counts: np.ndarray

    def __post_init__(self) -> None:
        self.index = {w: i for i, w in enumerate(self.words)}

    def __reduce__(self) -> tuple:
        return Lexicon, (self.words, self.counts)

    def encode(self, data: bytes) -> tuple[np.ndarray, list[bytes]]:
        """Code of each token, and the tokens that are not frequent."""
        found = tokens(data)
        code = np.fromiter(map(self.index.get, found, repeat(-1)), dtype=np.int32, count=len(found))
        missing = np.flatnonzero(code < 0).tolist()
        rare = [found[i] for i in missing]
        if rare:
            code[missing] = [len(self.words) + unit(w) for w in rare]
        return code, rare

    def elements(self) -> np.ndarray:
        """Element of each code: words, units, and at the end the boundary."""
        n = min(CLUSTERED, len(self.words))
        return np.array([*range(n), *(CLUSTERED + unit(w) for w in self.words[n:]), *range(CLUSTERED, ELEMENTS)],
                        dtype=np.int64)


_RARE = pa.list_(pa.struct([("word", pa.binary()), ("m", pa.int64())]))


def _encode(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            codes, rare = [], []
            for data in part.column(0).to_pylist():
                code, others = lexicon.encode(data)
                codes.append(code)
                rare.append([{"word": w, "m": m} for w, m in Counter(others).items()])
            ends = np.cumsum([0, *map(len, codes)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(codes))),
                 pa.array(rare, _RARE)], [*part.schema.names[1:], "codes", "rare"])


def encode(texts: DataFrame, lexicon: Broadcast[Lexicon], others: str = "") -> DataFrame:
    """``texts`` (binary column text first, then ``others``) with codes and rare words in place of the text. Written."""
    return write_out(map_batches(texts, lambda b: _encode(b, lexicon.value),
                                 others + "codes array<int>, rare array<struct<word: binary, m: bigint>>"))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of some texts, which bounds the arrays made from one."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _path(codes: pa.ListArray) -> np.ndarray:
    """The codes of all texts in a row, with the boundary before each and behind the last."""
    lengths = codes.value_lengths().to_numpy()
    out = np.full(int(lengths.sum()) + len(lengths) + 1, -1, dtype=np.int64)
    out[1 + np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = codes.flatten().to_numpy()
    return out


def _pairs(batches: Iterator[pa.RecordBatch], elements: np.ndarray) -> Iterator[pa.RecordBatch]:
    def rows(codes: list[np.ndarray]) -> pa.RecordBatch:
        code, n = np.unique(np.concatenate(codes or [np.empty(0, np.int64)]), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(code // ELEMENTS, pa.int32()), pa.array(code % ELEMENTS, pa.int32()),
             pa.array(n.astype(np.int64))], ["a", "b", "n"])

    codes, held = [], 0
    for batch in _slices(batches):
        element = elements[_path(batch.column(0))]
        codes.append(element[:-1] * ELEMENTS + element[1:])
        held += len(element)
        if held > _PAIRED:
            yield rows(codes)
            codes, held = [], 0
    yield rows(codes)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_class(m: np.ndarray, a: int, right: np.ndarray, left: np.ndarray, own: float) -> tuple[
        np.ndarray, int, np.ndarray, np.ndarray]:
    """Where an element of class ``a`` raises the likelihood of the class bigrams ``m`` most.

    right[c] and left[c]: how often class c follows, precedes it; own: how often it follows itself. Returned are the
    bigrams without the element, its class, and right and left without itself.
    """
    n = len(m)
    m = m.copy()
    m[a] -= right
    m[:, a] -= left
    m[a, a] += own
    np.maximum(m, 0, out=m)
    # likelihood if it joined b: beside what is the same for any b, only row b, column b and the totals of b change
    moved_right = right.copy()
    moved_right[a] -= own  # its own follower moves with it
    moved_left = left.copy()
    moved_left[a] -= own
    rows, cols = m.sum(1) + moved_left, m.sum(0) + moved_right
    gain = (_xlogx(m + moved_right) - _xlogx(m)).sum(1) + (_xlogx(m.T + moved_left) - _xlogx(m.T)).sum(1)
    d = m.diagonal()
    i = np.arange(n)
    gain += (_xlogx(d + moved_right + moved_left + own) - _xlogx(d + moved_right[i]) - _xlogx(d + moved_left[i])
             + _xlogx(d))
    gain -= _xlogx(rows + right.sum()) - _xlogx(rows) + _xlogx(cols + left.sum()) - _xlogx(cols)
    gain[0] = -np.inf
    b = int(gain.argmax())
    return m, b if gain[b] > gain[a] + 1e-9 else int(a), moved_right, moved_left


def exchange(after: np.ndarray, before: np.ndarray, own: np.ndarray, classes: np.ndarray, movable: np.ndarray) -> None:
    """One sweep of the exchange algorithm over the elements ``movable``; changes ``classes``.

    after[e, c] and before[e, c]: how often an element of class c follows, precedes e; own[e]: how often e follows e.
    Class 0 is the boundary's and takes no other element.
    """
    n = after.shape[1]
    m = np.zeros((n, n))
    np.add.at(m, classes, after)
    for e in movable.tolist():
        m, b, moved_right, moved_left = best_class(m, classes[e], after[e], before[e], own[e])
        classes[e] = b
        m[b] += moved_right
        m[:, b] += moved_left
        m[b, b] += own[e]


def class_counts(pairs: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """after and before of every element under ``classes``: at most elements times classes rows come back."""
    spark = pairs.sparkSession
    n = int(classes.max()) + 1
    of = spark.createDataFrame(list(enumerate(classes.tolist())), "e int, c int")
    out = []
    for element, other in (("a", "b"), ("b", "a")):
        rows = (pairs.join(F.broadcast(of), pairs[other] == of["e"]).groupBy(F.col(element).alias("e"), "c")
                .agg(F.sum("n").alias("n")).toPandas())
        m = np.zeros((ELEMENTS, n))
        m[rows["e"].to_numpy(np.int64), rows["c"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
        out.append(m)
    return out[0], out[1]


def cluster(pairs: DataFrame, n_classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each element (0: the boundary)."""
    classes = 1 + np.arange(ELEMENTS) % n_classes
    classes[BOUNDARY] = 0
    own = np.zeros(ELEMENTS)
    for row in pairs.where("a = b").collect():  # one row per element at most
        own[row["a"]] = row["n"]
    for r in range(rounds):
        after, before = class_counts(pairs, classes)
        often = np.argsort(-after.sum(1), kind="stable")
        often = often[(after.sum(1)[often] > 0) & (often != BOUNDARY)]
        exchange(after, before, own, classes, often[r % 2::2])
    return classes


def _contexts(batches: Iterator[pa.RecordBatch], class_of: np.ndarray, movable: np.ndarray, n: int) -> Iterator[
        pa.RecordBatch]:
    """Rows word, slot, n. Word -1 has the class bigrams, slot from * n + to; a movable word has in slot c how often class
    c follows it, and in slot n + c how often it precedes it."""
    slots = 2 * n

    def rows(word: np.ndarray, slot: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(word, pa.int32()), pa.array(slot, pa.int32()),
                                           pa.array(count, pa.int64())], ["word", "slot", "n"])

    def met(found: list[np.ndarray]) -> pa.RecordBatch:
        code, count = np.unique(np.concatenate(found or [np.empty(0, np.int64)]), return_counts=True)
        return rows(code // slots, code % slots, count)

    bigrams, found, held = np.zeros(n * n, dtype=np.int64), [], 0
    for batch in _slices(batches):
        path = _path(batch.column(0))
        c = class_of[path]
        bigrams += np.bincount(c[:-1] * n + c[1:], minlength=n * n)
        here = np.flatnonzero(movable[path])
        first = path[here] * slots
        found += [first + c[here + 1], first + n + c[here - 1]]
        held += 2 * len(here)
        if held > _PAIRED:
            yield met(found)
            found, held = [], 0
    yield met(found)
    kept = np.flatnonzero(bigrams)
    yield rows(np.full(len(kept), -1), kept, bigrams[kept])


def _gains(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What one occurrence before class c, or behind class c, adds to the likelihood in class b, [b, c]: the exchange gain
    to first order, by transitions smoothed with the class frequencies."""
    smooth = m + SMOOTH * np.outer(m.sum(1), m.sum(0)) / (max(m.sum(), 1) * len(m)) + 0.1
    step = np.log(smooth / smooth.sum(1, keepdims=True))
    followed, preceded = step, step.T - np.log(smooth.sum(0) / smooth.sum())[:, None]
    return followed, preceded


def _moves(batches: Iterator[pa.RecordBatch], followed: np.ndarray, preceded: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Class of best gain of each word, by the rows of ``_contexts``."""
    n = len(followed)
    for batch in batches:
        words, met = batch.column(0), batch.column(1)
        flat = met.flatten()
        counts = np.zeros((len(words), 2 * n))
        counts[np.repeat(np.arange(len(words)), met.value_lengths().to_numpy()),
               flat.field("slot").to_numpy()] = flat.field("n").to_numpy()
        gain = counts[:, :n] @ followed.T + counts[:, n:] @ preceded.T
        gain[:, 0] = -np.inf  # the boundary's class takes no word
        yield pa.RecordBatch.from_arrays([words, pa.array(gain.argmax(1).astype(np.int32))], ["word", "c"])


def place_words(codes: DataFrame, class_of: np.ndarray, movable: np.ndarray, n_classes: int) -> tuple[
        np.ndarray, np.ndarray]:
    """Class of each code once the words ``movable`` went where they raise the likelihood most, and the class bigrams
    before that."""
    n = n_classes + 1
    spark = codes.sparkSession
    shared = spark.sparkContext.broadcast((class_of, movable))
    met = (map_batches(codes, lambda b: _contexts(b, *shared.value, n), "word int, slot int, n long")
           .groupBy("word", "slot").agg(F.sum("n").alias("n")))
    met = cut(met)
    m = np.zeros(n * n)
    for row in met.where("word = -1").collect():  # n * n rows at most
        m[row["slot"]] = row["n"]
    m = m.reshape(n, n)
    class_of = class_of.copy()
    if movable.any():
        of_word = met.where("word >= 0").groupBy("word").agg(F.collect_list(F.struct("slot", "n")).alias("met"))
        followed, preceded = _gains(m)
        # a row per frequent word comes back
        moves = map_batches(of_word, lambda b: _moves(b, followed, preceded), "word int, c int").toPandas()
        class_of[moves["word"].to_numpy(np.int64)] = moves["c"].to_numpy(np.int64)
    return class_of, m


@dataclass
class Counted:
    """Word counts of the training texts."""
    vocabulary: DataFrame  # word, n of all training words
    lexicon: Lexicon
    n_words: int
    n_types: int
    n_texts: int


def count_words(texts: DataFrame, cached: int = CACHED) -> Counted:
    """Counts over the binary column ``text`` of ``texts``."""
    n_texts = texts.count()
    counted = map_batches(texts, _count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = write_out(counted)
    steps = range(45)
    short = F.octet_length("word") <= WORD_BYTES
    sums = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                          *[F.sum((short & (F.col("n") >= 1 << k)).cast("long")).alias(f"k{k}") for k in steps]).first()
    least = min((1 << k for k in steps if (sums[f"k{k}"] or 0) <= cached))
    frequent = sorted(((-r["n"], bytes(r["word"])) for r in vocabulary.where(short & (F.col("n") >= least)).collect()))
    lexicon = Lexicon([w for _, w in frequent], np.array([-n for n, _ in frequent], dtype=np.float64))
    return Counted(vocabulary, lexicon, sums["n"] or 0, sums["v"], n_texts)


@dataclass
class ClassModel:
    lexicon: Broadcast[Lexicon]
    classes: np.ndarray  # of codes, at the end of the boundary
    step: np.ndarray  # log10 P(class | class), [from, to]
    spread: np.ndarray  # log10 of the emission's denominator per class
    vocabulary: DataFrame | None  # word, n of all training words
    n_tokens: int
    n_types: int
    n_texts: int


def fit(codes: DataFrame, counted: Counted, lexicon: Broadcast[Lexicon], n_classes: int = CLASSES, rounds: int = ROUNDS,
        word_count: int = WORD_COUNT) -> ClassModel:
    """Model of the training texts whose codes are the one column of ``codes``."""
    words, counts = counted.lexicon.words, counted.lexicon.counts
    elements = counted.lexicon.elements()
    shared = codes.sparkSession.sparkContext.broadcast(elements)
    pairs = cut(map_batches(codes, lambda b: _pairs(b, shared.value), "a int, b int, n long")
                .groupBy("a", "b").agg(F.sum("n").alias("n")))
    of_element = cluster(pairs, n_classes, rounds)
    classes = of_element[elements]
    own_class = np.zeros(len(classes), dtype=bool)
    own_class[CLUSTERED:len(words)] = counts[CLUSTERED:] >= word_count
    for _ in range(WORD_ROUNDS if own_class.any() else 0):
        classes, _ = place_words(codes, classes, own_class, n_classes)
    _, m = place_words(codes, classes, np.zeros(len(classes), dtype=bool), n_classes)

    # words per class: the frequent ones by themselves, all others by unit
    left = np.zeros(UNITS)
    by_unit = counted.vocabulary.groupBy(F.crc32(F.substring("word", -3, 3)).bitwiseAND(F.lit(UNITS - 1)).alias("u"))
    for row in by_unit.agg(F.count(F.lit(1)).alias("v")).collect():  # one row per unit
        left[row["u"]] = row["v"]
    np.subtract.at(left, np.array([unit(w) for w in words], dtype=np.int64), 1)
    types = (np.bincount(classes[:len(words)], minlength=n_classes + 1)
             + np.bincount(of_element[CLUSTERED:BOUNDARY], weights=left, minlength=n_classes + 1))
    of_class = m.sum(0)
    frequency = (of_class + 0.5) / (of_class.sum() + 0.5 * (n_classes + 1))
    step = np.log10((m + BACKOFF * frequency) / (m.sum(1, keepdims=True) + BACKOFF))
    spread = np.log10(of_class + 0.5 * (types + 1))
    return ClassModel(lexicon, classes, step, spread, counted.vocabulary, counted.n_words + counted.n_texts,
                      counted.n_types + (counted.n_texts > 0), counted.n_texts)


def train(texts: DataFrame, n_classes: int = CLASSES, rounds: int = ROUNDS, cached: int = CACHED,
          word_count: int = WORD_COUNT) -> ClassModel:
    """Model of the binary column ``text`` of ``texts``."""
    counted = count_words(texts, cached)
    lexicon = texts.sparkSession.sparkContext.broadcast(counted.lexicon)
    return fit(encode(texts.select("text"), lexicon).select("codes"), counted, lexicon, n_classes, rounds, word_count)


def _sums(batches: Iterator[pa.RecordBatch], counts: np.ndarray, classes: np.ndarray, step: np.ndarray,
          spread: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a text's score needs but the counts of its rare words."""
    log_count = np.zeros(len(classes))
    log_count[:len(counts)] = np.log10(counts + 0.5)
    spread = spread.copy()
    spread[0] = 0.0  # the end is what its class stands for
    for batch in _slices(batches):
        lengths = batch.column(0).value_lengths().to_numpy()
        path = _path(batch.column(0))
        c, token = classes[path], path[1:]
        text = np.repeat(np.arange(len(lengths)), lengths + 1)  # of each token, the ends among them

        def per_text(x: np.ndarray) -> np.ndarray:
            return np.bincount(text, weights=x, minlength=len(lengths))

        frequent = (token >= 0) & (token < len(counts))
        columns = [pa.array((lengths + 1).astype(np.int64)), pa.array(per_text(frequent).astype(np.int64)),
                   pa.array(per_text(log_count[token])), pa.array(per_text(step[c[:-1], c[1:]] - spread[c[1:]]))]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns],
                                         [*batch.schema.names[1:], "n_tokens", "n_frequent", "counts", "rest"])


def _rows(docs: DataFrame, lexicon: Broadcast[Lexicon]) -> DataFrame:
    """Encoded ``docs``; row numbers them, and stays as it is since the rows are written."""
    return encode(docs.select("text", "doc_id", "held_out", F.monotonically_increasing_id().alias("row")), lexicon,
                  "doc_id long, held_out boolean, row long, ")


def score(docs: DataFrame, model: ClassModel) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of ``docs``.

    ``docs``: doc_id, held_out and the binary column text.
    """
    return _scored(_rows(docs, model.lexicon), model)


def train_and_score(docs: DataFrame) -> DataFrame:
    """``score`` of ``docs`` by the model of those that are not held out, with one encoding of the texts."""
    counted = count_words(docs.where("not held_out").select("text"))
    lexicon = docs.sparkSession.sparkContext.broadcast(counted.lexicon)
    rows = _rows(docs, lexicon)
    return _scored(rows, fit(rows.where("not held_out").select("codes"), counted, lexicon))


def _scored(rows: DataFrame, model: ClassModel) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((model.lexicon.value.counts, model.classes, model.step, model.spread))
    heads = map_batches(rows.select("codes", "doc_id", "held_out", "row"), lambda b: _sums(b, *shared.value),
                        "doc_id long, held_out boolean, row long, n_tokens long, n_frequent long, counts double, rest double")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.m")
    met = rare.join(model.vocabulary, "word", "left")
    of_row = met.groupBy("row").agg(
        F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_counts"),
        F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("n_rare_known"))
    found = heads.join(of_row, "row", "left")
    counts = F.col("counts") + F.coalesce("rare_counts", F.lit(0.0))
    end = F.lit(float(np.log10(model.n_texts + 0.5)))
    per_token = F.lit(float(np.log10(model.n_tokens + 0.5 * (model.n_types + 1))))
    total = counts + F.col("rest")
    return found.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_frequent") + F.coalesce("n_rare_known", F.lit(0)) + F.lit(int(model.n_texts > 0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (counts + end - F.col("n_tokens") * per_token).alias("base_score"), total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"))
