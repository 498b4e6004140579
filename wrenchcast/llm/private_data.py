"""Operator 12: personal data by bootstrapped contextual extraction.

Strict patterns find the seed entities (base spans) of four kinds. The same scan marks candidates: identifier-shaped
stretches that no strict pattern takes, such as numbers without a country code, failing check digits, or addresses
written with "at" and "dot". Seeds and candidates are instances; the words around each occurrence give three lexical
patterns: the word to the left, the two words to the left, and the words to the left and right.

Spark then scores the graph of patterns and instances in rounds. A pattern's confidence for a kind counts its distinct
instances: known ones of the kind, against known ones of other kinds, ``PRIOR`` more, and a part of the unknown ones of
fitting shape. Patterns from ``CONFIDENT`` up propose the kind for their unknown instances; one whose patterns together
(1 - product of 1 - confidence) reach ``ACCEPT`` becomes known and counts as a seed of the next round. Rounds end when
nothing new is known, or after ``ROUNDS``. Candidates whose instance is known, be it learned or a seed in another dress
(same digits, other separators), are added to the spans.

Counting is by distinct instances, so copies of a document add no confidence. Edges are distinct (pattern, instance)
pairs, linear in the identifiers of the corpus; pattern counts are partial aggregates, strong patterns and known
instances are joined by broadcast only if their counted rows are few. No list of patterns or instances is collected.

Defined results: a null text is empty; texts of any length are scanned whole, in time linear in their length; rows
repeated and null ids are rows of their own; other columns are not read; an empty table gives an empty table. Candidates
never overlap base spans or each other. Ties between kinds go to the one listed first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hint_broadcast, map_batches, write_out

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
PRIOR, CONFIDENT, ACCEPT, ROUNDS = 2, 0.8, 0.9, 5
CONTEXT_CHARS = 64  # how far a context word is read

# The local part of an address is read backwards from its "@", so that a text without one is not searched.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]| (?:at|AT) |[\[({<] ?(?:at|AT) ?[\])}>]")
_AT = re.compile(r" ?[\[({<] ?(?:@|at|AT) ?[\])}>] ?| (?:@|at|AT) |@")
_LOOSE_DOMAIN = re.compile(
    r"[A-Za-z0-9-]++(?:(?: ?[\[({<] ?(?:\.|dot|DOT) ?[\])}>] ?| (?:\.|dot|DOT) |\.)[A-Za-z0-9-]++)+")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[(+]?[0-9]++(?:[\x20().:/_-]{1,2}[0-9]++)*+(?![A-Za-z])")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

MARK = pa.struct([("kind", pa.int32()), ("shape", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                  ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])
MARK_DDL = "struct<kind: int, shape: int, start: bigint, end: bigint, instance: string, patterns: array<string>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _local_start(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in _LOCAL_CHARS:
        at -= 1
    return at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, by kind, then start; leftmost and non-overlapping per kind."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        start = _local_start(text, at, done)
        if found and start < at:
            done = found.end()
            out.append((EMAIL, start, done))
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((IP, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((CARD, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((PHONE, *m.span()))
    return out


def number_shape(text: str) -> int:
    """Bit set of the kinds that the number may be."""
    groups, gaps = re.findall("[0-9]+", text), set(re.findall("[^0-9]+", text))
    n = sum(map(len, groups))
    shape = 0
    if len(groups) == 4 and len(gaps) == 1 and gaps <= {".", ":", "-", "_"} and max(map(len, groups)) <= 3:
        shape |= 1 << IP
    if 12 <= n <= 19 and gaps <= {" ", "-", "."}:
        shape |= 1 << CARD
    if 7 <= n <= 15:
        shape |= 1 << PHONE
    return shape


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(shape, start, end) of identifier-shaped stretches outside ``taken`` spans."""
    out: list[tuple[int, int, int]] = []
    for low, high in _gaps(len(text), taken):
        done = low
        for m in _AT.finditer(text, low, high):
            found = _LOOSE_DOMAIN.match(text, m.end(), high)
            start = _local_start(text, m.start(), done)
            if m.start() >= done and found and start < m.start():
                done = found.end()
                out.append((1 << EMAIL, start, done))
    for low, high in _gaps(len(text), taken + [(s, e) for _, s, e in out]):
        for m in _NUMBER.finditer(text, low, high):
            shape = number_shape(m[0])
            if shape:
                out.append((shape, *m.span()))
    return sorted(out, key=lambda c: c[1])


def _gaps(n: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    done = 0
    for start, end in sorted(taken):
        if start > done:
            yield done, start
        done = max(done, end)
    if done < n:
        yield done, n


def instance(text: str, email: bool) -> str:
    """What counts as the same identifier: lower-cased addresses, dotted quads, else the digits."""
    if email:
        return "e:" + text.lower()
    groups = re.findall("[0-9]+", text)
    if number_shape(text) >> IP & 1:
        return "i:" + ".".join(groups)
    return "n:" + "".join(groups)


def lexical_patterns(text: str, start: int, end: int) -> list[str]:
    """The patterns of an occurrence; "^" and "$" stand where the text ends, "~" marks a word glued to it."""
    squeeze = lambda w: re.sub("[0-9]+", "0", w.lower())
    before, after = text[max(0, start - CONTEXT_CHARS):start], text[end:end + CONTEXT_CHARS]
    left = [squeeze(w) for w in before.split()[-2:]]
    if left and not before[-1].isspace():
        left[-1] += "~"
    left = ["^"] * (2 - len(left)) + left
    right = "".join(map(squeeze, after.split()[:1])) or "$"
    if after and not after[0].isspace():
        right = "~" + right
    return [f"{left[1]} _", f"{left[0]} {left[1]} _", f"{left[1]} _ {right}"]


def marks(text: str | None) -> list[dict]:
    """Base spans (kind from 0 up) and candidates (kind -1) of a text."""
    if not text or not _HINT.search(text):
        return []
    base = base_spans(text)
    loose = candidates(text, [(s, e) for _, s, e in base])
    found = [(k, 0, s, e, instance(text[s:e], k == EMAIL)) for k, s, e in base]
    found += [(-1, shape, s, e, instance(text[s:e], shape == 1 << EMAIL)) for shape, s, e in loose]
    return [{"kind": k, "shape": shape, "start": s, "end": e, "instance": x, "patterns": lexical_patterns(text, s, e)}
            for k, shape, s, e, x in found]


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [marks(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(MARK))],
                                         ["row", "id", "marks"])


def _fits(kind: Column, shape: Column) -> Column:
    return shape.bitwiseAND(F.call_function("shiftleft", F.lit(1), kind)) != 0


def strong_patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """pattern, kind, confidence of the patterns that may teach an unknown instance; ``known``: instance, kind, shape."""
    of = lambda k: F.sum((F.col("kind") == k).cast("long"))
    unknown = lambda k: F.sum(((F.col("kind") < 0) & _fits(F.lit(k), F.col("shape"))).cast("long"))
    counted = edges.join(known, "instance").groupBy("pattern").agg(
        F.sum((F.col("kind") >= 0).cast("long")).alias("all"), *[of(k).alias(f"k{k}") for k in range(4)],
        *[unknown(k).alias(f"u{k}") for k in range(4)])
    scored = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"u{k}").alias("unknown"),
                                (10 * F.col(f"k{k}") / (10 * F.col("all") + 2 * F.col(f"u{k}") + 10 * PRIOR))
                                .alias("confidence")) for k in range(4)])
    return (counted.select("pattern", F.inline(scored))
            .where(f"confidence >= {CONFIDENT} and unknown > 0").select("pattern", "kind", "confidence"))


def learn(edges: DataFrame, known: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``known`` (instance, kind or -1, shape) after the rounds; ``edges``: distinct pattern, instance."""
    for _ in range(rounds):
        strong = write_out(strong_patterns(edges, known))
        n = strong.count()
        if not n:
            break
        asked = known.where("kind < 0").select("instance", "shape")
        belief = (edges.join(hint_broadcast(strong, n, 400), "pattern").join(asked, "instance")
                  .where(_fits(F.col("kind"), F.col("shape"))).groupBy("instance", "kind")
                  # whole millionths, so that the order of addition does not matter
                  .agg(F.sum(F.round(-1e6 * F.log1p(-F.col("confidence"))).cast("long")).alias("weight")))
        enough = F.exp(-F.col("weight") / 1e6) <= 1 - ACCEPT + 1e-9
        new = (belief.where(enough).groupBy("instance")
               .agg(F.max(F.struct("weight", (-F.col("kind")).alias("first"))).alias("best"))
               .select("instance", (-F.col("best.first")).alias("learned")))
        new = write_out(new)
        n = new.count()
        if not n:
            break
        known = write_out(known.join(hint_broadcast(new, n, 200), "instance", "left")
                          .select("instance", F.coalesce("learned", "kind").alias("kind"), "shape"))
    return known


def find_private(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, ``base`` and ``spans``: arrays of (kind, start, end), kind as its place in ``KINDS``, start and end in
    code points, end exclusive; both by kind, then start. ``spans`` holds the base ones too."""
    kind = docs.schema[row_id].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{row_id}`").alias("id"),
                           F.col(f"`{text}`").cast("string").alias("text"))
    found = write_out(map_batches(numbered, _mark, f"row long, id {kind}, marks array<{MARK_DDL}>"))
    each = found.where(F.size("marks") > 0).select("row", F.inline("marks"))
    edges = write_out(each.select(F.explode("patterns").alias("pattern"), "instance").distinct())
    known = write_out(each.groupBy("instance").agg(F.max("kind").alias("kind"), F.bit_or("shape").alias("shape")))
    names = learn(edges, known).where("kind >= 0 and shape <> 0").select("instance", F.col("kind").alias("named"))
    names = write_out(names)
    learned = (each.where("kind < 0").join(hint_broadcast(names, names.count(), 200), "instance")
               .where(_fits(F.col("named"), F.col("shape"))).groupBy("row")
               .agg(F.collect_list(F.struct(F.col("named").alias("kind"), "start", "end")).alias("more")))
    span = lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    base = F.transform(F.filter("marks", lambda m: m["kind"] >= 0), span)
    none = F.array().cast("array<struct<kind: int, start: bigint, end: bigint>>")
    return (found.select("row", "id", base.alias("base")).join(learned, "row", "left")
            .select(F.col("id").alias(row_id), "base",
                    F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans")))


def as_text(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
