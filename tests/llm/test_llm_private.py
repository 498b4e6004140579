"""Operator 12: strict patterns against plain regular expressions, rounds against plain dictionaries."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wrenchcast.llm import private_data, queries
from wrenchcast.llm.private_data import KINDS, base_spans, candidates, find_private, lexical_patterns, luhn, marks

DOCS = "doc_id long, text string"
# The contract's patterns, word for word.
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2:
                doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in doubled) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_strict_patterns(seed):
    rng = random.Random(seed)
    pieces = ["a", "B.", "@", "@x.y", "a@b.c.", ".", "1", "25", "255", "256", "000", "4111111111111111", "+1", " ", "-", "(",
              ")", "+", "é", "\n", "1.2.3.4", "%", "555", "a@b", "@@", "5500-0000 0000-0004"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 25)))
        assert base_spans(text) == plain_base(text), text


def test_strict_patterns_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text is not null").select("text").collect()
    found = 0
    for r in rows:
        if re.search("[0-9@]", r.text):
            expected = plain_base(r.text)
            found += len(expected)
            assert base_spans(r.text) == expected
            assert [(m["kind"], m["start"], m["end"]) for m in marks(r.text) if m["kind"] >= 0] == expected
    assert found > 500


def test_long_texts_take_linear_time():
    for piece in ("1", "a", "1.", "+1", "(", "1 ", "a@", "@", " at ", "1-", "+1 (((", "a at a dot "):
        marks(piece * 200_000)


def test_candidates():
    text = "call (555) 123-4567 or 4111 1111 1111 1112, joe at mail dot example dot org, 10-20-30-40, x12345678, 12"
    found = [(shape, text[s:e]) for shape, s, e in candidates(text, [])]
    assert found == [(8, "(555) 123-4567"), (4, "4111 1111 1111 1112"), (1, "joe at mail dot example dot org"),
                     (2 | 8, "10-20-30-40")]
    assert [text[s:e] for _, s, e in candidates(text, [(5, 19)])] == [text[s:e] for _, s, e in candidates(text, [])][1:]
    assert lexical_patterns("Call Me7:12", 9, 11) == ["me0:~ _", "call me0:~ _", "me0:~ _ $"]
    assert lexical_patterns("12, x", 0, 2) == ["^ _", "^ ^ _", "^ _ ~,"]


def plain_rounds(texts):
    """Spans of each text, by dictionaries over all occurrences."""
    found = [marks(t) for t in texts]
    kind, shape, edges = {}, defaultdict(int), set()
    for m in (m for ms in found for m in ms):
        kind[m["instance"]] = max(kind.get(m["instance"], -1), m["kind"])
        shape[m["instance"]] |= m["shape"]
        edges |= {(p, m["instance"]) for p in m["patterns"]}
    by_pattern = defaultdict(set)
    for p, x in edges:
        by_pattern[p].add(x)
    for _ in range(private_data.ROUNDS):
        doubt = defaultdict(float)
        for instances in by_pattern.values():
            known = [kind[x] for x in instances if kind[x] >= 0]
            for k in range(4):
                unknown = [x for x in instances if kind[x] < 0 and shape[x] >> k & 1]
                confidence = known.count(k) / (len(known) + 0.2 * len(unknown) + 2)
                if confidence >= 0.8 - 1e-12:
                    for x in unknown:
                        doubt[x, k] += math.log(1 - confidence)
        learned = {}
        for (x, k), v in sorted(doubt.items(), key=lambda i: (round(i[1], 5), i[0][1])):
            if math.exp(v) <= 0.1 + 1e-7:
                learned.setdefault(x, k)
        if not learned:
            break
        kind |= learned
    out = []
    for ms in found:
        spans = [(m["kind"], m["start"], m["end"]) for m in ms if m["kind"] >= 0]
        out.append((spans, sorted(spans + [(kind[m["instance"]], m["start"], m["end"]) for m in ms if m["kind"] < 0
                                           and kind[m["instance"]] >= 0 and shape[m["instance"]] >> kind[m["instance"]] & 1
                                           and m["shape"] >> kind[m["instance"]] & 1])))
    return out


def with_check_digit(digits):
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def planted():
    rng = random.Random(12)
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    rows = [None, "", "no identifiers here", "12 and 7"]
    rows += [f"please ring me on +1 {number(3)} {number(7)} today" for _ in range(40)]
    rows += [f"please ring me on {number(3)}-{number(4)} today" for _ in range(5)]  # learned in the first round
    local = [f"{number(3)}-{number(5)}" for _ in range(12)]
    rows += [f"please ring me on {x} today" for x in local]
    rows += [f"meine nummer: {x} danke" for x in local]  # known then, so their context teaches a second round
    rows += [f"meine nummer: {number(4)}/{number(5)} danke" for _ in range(2)]
    rows += [f"order number {number(9)} shipped" for _ in range(20)]  # never beside a seed
    rows += [f"card ending {with_check_digit(number(15))} and {with_check_digit(number(12))}" for _ in range(30)]
    rows += [f"card ending {number(16)} and nothing" for _ in range(6)]
    rows += [f"mail me at j{number(3)}@mail.example.org now" for _ in range(25)]
    rows += [f"mail me at ann{number(2)} at mail dot example dot org now" for _ in range(3)]
    rows += ["host 10.1.2.3 up", "host 10-1-2-3 up", "ratio 10:1:2:3"]  # one seed in three dresses
    return rows + rows[10:40]


def test_rounds_match_plain_dictionaries(spark):
    texts = planted()
    got = find_private(spark.createDataFrame(list(enumerate(texts)), DOCS)).orderBy("doc_id").collect()
    expected = plain_rounds(texts)
    assert [([tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in got] == expected
    extra = lambda words: [len(r.spans) - len(r.base) for r, t in zip(got, texts) if t and words in t]
    assert set(extra("meine nummer:")) == {1} and set(extra("order number")) == {0}
    assert extra("host 10-1-2-3") == [1] and extra("ratio 10:1") == [1]
    assert sum(extra("please ring me on")) == 17 and sum(extra(" at mail dot ")) == 3


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op12_private_data"](spark, sf)
    assert got.columns == ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_learned"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 5 + ["string"] * 2 + ["bigint"]
    rows = got.collect()
    assert len(rows) == len(source)
    say = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)
    rounds = dict(zip(source, plain_rounds(list(source.values()))))
    for r in rows:
        base, spans = plain_base(source[r.doc_id] or ""), rounds[r.doc_id][1]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(say(base).encode()).hexdigest()
        assert (r.spans, r.n_learned) == (say(spans), len(spans) - len(base))


def test_null_ids_repeats_and_clashing_columns(spark):
    rows = [(None, "+1 234 567 8901", 1), (None, "+1 234 567 8901", 2), (5, "a@b.cd", None), (5, None, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row long").withColumn("marks", F.lit(1))
    got = sorted((str(r.doc_id), len(r.base), len(r.spans)) for r in find_private(frame).collect())
    assert got == [("5", 0, 0), ("5", 1, 1), ("None", 1, 1), ("None", 1, 1)]
    assert find_private(frame.where("false")).count() == 0
    assert find_private(spark.createDataFrame([(None, None)], DOCS)).collect()[0].spans == []
