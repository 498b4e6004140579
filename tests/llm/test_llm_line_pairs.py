"""Operator 3 against the alignment of every pair of documents."""

import random

import pytest

from tests.llm import brute
from wrenchcast.llm import line_dedup
from wrenchcast.llm.line_dedup import dedup_lines, shortest_runs

SF = "/root/testdata/sf0.001"


def check(spark, docs, min_words=3):
    expected = brute.dedup_lines(docs, min_words)
    got = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
                                            min_words).collect()}
    for i in docs:
        assert (got[i].text, got[i].n_deleted) == expected[i], i
    return {i: n for i, (_, n) in expected.items()}


def test_documents_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").collect()
    check(spark, {r.doc_id: r.text for r in rows})


def test_a_block_shared_by_two_later_documents(spark):
    """The earlier holder of the lines has them apart or in another order."""
    docs = {1: "d\nb\nc\nother words here\na", 2: "x1 x1\na\nb\nc\nd", 3: "a\nb\nc\nd\ny1 y1"}
    assert check(spark, docs)[3] == 4


@pytest.mark.parametrize("further", [8, 1])
@pytest.mark.parametrize("min_words", [3, 1, 5])
def test_shuffled_lines(spark, monkeypatch, further, min_words):
    monkeypatch.setattr(line_dedup, "_FURTHER", further)
    monkeypatch.setattr(line_dedup, "_MORE", 2)
    rng = random.Random(min_words)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.choice([1, 1, 2, 3, 5]))) for _ in range(25)]
    docs = {i: "\n".join(rng.choices(pool, k=rng.randint(1, 14))) for i in range(150)}
    check(spark, docs, min_words)


def test_two_orders_of_two_lines(spark):
    docs = {i: "the first line\nthe second line" if i < 60 else "the second line\nthe first line" for i in range(80)}
    expected = check(spark, docs)
    assert expected[60] == 1 and all(expected[i] == 2 for i in range(61, 80))


@pytest.mark.parametrize("further", [1, 8, 700])
def test_nearest_holders_of_a_hot_run(spark, further):
    """A run with 2,000 holders, some given twice, beside a run of few."""
    held = {b"hot": [7 * i % 2003 for i in range(2000)], b"few": [5, 3, 9], b"one": [4]}
    rows = [(k, i) for k, ids in held.items() for i in [*ids, *ids[:5]]]
    got = line_dedup._nearest(spark.createDataFrame(rows, "key binary, next_id long"), further).collect()
    assert sorted((bytes(r.key), r.n, r.next_id) for r in got) == sorted(
        (k, n, i) for k, ids in held.items() for n, i in enumerate(sorted(ids)[:further], 1))


def test_shortest_runs_are_all_there():
    rng = random.Random(9)
    for _ in range(300):
        ordinals, at = [], 0
        for _ in range(rng.randint(0, 12)):
            at += rng.choice([1, 1, 1, 2])
            ordinals.append(at)
        words, least = [rng.randint(1, 4) for _ in ordinals], rng.randint(1, 6)
        expected = set()
        for i in range(len(words)):
            runs = [(a, b) for a in range(i + 1) for b in range(i, len(words))
                    if ordinals[b] - ordinals[a] == b - a and sum(words[a:b + 1]) >= least]
            expected |= {(a, b) for a, b in runs if not any(c >= a and d <= b and (c, d) != (a, b) for c, d in runs)}
        assert shortest_runs(ordinals, words, least) == expected
