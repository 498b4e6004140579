"""Operator 2: mixing sources to target weights.

Sizes are summed per source; each source's target is its weight's share of the budget, at most ``max_repeat`` times its
size, and what the limit leaves over is shared again by weight among the others. The repetition rate is target over
size. A document is emitted floor(rate) times, plus once more if a hash of its id and the seed, a uniform number,
is below the fraction. The draw depends on the id alone, so reruns and other partitionings agree.

Defined results: null text has size 0; null is a source of its own, after all others; a source of size 0 has target 0
and its documents are not taken; rows repeated with one doc_id share their draw; a null doc_id draws as the text
"null"; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import add_row_number
from .common import cut, fresh, hint_broadcast

WEIGHTS, SHARE, MAX_REPEAT = (3, 1, 2), (3, 2), 2  # the budget is 3/2 of all sizes


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":" + seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target, rate of the rows (source, size) of ``sizes``, one row per source.

    Sources take ``weights`` in turn, by code point with null last. Written to the checkpoint folder.
    """
    # written, as the numbering reads its input several times
    per_source = cut(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    numbered = add_row_number(per_source, [F.col("source").isNull().asc(), F.col("source").asc()], "n")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), ((F.col("n") - 1) % len(weights)).cast("int"))
    state = cut(numbered.select("source", "source_size", weight.cast("long").alias("weight")))
    exact = "decimal(38,0)"
    total = state.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = None  # target of an unlimited source: weight * level, as the fraction over / under
    n_limited = -1
    while True:
        limited = F.lit(False) if level is None else (
            F.col("weight").cast(exact) * level[0] > F.col("source_size").cast(exact) * (max_repeat * level[1]))
        sums = state.agg(F.sum(limited.cast("long")).alias("n"),
                         F.coalesce(F.sum(F.when(limited, F.col("source_size"))), F.lit(0)).alias("size"),
                         F.coalesce(F.sum(F.when(~limited, F.col("weight"))), F.lit(0)).alias("weight")).first()
        if (sums["n"] or 0) == n_limited:
            break
        n_limited = sums["n"] or 0
        level = (share[0] * total - share[1] * max_repeat * sums["size"], max(1, share[1] * sums["weight"]))
    free = (F.col("weight") * F.lit(level[0])).cast("double") / F.lit(float(level[1]))
    target = F.when(limited, (F.col("source_size") * max_repeat).cast("double")).otherwise(free)
    return cut(state.withColumn("target", target).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate")))


def mixed(docs: DataFrame, targets: DataFrame, seed: str = "mix") -> DataFrame:
    """``docs`` (doc_id, source, others) with source_size, target and copies, the times that the mix holds each row.

    Source tables above a broadcast's bound are joined by shuffle, where AQE splits a source with much of the rows.
    """
    s, r = fresh(docs.columns, "mix_source", "mix_rate")
    side = targets.select(F.col("source").alias(s), "source_size", "target", F.col("rate").alias(r))
    side = hint_broadcast(side, targets.count(), 120)
    whole = F.floor(F.col(r))
    copies = whole + (uniform(F.col("doc_id"), seed) < F.col(r) - whole).cast("long")
    return (docs.join(side, docs["source"].eqNullSafe(side[s]))
            .withColumn("copies", copies).drop(s, r))


def emit_mix(docs: DataFrame, size: Column, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE,
             max_repeat: int = MAX_REPEAT, seed: str = "mix") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns."""
    targets = source_targets(docs.select("source", size.alias("size")), weights, share, max_repeat)
    clash = [c for c in docs.columns if c.lower() in ("source_size", "target", "copies")]
    aside = dict(zip(clash, fresh([*docs.columns, "source_size", "target", "copies"], *clash)))
    times, = fresh([*docs.columns, *aside.values(), "source_size", "target", "copies"], "mix_time")
    taken = mixed(docs.withColumnsRenamed(aside), targets, seed).where("copies > 0")
    out = taken.withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    back = [F.col(aside.get(c, c)).alias(c) for c in docs.columns]
    return out.select(*back)
