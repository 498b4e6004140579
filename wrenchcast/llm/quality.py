"""Operator 8: quality rules as robust multivariate outliers.

Each document gives a vector of transformed statistics. Per language and source the minimum covariance determinant
estimate is fitted by concentration steps: from a start, keep the share ``ALPHA`` of rows with the least Mahalanobis
distance, take their mean and covariance, and repeat. Two starts are run (median with absolute deviations, and the
classical moments) and the one with the smaller determinant is taken. A document beyond ``CUTOFF`` is rejected.

One pass over the statistics per step: rows are counted and summed per group and distance bin, which is a partial
aggregate, so a group with a third of all rows ships a row per bin and task; the bins below the quantile are then added
up. The statistics are whole thousandths and their sums are exact, so results depend on no order of rows. Groups with
fewer than ``MIN_GROUP`` rows take the estimate of their language, or else of all rows.

Defined results: null text has no words and fails the base rule; null language and null source are values of their own;
base failures are no rows of the estimate; if no group has enough rows, the base rule alone decides; repeated rows count
each; other columns are kept by ``keep_good`` and not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_BREAK, cut, fresh, hint_broadcast

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ALPHA, STEPS, MIN_GROUP = 0.75, 6, 50
#: Chi-square with four degrees of freedom at the tail 2.9e-12: of 10**10 clean documents, were their statistics normal,
#: 0.03 would be rejected.
CUTOFF = 60.0
#: Consistency factor of the covariance of the inner 75 % of four-dimensional normal rows.
CONSISTENCY = 1.485
#: Floors of the standard deviations, in thousandths, for statistics that most texts share to the letter. Repeated words
#: alone reach sqrt(2) / 0.15, squared 89, at the base rule's limit, and the cutoff at 34 % in a group that has none.
FLOORS = (150, 250, 150, 150)
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
DIM = 4
X = [f"x{i}" for i in range(DIM)]


def with_statistics(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` (text, others) with the five statistics under ``names``.

    The three-word windows of a text are sorted as 64-bit numbers, their hash above their position, so equal windows
    become neighbours; neighbours are compared by their words, and the positions left cover the repeated words.
    """
    words, lines, bits, windows, hits = fresh([*docs.columns, *names], "w_words", "w_lines", "w_bits", "w_win", "w_hits")
    text = F.coalesce(F.col("text"), F.lit(""))
    runs = F.split(text, WORD_BREAK)
    n, w, b, p, r = (F.col(c) for c in (names[0], words, bits, windows, hits))
    shift = lambda value, by: F.call_function("shiftleft", value, by)
    mask = shift(F.lit(1).cast("long"), b) - F.lit(1)
    at = lambda x: x.bitwiseAND(mask).cast("int")
    head = lambda x: F.call_function("shiftrightunsigned", x, b)
    word = lambda i: F.get(w, i)

    def same(x: Column, y: Column) -> Column:
        equal = [word(at(x) + k) == word(at(y) + k) for k in range(3)]
        return F.coalesce((head(x) == head(y)) & equal[0] & equal[1] & equal[2], F.lit(False))

    out = docs.withColumn(words, F.slice(runs, F.when(F.get(runs, F.lit(0)) == "", 2).otherwise(1), F.size(runs)))
    out = out.withColumn(words, F.when(F.get(w, F.size(w) - 1) == "", F.slice(w, 1, F.size(w) - 1)).otherwise(w))
    out = out.withColumns({
        names[0]: F.size(w).cast("long"),
        names[1]: F.length(F.regexp_replace(text, WORD_BREAK, "")).cast("long"),
        names[2]: F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
        lines: F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
        bits: F.greatest(F.ceil(F.log2((F.size(w) + 1).cast("double"))).cast("int"), F.lit(1)),
    })
    hashed = F.transform(F.sequence(F.lit(0), F.greatest(n.cast("int") - 3, F.lit(0))), lambda i: shift(
        F.xxhash64(word(i), word(i + 1), word(i + 2)), b).bitwiseOR(i.cast("long")))
    out = out.withColumns({
        windows: F.when(n > 3, F.sort_array(hashed)).otherwise(F.array().cast("array<bigint>")),
        names[3]: (F.size(F.col(lines)) - F.size(F.array_distinct(F.col(lines)))).cast("long"),
    })
    repeated = F.filter(p, lambda x, j: F.when(j > 0, same(x, F.get(p, j - 1))).otherwise(False)
                        | same(x, F.coalesce(F.get(p, j + 1), F.lit(-1).cast("long").bitwiseXOR(x))))
    out = out.withColumn(hits, F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(mask))))
    covered = F.transform(r, lambda x, j: F.when(j == 0, F.lit(3).cast("long"))
                          .otherwise(F.least(F.lit(3).cast("long"), x - F.get(r, j - 1))))
    out = out.withColumn(names[4], F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x))
    return out.select(*docs.columns, *names)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def vector(names: list[str]) -> list[Column]:
    """Transformed statistics in whole thousandths: word length, symbols, repeated lines, repeated words."""
    n, chars, symbols, dup, repeat = (F.col(c).cast("double") for c in names)
    n = F.nullif(n, F.lit(0.0))
    parts = [chars / n, F.log1p(20 * symbols / n), F.log1p(dup) / 2, F.sqrt(repeat / n) * 2]
    return [F.coalesce(F.round(1000 * F.least(x, F.lit(100.0))), F.lit(0)).cast("long") for x in parts]


def group_key(level: int, lang: Column, source: Column) -> Column:
    """Level 0: language and source; 1: language; 2: everything. Nulls differ from every text."""
    part = lambda c: F.when(c.isNull(), "-").otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), c))
    parts = [part(lang.cast("string")), part(source.cast("string"))][:2 - level]
    return F.concat(F.lit(f"{level}|"), *parts)


def _distance(x: list[Column], centre: list[Column], lower: list[list[Column]]) -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor."""
    solved: list[Column] = []
    for i in range(DIM):
        rest = x[i] - centre[i]
        for j in range(i):
            rest = rest - lower[i][j] * solved[j]
        solved.append(rest / lower[i][i])
    return reduce(lambda a, b: a + b, [y * y for y in solved])


def _fit(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Centre m*, Cholesky factor l** and log determinant of groups with their count n and exact sums s*, q**."""
    out = moments
    n = F.col("n").cast("double")
    out = out.withColumns({f"m{i}": F.col(f"s{i}").cast("double") / n for i in range(DIM)})
    for i in range(DIM):
        for j in range(i + 1):
            value = (F.col(f"q{j}{i}").cast("double") / n - F.col(f"m{i}") * F.col(f"m{j}")) * CONSISTENCY
            value = F.greatest(value, F.lit(0.0)) + FLOORS[i] ** 2 if i == j else value
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:  # rounding may not push a pivot below its floor
                value = F.sqrt(F.greatest(value, F.lit(FLOORS[i] ** 2 / 4)))
            else:
                value = value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    det = reduce(lambda a, b: a + b, [F.log(F.col(f"l{i}{i}")) for i in range(DIM)])
    return out.withColumn("det", det).select(*keys, "n", "det", *_CENTRE, *_FACTOR)


_CENTRE = [f"m{i}" for i in range(DIM)]
_FACTOR = [f"l{i}{j}" for i in range(DIM) for j in range(i + 1)]


def _sums() -> list[Column]:
    pairs = [(i, j) for i in range(DIM) for j in range(i, DIM)]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(X[i]).alias(f"s{i}") for i in range(DIM)],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}{j}") for i, j in pairs]]


_SUMMED = ["n", *[f"s{i}" for i in range(DIM)], *[f"q{i}{j}" for i in range(DIM) for j in range(i, DIM)]]


def _estimated_distance() -> Column:
    lower = [[F.col(f"l{i}{j}") for j in range(i + 1)] for i in range(DIM)]
    return _distance([F.col(c).cast("double") for c in X], [F.col(c) for c in _CENTRE], lower)


def _median(rows: DataFrame, value: str) -> DataFrame:
    """Exact lower median of the whole numbers ``value`` per (g, f): counts per value, then a running sum."""
    run = Window.partitionBy("g", "f").orderBy(value)
    total = Window.partitionBy("g", "f")
    # Written out, so that the counts of a value meet in tasks of their own; the window then has a row per value, and
    # the values are thousandths up to 100.
    return (cut(rows.groupBy("g", "f", value).agg(F.count(F.lit(1)).alias("c")))
            .withColumn("below", F.sum("c").over(run)).withColumn("all", F.sum("c").over(total))
            .where(2 * F.col("below") >= F.col("all")).groupBy("g", "f").agg(F.min(value).alias("median")))


def _robust_start(rows: DataFrame) -> DataFrame:
    """Estimate from medians and median absolute deviations, without covariances."""
    long = rows.select("g", F.posexplode(F.array(*X)).alias("f", "x"))
    centre = cut(_median(long, "x"))
    gap = long.join(centre, ["g", "f"]).select("g", "f", F.abs(F.col("x") - F.col("median")).alias("gap"))
    spread = _median(gap, "gap").withColumnRenamed("median", "mad")
    wide = centre.join(spread, ["g", "f"]).groupBy("g").agg(
        *[F.max(F.when(F.col("f") == i, F.col("median"))).cast("double").alias(f"m{i}") for i in range(DIM)],
        *[F.max(F.when(F.col("f") == i, F.col("mad"))).cast("double").alias(f"d{i}") for i in range(DIM)])
    factor = {f"l{i}{j}": F.sqrt((1.4826 * F.col(f"d{i}")) ** 2 + FLOORS[i] ** 2) if i == j else F.lit(0.0)
              for i in range(DIM) for j in range(i + 1)}
    return wide.withColumns(factor).select("g", F.lit("robust").alias("start"), *_CENTRE, *_FACTOR)


def mcd_estimates(stats: DataFrame, steps: int = STEPS, min_group: int = MIN_GROUP) -> DataFrame:
    """One estimate per group key g of ``stats`` (lang, source and the base statistics), checkpointed."""
    good = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    keys = F.array(*[group_key(k, F.col("lang"), F.col("source")) for k in range(3)])
    rows = good.select(F.explode(keys).alias("g"), *[c.alias(X[i]) for i, c in enumerate(vector(BASE))])
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("all")).where(F.col("all") >= min_group)
    sizes = cut(sizes)
    n_groups = sizes.count()
    rows = rows.join(hint_broadcast(sizes, n_groups, 80), "g")
    classical = _fit(rows.groupBy("g").agg(*_sums()), ["g"]).withColumn("start", F.lit("classical"))
    shape = ["g", "start", *_CENTRE, *_FACTOR]
    estimate = cut(classical.select(shape).unionByName(_robust_start(rows)))
    run = Window.partitionBy("g", "start").orderBy("bin")
    for _ in range(steps):
        near = rows.join(hint_broadcast(estimate, 2 * n_groups, 240), "g")
        # bins of about 2.5 % of the distance; a group has some hundreds of them
        binned = (near.withColumn("bin", F.floor(40 * F.log(_estimated_distance() + 0.001)))
                  .groupBy("g", "start", "bin").agg(F.max("all").alias("all"), *_sums()))
        inner = (binned.withColumn("before", F.coalesce(F.sum("n").over(
            run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .where(F.col("before") < ALPHA * F.col("all"))
            .groupBy("g", "start").agg(*[F.sum(c).alias(c) for c in _SUMMED]))
        estimate = cut(_fit(inner, ["g", "start"]))
    best = estimate.groupBy("g").agg(F.min_by(F.struct(*_CENTRE, *_FACTOR), F.struct("det", "start")).alias("e"))
    return cut(best.select("g", *[F.col(f"e.{c}").alias(c) for c in [*_CENTRE, *_FACTOR]]))


def with_verdict(rows: DataFrame, names: list[str], estimates: DataFrame, kept: str, cutoff: float = CUTOFF) -> DataFrame:
    """``rows`` (lang, source, the statistics under ``names``, others) with the boolean ``kept``."""
    n = estimates.count()
    found, keep_columns = rows, list(rows.columns)
    ids = fresh([*keep_columns, kept], *[f"e_{k}" for k in range(3)])
    overall = estimates.where(F.col("g") == group_key(2, F.lit(None), F.lit(None))).select(F.struct(*_CENTRE, *_FACTOR))
    for level, e in enumerate(ids):
        if level == 2:  # one row or none
            found = found.withColumn(e, overall.scalar())
            continue
        g, = fresh([*found.columns, *ids], f"g_{level}")
        side = estimates.where(F.col("g").startswith(f"{level}|")).select(
            F.col("g").alias(g), F.struct(*_CENTRE, *_FACTOR).alias(e))
        found = found.join(hint_broadcast(side, n, 240),
                           group_key(level, rows["lang"], rows["source"]) == side[g], "left").drop(g)
    e = F.coalesce(*[F.col(c) for c in ids])
    lower = [[e[f"l{i}{j}"] for j in range(i + 1)] for i in range(DIM)]
    d = _distance([c.cast("double") for c in vector(names)], [e[c] for c in _CENTRE], lower)
    failed = base_failed(F.col(names[0]), F.col(names[4]))
    # One expression over both sides of the joins, so that no part of it moves below them, where the optimizer would
    # write the statistics' expressions out in full in place of their columns.
    good = F.when(failed, F.lit(False)).otherwise(F.coalesce(d <= cutoff, F.lit(True)))
    return found.withColumn(kept, good).select(*keep_columns, kept)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed and kept of every row of ``docs`` (doc_id, text, lang, source)."""
    stats = cut(with_statistics(docs.select("doc_id", "text", "lang", "source"), BASE).drop("text"))
    judged = with_verdict(stats, BASE, mcd_estimates(stats), "kept")
    return judged.select("doc_id", *BASE, base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
                         "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns. Texts are read twice and not shuffled."""
    names = fresh(docs.columns, *BASE)
    stats = cut(with_statistics(docs.select("text", "lang", "source"), BASE).drop("text"))
    kept, = fresh([*docs.columns, *names], "kept")
    judged = with_verdict(with_statistics(docs, names), names, mcd_estimates(stats), kept)
    return judged.where(F.col(kept)).select(*docs.columns)
