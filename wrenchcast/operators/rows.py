"""Row transforms of the tutorial's RDD section, as DataFrame expressions.

``rdd.map`` / ``rdd.flatMap`` with Python lambdas ship every row to Python.
The same results come from ``when`` / ``struct`` / ``explode`` inside the JVM.
Mixed-type tuples become string columns (a DataFrame column has one type).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_text(c: Column) -> Column:
    return c.cast("string")


def map_rows(df: DataFrame, cond: Column, then: Sequence[Column], otherwise: Sequence,
             names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly one output per row: ``then`` fields when ``cond`` is true, else the
    constant ``otherwise`` fields (J1). A null condition counts as false,
    like Python's truthiness of None."""
    c = F.coalesce(cond, F.lit(False))
    outs = [F.when(c, _as_text(t)).otherwise(_as_text(o if isinstance(o, Column) else F.lit(o))).alias(n)
            for t, o, n in zip(then, otherwise, names)]
    return df.select(*keep, *outs)


def map_rows_nullable(df: DataFrame, cond: Column, then: Sequence[Column], names: Sequence[str],
                      name: str = "row", keep: Sequence[str] = ()) -> DataFrame:
    """One output per row, a null row when ``cond`` is not true (J2):
    ``when(cond, struct(...))`` without ``otherwise``."""
    c = F.coalesce(cond, F.lit(False))
    return df.select(*keep, F.when(c, F.struct(*[_as_text(t).alias(n) for t, n in zip(then, names)])).alias(name))


def flat_map(df: DataFrame, cond: Column, items: Sequence[Column], name: str = "value",
             keep: Sequence[str] = ()) -> DataFrame:
    """0..n outputs per row (J3): ``items`` when ``cond`` is true, nothing otherwise."""
    c = F.coalesce(cond, F.lit(False))
    arr = F.when(c, F.array(*[_as_text(i) for i in items])).otherwise(F.array().cast("array<string>"))
    return df.select(*keep, F.posexplode(arr).alias("item", name))
