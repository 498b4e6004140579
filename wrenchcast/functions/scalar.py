"""Scalar Column expressions (section G of the inventory).

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
# Request formats: day ``YYYY-MM-DD`` (three parts of 4, 2, 2 characters
# split on '-') and aircraft ``XX-XXX`` (two parts of 2 and 3 characters).
DAY_PARTS = (4, 2, 2)
AIRCRAFT_PARTS = (2, 3)
# Text shown for a predicted class.
PREDICTION_TEXT = {0.0: "No maintenance", 1.0: "Maintenance"}
# Sensor file names: ``ddMMyy-FROM-TO-nnnn-XX-XXX.csv``; the aircraft id is the
# 5th and 6th '-'-separated parts with the extension removed.
FILE_NAME_PATTERN = r"^[^-]+-[^-]+-[^-]+-[^-]+-([^-]{2}-[^-]{3})\.csv\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_text(ts) -> Column:
    """First 10 characters of a timestamp text: ``yyyy-MM-dd`` (1-based substring)."""
    return F.substring(_col(ts).cast("string"), 1, 10)


def parse_date(text, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to DATE with a pattern; malformed text gives null instead of failing."""
    return F.try_to_date(_col(text), fmt)


def parse_iso_day(text) -> Column:
    """``yyyy-MM-dd`` text to DATE, null when malformed; same result as
    ``parse_date(text)`` for that pattern. Once the text has the digit shape
    (a cheap regex) the plain cast to DATE does the parse (it rejects
    impossible dates such as 2024-02-30 too); it is several times cheaper per
    row than a pattern-based parse, which matters on raw readings."""
    t = _col(text)
    return F.when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), t.try_cast("date"))


def asset_from_file_name(name) -> Column:
    """Aircraft id from a sensor file name, e.g. ``...-XY-SHM.csv`` -> ``XY-SHM``;
    null when the whole name is not of the fixed form, so that no badly named
    files merge into an aircraft that does not exist."""
    return F.nullif(F.regexp_extract(_col(name), FILE_NAME_PATTERN, 1), F.lit(""))


def _parts_pattern(lengths) -> str:
    return "^" + "-".join("[^-]{%d}" % n for n in lengths) + r"\z"


def valid_day_text(day) -> Column:
    """True when ``day`` splits on '-' into parts of 4, 2 and 2 characters.

    Like the reference it checks lengths, not digits (``20X5-AA-01`` passes);
    use ``strict_day_text`` to also require a real calendar date.
    """
    return F.coalesce(_col(day).rlike(_parts_pattern(DAY_PARTS)), F.lit(False))


def valid_asset_text(asset) -> Column:
    return F.coalesce(_col(asset).rlike(_parts_pattern(AIRCRAFT_PARTS)), F.lit(False))


def valid_request(day, asset) -> Column:
    return valid_day_text(day) & valid_asset_text(asset)


def strict_day_text(day) -> Column:
    return valid_day_text(day) & parse_date(day).isNotNull()


def decode_prediction(prediction) -> Column:
    p = _col(prediction)
    return (F.when(p == F.lit(0.0), F.lit(PREDICTION_TEXT[0.0]))
            .when(p.isNotNull(), F.lit(PREDICTION_TEXT[1.0])))


def exact_sum(c, scale: int | None) -> Column:
    """Sum of a double column.

    With ``scale`` (inputs carry at most that many decimals, like money or
    two-decimal sensor values) the values are summed as integers of
    10^-scale units (a BIGINT sum: exact, fixed-width and about 3x faster
    than a DECIMAL sum, whose widened buffer is a BigDecimal). The result is
    independent of partitioning and task order, so re-runs after lost
    executors and the SQL oracle (a DECIMAL sum) give identical numbers.
    The sum must stay below 2^63 units. It is never silently wrong: with ANSI
    mode (Spark 4's default) an overflow raises; in a session with ANSI off,
    where ``sum`` would wrap around, ``try_sum`` is used and an overflow gives
    null. The sum itself is exact; as a double it has 53 bits, so above 2^53
    units the result is the nearest double. Values with more decimals than
    ``scale`` are rounded to it (``excess_decimals`` finds them).
    """
    c = _col(c)
    if scale is None:
        return F.sum(c)
    unit = float(10 ** scale)
    units = F.round(c * F.lit(unit)).cast("bigint")
    return (F.sum(units) if _ansi_enabled() else F.try_sum(units)) / F.lit(unit)


def excess_decimals(c, scale: int) -> Column:
    """True for values that ``exact_sum`` with this scale would round."""
    return F.coalesce(F.round(_col(c), scale) != _col(c), F.lit(False))


def _ansi_enabled() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if spark is None:
        return False  # unknown: take the overflow-safe form
    return str(spark.conf.get("spark.sql.ansi.enabled", "true")).lower() == "true"


def exact_avg(c, scale: int | None, digits: int = 6) -> Column:
    """Average matching ``exact_sum``; rounded to ``digits`` when exact."""
    c = _col(c)
    if scale is None:
        return F.avg(c)
    return F.round(exact_sum(c, scale) / F.count(c), digits)


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets) of a key: first 32 bits of md5(text).

    Independent of partitioning, order and engine (DuckDB gives the same value
    with ``('0x'||substr(md5(k::varchar),1,8))::BIGINT % buckets``).
    """
    h = F.conv(F.substring(F.md5(_col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))
