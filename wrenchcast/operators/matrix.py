"""Feature matrix: one row per (asset, day) with sensor average, KPIs and a label.

Plan shape (all aggregations keyed by the same ``(asset_id, day)``):

    readings  --partial avg--> Exchange(asset_id, day) --final avg-------+
    kpis      --dedup (partial min)--> Exchange(asset_id, day) ----------+-- join (co-partitioned)
    events    --explode to the <= h+1 days each labels--> distinct ------+-- left join, label = hit?

* No band join: an interruption on day ``e`` labels exactly the days
  ``d`` with ``d <= e <= d + h``, i.e. ``d`` in ``[e - h, e]``. Exploding each
  event into those ``h + 1`` days turns the range condition into an
  equi-join on ``(asset_id, day)``; work is linear in events, not in pairs,
  and a hot asset spreads over its days instead of landing on one task.
* All three inputs are pre-aggregated map-side before the shuffle, so a key
  that holds a third of the rows still ships one partial row per task.
* The three sides are hash-partitioned on the same keys, so the two joins
  run without another exchange (or as broadcast joins when AQE sees a small
  side at run time).

When the three inputs are rows of one event log, ``build_matrix_from_log``
gives the same result with one scan and one shuffle (see its docstring).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wrenchcast.functions.scalar import exact_avg

KEYS = ["asset_id", "day"]

# Fixed values of the reference: labelling horizon of seven days after the
# row's day, both ends included ([day, day + 7]).
DEFAULT_HORIZON_DAYS = 7
MATRIX_COLUMNS = ["asset_id", "day", "avg_sensor", "flighthours", "flightcycles",
                  "delayedminutes", "label"]


def daily_average(readings: DataFrame, value_scale: int | None = None) -> DataFrame:
    """Mean reading per (asset_id, day) as ``avg_sensor``.

    ``value_scale``: readings carry that many decimals; the sum is then exact
    (an integer sum of 10^-scale units) and the mean rounded to 6 digits, so
    it is reproducible.
    """
    return readings.groupBy(*KEYS).agg(exact_avg("value", value_scale).alias("avg_sensor"))


def first_row_per_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Deterministic ``dropDuplicates(keys)``.

    Keeps, per key, the row that is smallest by ``order_by`` then by the
    remaining columns (nulls first). ``row_number() = 1`` plans as a window group
    limit: each task keeps the first row per key before the shuffle, so a hot key
    ships one row per task. (``min(struct(...))`` plans as a sort aggregate, which
    sorts as well and carries every column in its buffer.)
    """
    order_by = list(order_by or [])
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ordered = order_by + [c for c in rest if c not in order_by]
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in ordered])
    rank = "_first_row"
    while rank in df.columns:
        rank = "_" + rank
    return (df.withColumn(rank, F.row_number().over(first)).where(F.col(rank) <= 1)
            .select(*keys, *rest))


def label_days(interruptions: DataFrame, horizon_days: int = DEFAULT_HORIZON_DAYS,
               include_today: bool = True) -> DataFrame:
    """(asset_id, day) pairs that have an interruption within the horizon.

    ``interruptions`` has ``asset_id`` and ``event_day``. An event on day e
    labels days e - h .. e (or e - h .. e - 1 without ``include_today``).
    Each event yields at most h + 1 rows; duplicates are removed with a
    partial aggregation.
    """
    if horizon_days < 0:
        raise ValueError("horizon_days must be >= 0")
    last = 0 if include_today else 1
    e = F.col("event_day")
    if horizon_days < last:
        # Nothing can be labelled; keep the key types of the input.
        return interruptions.select("asset_id", e.alias("day")).where(F.lit(False))
    days = F.sequence(F.date_sub(e, horizon_days), F.date_sub(e, last))
    return (interruptions.where(e.isNotNull() & F.col("asset_id").isNotNull())
            .select("asset_id", F.explode(days).alias("day"))
            .distinct())


def label_within_horizon(matrix: DataFrame, interruptions: DataFrame,
                         horizon_days: int = DEFAULT_HORIZON_DAYS,
                         include_today: bool = True) -> DataFrame:
    """Add ``label`` = 1 when an interruption of the same asset falls in
    [day, day + horizon] (C3), else 0. Never changes the row count."""
    hits = label_days(interruptions, horizon_days, include_today).withColumn("_hit", F.lit(1))
    return (matrix.join(hits, KEYS, "left")
            .withColumn("label", F.coalesce(F.col("_hit"), F.lit(0)).cast("int"))
            .drop("_hit"))


# Equal pairs that one task writes at a time.
PAIRS_PER_CHUNK = 1 << 20


def band_join_left(matrix: DataFrame, interruptions: DataFrame,
                   horizon_days: int = DEFAULT_HORIZON_DAYS,
                   pairs_per_chunk: int = PAIRS_PER_CHUNK) -> DataFrame:
    """Every (row, interruption) pair with the event in [day, day + horizon].

    Left outer: a row without event is kept once with a null ``event_day``.
    Events are first reduced to (asset, event day, how many), a partial
    aggregate, and each such row is copied to the ``horizon + 1`` days it covers,
    so the band condition is an equi-join on (asset_id, day) in which a key has
    at most ``horizon + 1`` rows, however many events it received. Only
    then are rows repeated as often as there were events, in chunks that a hash
    of key and chunk number deals over the tasks.
    """
    if pairs_per_chunk < 1:
        raise ValueError("pairs_per_chunk must be >= 1")
    e = F.col("event_day")
    counted = (interruptions.where(e.isNotNull() & F.col("asset_id").isNotNull())
               .groupBy("asset_id", "event_day").agg(F.count(F.lit(1)).alias("_n")))
    spread = counted.select("asset_id", e, "_n", F.explode(F.sequence(F.date_sub(e, horizon_days), e)).alias("day"))
    joined = matrix.join(spread, KEYS, "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    last = F.floor((F.col("_n") - 1) / F.lit(pairs_per_chunk)).cast("long")
    chunks = (joined.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
              .repartition(*KEYS, "event_day", "_chunk"))
    here = F.least(F.col("_n") - F.col("_chunk") * pairs_per_chunk, F.lit(pairs_per_chunk).cast("long"))
    return (chunks.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), here)))
            .select(*matrix.columns, "event_day"))


def build_matrix(readings: DataFrame, kpis: DataFrame, interruptions: DataFrame,
                 horizon_days: int = DEFAULT_HORIZON_DAYS, include_today: bool = True,
                 value_scale: int | None = None, observed_until=None, unique_kpis: bool = False) -> DataFrame:
    """The management job (K1) as one DataFrame plan.

    readings:      asset_id, day, value             (many per key)
    kpis:          asset_id, day, flighthours, flightcycles, delayedminutes
                   (duplicates resolved deterministically; ``unique_kpis`` says that the
                   source has one row per key, which saves that step)
    interruptions: asset_id, event_day

    ``observed_until`` (a date): drop rows whose horizon reaches past the end
    of the interruption data, since their 0 label is not evidence
    (right-censoring); by default rows are kept as in the reference.
    """
    sensor = daily_average(readings, value_scale)
    daily_kpis = kpis.select(*KEYS, "flighthours", "flightcycles", "delayedminutes")
    if not unique_kpis:
        daily_kpis = first_row_per_key(daily_kpis, KEYS)
    matrix = sensor.join(daily_kpis, KEYS, "inner")
    if observed_until is not None:
        matrix = matrix.where(F.date_add(F.col("day"), horizon_days) <= F.lit(observed_until).cast("date"))
    matrix = label_within_horizon(matrix, interruptions, horizon_days, include_today)
    return matrix.select(*MATRIX_COLUMNS)


def daily_table(readings: DataFrame, kpis: DataFrame, value_scale: int | None = None) -> DataFrame:
    """Sensor average and KPIs of every (asset_id, day) that has either, with
    ``has_sensor`` / ``has_kpi`` flags.

    Stored once by the management stage, it is the single static side that
    request scoring (batch or streaming) joins with: a stream-static join
    re-reads its static side every micro-batch, which must be a stored table,
    not an aggregation over all raw readings. Both inputs are aggregated by
    the same keys, so the full outer join needs no further exchange.
    """
    known = F.col("asset_id").isNotNull() & F.col("day").isNotNull()  # a request never matches a null key
    sensor = daily_average(readings.where(known), value_scale).withColumn("has_sensor", F.lit(True))
    daily_kpis = first_row_per_key(
        kpis.where(known).select(*KEYS, "flighthours", "flightcycles", "delayedminutes"), KEYS
    ).withColumn("has_kpi", F.lit(True))
    joined = sensor.join(daily_kpis, KEYS, "full_outer")
    return joined.select(*KEYS, "avg_sensor", "flighthours", "flightcycles", "delayedminutes",
                         F.coalesce("has_sensor", F.lit(False)).alias("has_sensor"),
                         F.coalesce("has_kpi", F.lit(False)).alias("has_kpi"))


def daily_table_from_log(log: DataFrame, asset: Column, day: Column, value: Column,
                         is_reading: Column, is_kpi: Column, kpi_aggs: dict,
                         value_scale: int | None = None) -> DataFrame:
    """``daily_table`` when readings and KPI facts are rows of one log: one
    scan, one partial + final aggregation by (asset_id, day)."""
    rows = (log.where(is_reading | is_kpi)
            .select(asset.alias("asset_id"), day.alias("day"), value.alias("value"),
                    F.coalesce(is_reading, F.lit(False)).alias("_r"), F.coalesce(is_kpi, F.lit(False)).alias("_k"),
                    *[F.col(c) for c in log.columns if c not in _LOG_RESERVED]))
    n_kpi = F.sum(F.col("_k").cast("int"))
    agg = rows.where(F.col("asset_id").isNotNull() & F.col("day").isNotNull()).groupBy(*KEYS).agg(
        exact_avg(F.when(F.col("_r"), F.col("value")), value_scale).alias("avg_sensor"),
        *[F.when(n_kpi > 0, fn(F.col("_k"))).alias(name) for name, fn in kpi_aggs.items()],
        (F.sum(F.col("_r").cast("int")) > 0).alias("has_sensor"),
        (n_kpi > 0).alias("has_kpi"))
    return agg


def matrix_from_daily(daily: DataFrame, interruptions: DataFrame, horizon_days: int = DEFAULT_HORIZON_DAYS,
                      include_today: bool = True) -> DataFrame:
    """The matrix from a (stored) daily table: keys with both readings and
    KPIs, labelled. Equal to ``build_matrix`` over the same sources."""
    both = daily.where(F.col("has_sensor") & F.col("has_kpi")).select(*MATRIX_COLUMNS[:-1])
    return label_within_horizon(both, interruptions, horizon_days, include_today).select(*MATRIX_COLUMNS)


_LOG_RESERVED = ("asset_id", "day", "value", "_own_day", "_r", "_k", "_i")


def build_matrix_from_log(log: DataFrame, asset: Column, day: Column, value: Column,
                          is_reading: Column, is_kpi: Column, is_interruption: Column,
                          kpi_aggs: dict, horizon_days: int = DEFAULT_HORIZON_DAYS,
                          include_today: bool = True, value_scale: int | None = None) -> DataFrame:
    """The matrix when readings, KPI facts and interruptions are rows of ONE log.

    Same result as ``build_matrix`` over the three filtered views of the log,
    but the log is scanned once and shuffled once:

      scan(log, pushed OR of the three predicates)
        -> each interruption row is spread over the days it labels
        -> partial aggregate per (asset_id, day) -> Exchange -> final aggregate
        -> keep keys that have readings and KPI facts

    ``kpi_aggs`` maps an output column to ``f(in_kpi: Column) -> aggregate Column``
    computed over the KPI rows of the key; ``flightcycles``-style counts are
    built as ``F.sum(in_kpi.cast('int'))``.
    """
    last = 0 if include_today else 1
    days = F.when(is_interruption, F.sequence(F.date_sub(day, horizon_days), day)).otherwise(F.array(day))
    rows = (log.where(is_reading | is_kpi | is_interruption)
            .select(asset.alias("asset_id"), day.alias("_own_day"), value.alias("value"),
                    is_reading.alias("_r"), is_kpi.alias("_k"), is_interruption.alias("_i"),
                    F.explode(days).alias("day"),
                    *[F.col(c) for c in log.columns if c not in _LOG_RESERVED]))
    own = F.col("day") == F.col("_own_day")
    in_reading = F.coalesce(F.col("_r") & own, F.lit(False))
    in_kpi = F.coalesce(F.col("_k") & own, F.lit(False))
    hit = F.coalesce(F.col("_i") & (F.col("day") <= F.date_sub(F.col("_own_day"), last)), F.lit(False))
    reading_value = F.when(in_reading, F.col("value"))
    agg = rows.where(F.col("asset_id").isNotNull() & F.col("day").isNotNull()).groupBy(*KEYS).agg(
        exact_avg(reading_value, value_scale).alias("avg_sensor"),
        F.sum(in_reading.cast("int")).alias("_n_readings"),
        F.sum(in_kpi.cast("int")).alias("_n_kpi"),
        *[fn(in_kpi).alias(name) for name, fn in kpi_aggs.items()],
        F.max(hit.cast("int")).alias("label"))
    out = agg.where((F.col("_n_readings") > 0) & (F.col("_n_kpi") > 0))
    return out.select("asset_id", "day", "avg_sensor", *kpi_aggs.keys(), "label")


def cast_matrix(matrix: DataFrame) -> DataFrame:
    """Restore the matrix types after a text round trip."""
    types = {"avg_sensor": "double", "flighthours": "double", "flightcycles": "int",
             "delayedminutes": "int", "label": "int", "day": "date"}
    cols: list[Column] = []
    for c in matrix.columns:
        cols.append(F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`"))
    return matrix.select(*cols)
