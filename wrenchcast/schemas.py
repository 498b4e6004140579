"""Schemas of the logical tables of the maintenance domain.

Column names use ``snake_case``; the reference's spaced name ``aircraft id``
is accepted by the matrix CSV reader and renamed on load.
"""

from pyspark.sql import types as T

# One measurement of one sensor CSV: ``date;series;value`` with a header.
# ``value`` is read as DOUBLE; a value that does not parse becomes null and
# the raw line is kept in ``_corrupt_record`` so bad rows can be counted.
READING_CSV = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("_corrupt_record", T.StringType()),
])

# Normalised readings: one row per measurement.
READINGS = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("value", T.DoubleType()),
])

# Daily utilisation KPIs, one row per (asset, day) in the source.
KPIS = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("flighthours", T.DoubleType()),
    T.StructField("flightcycles", T.IntegerType()),
    T.StructField("delayedminutes", T.IntegerType()),
])

# Operation interruptions already filtered to the subsystem of interest.
INTERRUPTIONS = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("event_day", T.DateType()),
])

# Feature matrix, unique by (asset_id, day).
MATRIX = T.StructType([
    T.StructField("asset_id", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("avg_sensor", T.DoubleType()),
    T.StructField("flighthours", T.DoubleType()),
    T.StructField("flightcycles", T.IntegerType()),
    T.StructField("delayedminutes", T.IntegerType()),
    T.StructField("label", T.IntegerType()),
])

# The matrix as the reference stored it in CSV (header names kept).
MATRIX_CSV = T.StructType([
    T.StructField("aircraft id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("avg_sensor", T.DoubleType()),
    T.StructField("flighthours", T.DoubleType()),
    T.StructField("flightcycles", T.IntegerType()),
    T.StructField("delayedminutes", T.IntegerType()),
    T.StructField("label", T.IntegerType()),
])

# Scoring requests as typed by a user: day ``YYYY-MM-DD``, asset ``XX-XXX``.
REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("day", T.StringType()),
    T.StructField("asset_id", T.StringType()),
])

# Counts of the raw readings that a scan saw (``sources.readings``).
READING_COUNTS = ("n_rows", "n_good", "bad_file_name", "bad_date", "bad_value")

# One row per committed version of the stored tables.
MANIFEST = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("horizon_days", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in READING_COUNTS],
])

# One row per trained model in the run table.
RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment", T.StringType()),
    T.StructField("model_class", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("recall_class1", T.DoubleType()),
    T.StructField("num_features", T.IntegerType()),
    T.StructField("max_depth", T.IntegerType()),
    T.StructField("max_bins", T.IntegerType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("skipped_rows", T.LongType()),
    T.StructField("skipped_test_rows", T.LongType()),
    T.StructField("dropped_bins", T.StringType()),
    T.StructField("search_id", T.StringType()),
])

# One row per finished fit of a named grid search.
FITS = T.StructType([
    T.StructField("search_id", T.StringType()),
    T.StructField("data_key", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("max_depth", T.IntegerType()),
    T.StructField("max_bins", T.IntegerType()),
    T.StructField("fold", T.IntegerType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("finished_at", T.TimestampType()),
])
