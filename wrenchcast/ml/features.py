"""Feature pipeline (I1-I4): asset index, day features, vector assembly.

One pipeline is fitted on the training rows only and saved together with the
classifier, so scoring uses the same indexes (the reference re-fitted the
indexers on the test split and on every single request).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler

from wrenchcast.ml.indexer import TableIndexer, TableIndexModel

#: Values of the hashed asset feature.
HASHED_ASSETS = 1 << 20

NUMERIC_FEATURES = ["avg_sensor", "flighthours", "flightcycles", "delayedminutes"]


def feature_pipeline(date_feature: str = "calendar", handle_invalid: str = "skip",
                     asset_feature: str = "category") -> Pipeline:
    """Stages that turn matrix rows into ``features``.

    date_feature:
      ``calendar`` (default): day of week and month, numeric;
      ``index``: the day as a category, as in the reference (needs
      ``maxBins`` >= number of days; checked by the trainer).
    handle_invalid: rows with a null feature are skipped in training; scoring
    keeps them and marks them by status instead.
    asset_feature:
      ``category`` (default, as in the reference): the asset index is a
      nominal feature, so trees need ``maxBins`` > number of assets;
      ``continuous``: a hash of the asset as a number, for fleets too large for
      one bin per asset; it needs no vocabulary;
      ``none``: no asset feature.
    """
    prep = SQLTransformer(statement=(
        "SELECT *, CAST(asset_id AS STRING) AS feat_asset, CAST(day AS STRING) AS feat_day, "
        "CAST(dayofweek(day) AS DOUBLE) AS feat_day_of_week, CAST(month(day) AS DOUBLE) AS feat_month "
        "FROM __THIS__"))
    # Ties of frequency are broken alphabetically; unseen assets get an extra index. The index is a table (``indexer``).
    stages = [prep, TableIndexer(inputCol="feat_asset", outputCol="feat_asset_index")]
    if asset_feature == "category":
        inputs = ["feat_asset_index"]
    elif asset_feature == "continuous":
        stages = [prep, SQLTransformer(statement=(
            f"SELECT *, CAST(pmod(xxhash64(feat_asset), {HASHED_ASSETS}) AS DOUBLE) AS feat_asset_hash FROM __THIS__"))]
        inputs = ["feat_asset_hash"]
    elif asset_feature == "none":
        stages = stages[:1]
        inputs = []
    else:
        raise ValueError("asset_feature must be 'category', 'continuous' or 'none'")
    if date_feature == "index":
        stages.append(TableIndexer(inputCol="feat_day", outputCol="feat_day_index"))
        inputs.append("feat_day_index")
    elif date_feature == "calendar":
        inputs += ["feat_day_of_week", "feat_month"]
    else:
        raise ValueError("date_feature must be 'calendar' or 'index'")
    stages.append(VectorAssembler(inputCols=inputs + NUMERIC_FEATURES, outputCol="features",
                                  handleInvalid=handle_invalid))
    return Pipeline(stages=stages)


def feature_width(model: PipelineModel) -> int:
    """Length of the feature vector, from the assembler's inputs (I4): no job."""
    assembler = [s for s in model.stages if isinstance(s, VectorAssembler)][-1]
    return len(assembler.getInputCols())


def category_sizes(model: PipelineModel) -> dict[str, int]:
    """Number of values of each categorical feature (one more for unseen)."""
    return {s.getOutputCol(): s.categories() for s in model.stages if isinstance(s, TableIndexModel)}


def with_invalid_kept(model: PipelineModel) -> PipelineModel:
    """Copy of a fitted pipeline whose assembler keeps rows with null inputs
    (as NaN) so that scoring never drops a request."""
    stages = []
    for s in model.stages:
        if isinstance(s, VectorAssembler):
            s = s.copy({s.handleInvalid: "keep"})
        stages.append(s)
    return PipelineModel(stages)
