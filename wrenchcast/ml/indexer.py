"""A category index kept as a table.

``StringIndexer`` brings every distinct value to the driver and stores the list inside the model. ``TableIndexer`` gives
the same numbers from a distributed count and row number; the model keeps them as a Parquet table beside its metadata
and joins it when it transforms, so neither the driver nor the model object ever holds the vocabulary.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wrenchcast.operators.keys import value_ranks
from wrenchcast.session import write_table


class TableIndexer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers values from 0 by falling frequency, ties by ascending text; nulls are not counted."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TableIndexModel:
        text = dataset.select(F.col(self.getInputCol()).cast("string").alias("value")).where("value IS NOT NULL")
        index = write_table(value_ranks(text, "value", "number", written=True))
        model = TableIndexModel(index, index.count())
        model._resetUid(self.uid)
        return self._copyValues(model)


class TableIndexModel(Model, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """``size`` values have the numbers below ``size``; unseen values and nulls get ``size`` itself."""

    size = Param(Params._dummy(), "size", "number of values", TypeConverters.toInt)

    def __init__(self, index: DataFrame | None = None, size: int | None = None):
        super().__init__()
        self.index = index  # value, number
        if size is not None:
            self._set(size=size)

    def categories(self) -> int:
        """Values of the feature, the one for unseen values included."""
        return self.getOrDefault(self.size) + 1

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # Trees take the feature as nominal by its number of values; the values themselves are not in the metadata.
        attribute = {"ml_attr": {"type": "nominal", "num_vals": self.categories(), "name": self.getOutputCol()}}
        index = self.index.select(F.col("value").alias("_value"), F.col("number").alias("_number"))
        joined = dataset.join(index, F.col(self.getInputCol()).cast("string") == F.col("_value"), "left")
        number = F.coalesce("_number", F.lit(float(self.categories() - 1)))
        return (joined.withColumn(self.getOutputCol(), number)
                .withMetadata(self.getOutputCol(), attribute).drop("_value", "_number"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: TableIndexModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.index.write.parquet(f"{path}/index")


class _Reader(MLReader):
    def __init__(self, cls: type[TableIndexModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableIndexModel:
        spark: SparkSession = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls(spark.read.schema("value string, number double").parquet(f"{path}/index"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
