"""Scoring requests as an unbounded feed (K5).

The reference looped on ``input()`` until the user typed "exit". Here the
requests arrive as files in a folder; Structured Streaming reads each new
file once, joins it with the static daily tables (stream-static left joins,
stateless, so no watermark or state store is needed), applies the saved
pipeline and appends the scored rows to a Parquet sink. Progress is kept in
the checkpoint folder, so a restarted query resumes where it stopped. A
request whose day or asset is ``exit`` is kept with status ``exit``; the
caller can stop the query once one has been seen.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wrenchcast.ml.score import (STATUS_EXIT, complete_requests, complete_requests_daily, daily_for_requests,
                                 score_requests)
from wrenchcast.schemas import REQUESTS

EXIT_WORD = "exit"


def read_request_stream(spark: SparkSession, folder: str, fmt: str = "csv",
                        max_files_per_trigger: int | None = None, schema=REQUESTS) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(folder)


def scored_stream(requests: DataFrame, sensor_daily: DataFrame | None, kpis: DataFrame | None,
                  model: PipelineModel, daily: DataFrame | None = None, valid: Column | None = None) -> DataFrame:
    """The same plan as the batch job (K4), on a streaming frame.

    Pass ``daily``, the stored table of ``operators.matrix.daily_table``: the
    static side of a stream-static join is read again for every micro-batch.
    """
    is_exit = (F.lower(F.col("day")) == EXIT_WORD) | (F.lower(F.col("asset_id").cast("string")) == EXIT_WORD)
    tagged = requests.withColumn("_exit", F.coalesce(is_exit, F.lit(False)))
    completed = (complete_requests_daily(tagged, daily, valid) if daily is not None
                 else complete_requests(tagged, sensor_daily, kpis, valid))
    completed = completed.withColumn(
        "status", F.when(F.col("_exit"), F.lit(STATUS_EXIT)).otherwise(F.col("status"))).drop("_exit")
    return score_requests(completed, model)


def start_scoring(spark: SparkSession, request_folder: str, sensor_daily: DataFrame | None,
                  kpis: DataFrame | None, model: PipelineModel, output_path: str, checkpoint_path: str,
                  available_now: bool = False, processing_time: str | None = None,
                  fmt: str = "csv", daily: DataFrame | None = None, valid: Column | None = None,
                  schema=REQUESTS, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the scoring query; ``available_now`` processes what is there and stops.

    ``valid`` replaces the default request-format check (day ``YYYY-MM-DD``,
    asset ``XX-XXX``), ``schema`` the request schema of the source files. With
    ``daily`` each micro-batch reads only the days it asks about and is written to
    its own folder ``batch_id=<n>``.
    """
    requests = read_request_stream(spark, request_folder, fmt, max_files_per_trigger, schema)
    if daily is not None:
        writer = requests.writeStream.foreachBatch(_batch_writer(daily, model, output_path, valid))
    else:
        scored = scored_stream(requests, sensor_daily, kpis, model, None, valid)
        writer = scored.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start() if daily is not None else writer.start(output_path)


def _batch_writer(daily: DataFrame, model: PipelineModel, output_path: str, valid: Column | None,
                  on_exit=lambda: None):
    """Scores a micro-batch against the days it asks about only and writes it to
    ``output_path/batch_id=<n>`` with overwrite, so that a batch replayed after a
    failure replaces its own output. Exit requests are counted by the write
    itself (an observed metric); the output is not read again."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        target = f"{output_path.rstrip('/')}/batch_id={batch_id}"
        batch.persist()  # read for its days and by the scoring below
        try:
            seen = Observation()
            scored = scored_stream(batch, None, None, model, daily_for_requests(batch, daily), valid)
            exits = F.count_if(F.col("status") == STATUS_EXIT).alias("exits")
            scored.observe(seen, exits).write.mode("overwrite").parquet(target)
        finally:
            batch.unpersist()
        if seen.get["exits"]:
            on_exit()

    return write_batch


def exit_seen(spark: SparkSession, output_path: str) -> bool:
    """True once a request with status ``exit`` has been written."""
    try:
        return not spark.read.parquet(output_path).where(F.col("status") == STATUS_EXIT).isEmpty()
    except AnalysisException as missing:  # no folder, or no file in it yet
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False


def score_until_exit(spark: SparkSession, request_folder: str, daily: DataFrame, model: PipelineModel,
                     output_path: str, checkpoint_path: str, valid: Column | None = None,
                     schema=REQUESTS, fmt: str = "csv", processing_time: str = "2 seconds",
                     timeout_seconds: float | None = None) -> bool:
    """Score arriving requests until one of them is ``exit`` (the reference's
    prompt loop as a stream). Returns True when stopped by an exit request.

    Micro-batches are scored and written as by ``start_scoring``.
    """
    if exit_seen(spark, output_path):
        # A restarted driver: the exit request was already processed and committed.
        return True
    seen = {"exit": False}

    requests = read_request_stream(spark, request_folder, fmt, schema=schema)
    write_batch = _batch_writer(daily, model, output_path, valid, lambda: seen.update(exit=True))
    query = (requests.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_path)
             .trigger(processingTime=processing_time).start())
    waited = 0.0
    step = 0.5
    try:
        while query.isActive and not seen["exit"]:
            query.awaitTermination(step)
            waited += step
            if timeout_seconds is not None and waited >= timeout_seconds:
                break
    finally:
        query.stop()
    return seen["exit"]
