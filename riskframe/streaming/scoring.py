"""Scoring of requests as they arrive.

A request is scored from its own transactions alone, so no state is kept between
micro-batches: each is a run of the batch job.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskframe.plans.score import score_payloads
from riskframe.sources.payloads import rejected_payloads

REQUESTS = "request_id string, payload string"


def read_requests(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """A stream of request files: JSON lines with a request id and a payload."""
    reader = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def score_stream(
    requests: DataFrame,
    encoder: PipelineModel,
    classifier: PipelineModel,
    output: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Write scores to ``output``/scores and rejected requests to ``output``/rejects.

    Each micro-batch writes its own folder and overwrites it when repeated, so a
    restart leaves every request scored once.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read for the scores and for the rejects
        try:
            scored = score_payloads(batch, encoder, classifier)
            scored.write.mode("overwrite").parquet(f"{output}/scores/batch={batch_id}")
            rejected = rejected_payloads(batch)
            rejected.write.mode("overwrite").parquet(f"{output}/rejects/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = requests.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
