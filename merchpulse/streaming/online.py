"""Online mode as a stream: score merchants as requests arrive (R2 + K7).

The published job scores one merchant when called with its key and hands
the result to a message broker.  Here requests are a stream of merchant
keys; each micro-batch scores all merchants requested in it in one run
(a semi-join of the metric table on the batch's distinct keys, then the
normal plan) and writes the final scores and the JSON quota messages
under ``<out>/batch_id=<n>``.  A retried batch overwrites its own folder,
so output is exactly-once together with the stream's checkpoint.
Publishing the message folder to a broker is the caller's connector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from merchpulse.plans.job import score_all
from merchpulse.schema import KEY
from merchpulse.sinks.messages import DEFAULT_ITEM, quota_json


def read_requests(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of merchant keys, one per line of text files in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.trim(F.col("value")).alias(KEY)).where(F.col(KEY) != "")


def score_batch(requests: DataFrame, metrics: DataFrame, as_of, item_name: str = DEFAULT_ITEM, **kw):
    """Score the merchants named in one batch of requests.

    The requested keys are de-duplicated and semi-joined to the metrics;
    with AQE the small key side is broadcast at run time when its measured
    size allows, otherwise it is a shuffle join.
    """
    keys = requests.select(KEY).distinct()
    run = score_all(metrics.join(keys, KEY, "left_semi"), as_of, **kw)
    return run.final, quota_json(run.quotas, as_of, item_name=item_name), run.rejects


def score_requests(
    requests: DataFrame,
    metrics: DataFrame,
    as_of,
    out_path: str,
    checkpoint_location: str,
    item_name: str = DEFAULT_ITEM,
    available_now: bool = False,
    processing_time: str | None = None,
    **kw,
) -> StreamingQuery:
    """Start the stream.  ``checkpoint_location`` must be on shared storage."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        final, messages, rejects = score_batch(batch, metrics, as_of, item_name=item_name, **kw)
        target = f"{out_path.rstrip('/')}/batch_id={batch_id}"
        final.write.mode("overwrite").parquet(f"{target}/final")
        messages.write.mode("overwrite").parquet(f"{target}/messages")
        if rejects is not None:
            rejects.write.mode("overwrite").parquet(f"{target}/rejects")

    writer = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
