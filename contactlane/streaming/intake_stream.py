"""The intake as a Structured Streaming job over a folder of e-mail files.

The same stateless transforms as the batch intake run on each micro-batch;
the directory is a static DataFrame joined to the stream, read and planned anew
by its current size in every micro-batch. Each micro-batch
is written to its own ``batch_id=<n>`` folder with overwrite, so a batch
replayed after a failure replaces its earlier output instead of adding
duplicates; the query's checkpoint records which files were consumed.

With ``resent_within`` a message that comes again (same ``email_id``, whatever its
content) within that time gives no second queue row, also in a later micro-batch
or after a restart: the ids seen are keyed state that expires with the
watermark. Time is that of the message's arrival (its micro-batch), so nothing is
late; or, with ``event_time``, a timestamp column of the messages: then rows older
than the latest one by more than ``resent_within`` are late, and dropped.
:func:`stream_counts` tells how many rows were resent and late. Of equal ids in one
micro-batch one stays. Messages without an id are never held for resent.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans import intake
from ..sources import schemas
from ..session import ensure_checkpoint_dir


def without_resent(emails: DataFrame, within: str, event_time: str | None = None) -> DataFrame:
    """Streaming ``emails`` without messages whose id came before, less than ``within``
    ago. A row without an id is known by its place in its file."""
    place = F.concat_ws("#", F.lit("row"), "_metadata.file_path", "_metadata.row_index")
    key = F.when(F.col("email_id").isNull(), place).otherwise(F.concat(F.lit("id#"), F.col("email_id")))
    time = F.col(event_time) if event_time else F.current_timestamp()
    keyed = emails.select("*", key.alias("_key"), time.alias("_time"))
    return keyed.withWatermark("_time", within).dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_time")


def stream_counts(query: StreamingQuery) -> dict[str, int]:
    """Rows read, resent and late, over the progress reports the query still holds
    (``spark.sql.streaming.numRecentProgressUpdates``)."""
    counts = {"rows": 0, "resent": 0, "late": 0}
    for p in query.recentProgress:
        counts["rows"] += p["numInputRows"]
        for op in p["stateOperators"]:
            counts["resent"] += int(op["customMetrics"].get("numDroppedDuplicateRows", 0))
            counts["late"] += int(op["numRowsDroppedByWatermark"])
    return counts


def intake_stream(spark: SparkSession, emails_dir: str, directory: DataFrame,
                  as_of: Column | None = None, max_files_per_trigger: int | None = None,
                  resent_within: str | None = None, event_time: str | None = None) -> DataFrame:
    """Streaming DataFrame of queue rows from new e-mail Parquet files."""
    schema = schemas.EMAILS
    if event_time:
        schema = T.StructType([*schema.fields, T.StructField(event_time, T.TimestampType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    emails = reader.parquet(emails_dir)
    if resent_within:
        emails = without_resent(emails, resent_within, event_time)
    stamp = as_of if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    return intake.queue_rows(emails, directory, stamp)


def start_intake_stream(spark: SparkSession, emails_dir: str, directory: DataFrame,
                        queue_path: str, checkpoint_location: str | None = None,
                        as_of: Column | None = None, available_now: bool = True,
                        processing_time: str | None = None,
                        max_files_per_trigger: int | None = None,
                        resent_within: str | None = None, event_time: str | None = None) -> StreamingQuery:
    """Start the stream; queue rows land under ``queue_path/batch_id=<n>/queue_type=<q>``
    (read them with ``tables.read_queue``)."""
    rows = intake_stream(spark, emails_dir, directory, as_of, max_files_per_trigger, resent_within, event_time)
    location = checkpoint_location or os.path.join(ensure_checkpoint_dir(spark), "intake-stream")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").partitionBy("queue_type")
         .parquet(os.path.join(queue_path, f"batch_id={batch_id}")))

    writer = rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
