"""New-scene events: validation, fan-out to tasks and incremental processing (ST1-ST5).

Messages are push envelopes {message: {data: base64 JSON, messageId}, subscription}. Processing is at least
once; a run's id comes from scene, task and parameters, so repeats change nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.sensors import KNOWN_SENSORS
from ..functions.text import canonical_json, product_id_column
from ..sources.shared import written
from .upserts import claimed

ENVELOPE = "message struct<data:string,messageId:string,publishTime:string>, subscription string"
PAYLOAD = "scene_id string, sensor string, acquisition_date string"


def message_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Envelopes as JSON lines arriving in a folder (ST1)."""
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def parsed(messages: DataFrame) -> DataFrame:
    """Envelopes with scene_id, sensor, acquisition_date and error: null, 'envelope', 'payload', 'keys' or 'sensor' (ST2)."""
    data = F.col("message.data")
    valid = data.rlike(r"^[A-Za-z0-9+/\s]+={0,2}$")
    body = F.from_json(F.when(valid, F.try_to_binary(data, F.lit("base64"))).cast("string"), PAYLOAD)
    rows = messages.withColumn("_b", F.explode(F.array(body)))  # a row each; a plain column's parse is copied into the conditions and run for each of them, in a filter below what deals the rows out
    error = (
        F.when(data.isNull(), "envelope")
        .when(F.col("_b").isNull() | ~valid, "payload")
        .when(F.col("_b.scene_id").isNull() | F.col("_b.sensor").isNull(), "keys")
        .when(~F.lower("_b.sensor").isin(*KNOWN_SENSORS), "sensor")
    )
    return rows.select(F.col("message.messageId").alias("message_id"), "_b.scene_id", F.lower("_b.sensor").alias("sensor"), F.col("_b.acquisition_date").alias("acquisition_date"), error.alias("error"))


def accepted(messages: DataFrame) -> DataFrame:
    return parsed(messages).where("error is null").drop("error")


def rejected(messages: DataFrame) -> DataFrame:
    """What goes to the dead letters."""
    return parsed(messages).where("error is not null")


def fan_out(events: DataFrame, tasks: list[str], parameters: dict | None = None) -> DataFrame:
    """A row per event and task, with the run's id (ST3)."""
    out = events.withColumn("task", F.explode(F.array(*[F.lit(t) for t in tasks])))
    text = F.lit(canonical_json(parameters))
    return out.withColumn("parameters", text).withColumn("product_id", product_id_column(F.col("scene_id"), F.col("task"), text))


LOG = "product_id string, message_id string, scene_id string, sensor string, acquisition_date string, task string, parameters string, status string, seq bigint"


def run_incremental(
    messages: DataFrame, tasks: dict[str, Callable[[DataFrame], DataFrame]], out: str, checkpoint: str, dead_letters: str | None = None, parameters: dict | None = None
) -> StreamingQuery:
    """Run each task on the scenes of every batch that have no complete run yet, and append a run log at out (ST4, ST5).

    Each task maps a frame of its events to one with column status ('complete' or 'failed'). The log gets not_started
    and final states in order of seq; the stream ends when it has read all there is. The log is a stream as well:
    what became of a run is kept in the state store, so a batch reads new log rows only, and writes once for all tasks.
    """
    spark = messages.sparkSession
    spark.createDataFrame([], LOG).write.mode("append").parquet(out)  # a stream's folder must be there
    log = spark.readStream.schema(LOG).parquet(out)
    wanted = claimed(fan_out(accepted(messages), list(tasks), parameters), log)

    def process(batch: DataFrame, batch_id: int) -> None:
        todo = written(batch, "claims")
        parts = [task(rows).select(*todo.columns, "status") for name, task in tasks.items() for rows in [todo.where(F.col("task") == name)]]
        rows = reduce(DataFrame.unionByName, parts, todo.withColumn("status", F.lit("not_started")))
        start = int(time.time() * 1e6) * 2  # later than all that earlier queries on this log gave
        rows.withColumn("seq", F.lit(start) + (F.col("status") != "not_started").cast("long")).write.mode("append").parquet(out)

    def bury(batch: DataFrame, batch_id: int) -> None:
        rejected(batch).withColumn("batch", F.lit(batch_id)).write.mode("append").json(dead_letters)

    if dead_letters:
        messages.writeStream.foreachBatch(bury).option("checkpointLocation", f"{checkpoint}-dead").trigger(availableNow=True).start().awaitTermination()
    return wanted.writeStream.foreachBatch(process).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", window: str = "1 hour", late: str = "2 hours", by: str = "event_type") -> DataFrame:
    """Counts by event-time window, late rows within the watermark included. Not a capability of the catalog; offered for event tables."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"))
