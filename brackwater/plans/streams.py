"""Streams over the events table, run until all input is read; their SQL is the batch form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_path
from ..sources.tables import pick, read
from ..streaming import events, upserts
from . import ingest
from .registry import ORACLE_SQL, query

CODED = """coded as (select event_id, 'S' || (event_id % 300)::varchar as scene_id, case event_id % 4 when 0 then 'landsat-5' when 1 then 'landsat-7' when 2 then 'sentinel-2' else 'zeppelin' end as sensor from events)"""


def _stream(spark: SparkSession, d: str) -> DataFrame:
    return spark.readStream.schema(read(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)


def _envelopes(rows: DataFrame) -> DataFrame:
    """Push envelopes; a quarter names an unknown sensor. They are parsed row by row, so a file of one split is dealt to all cores."""
    rows, key = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism), F.col("event_id")
    sensor = pick(F.pmod(key, F.lit(4)), "landsat-5", "landsat-7", "sentinel-2", "zeppelin")
    body = F.to_json(F.struct(F.concat(F.lit("S"), (key % 300).cast("string")).alias("scene_id"), sensor.alias("sensor"), F.lit("2000-01-01").alias("acquisition_date")))
    return rows.select(F.struct(F.base64(body.cast("binary")).alias("data"), key.cast("string").alias("messageId"), F.lit(None).cast("string").alias("publishTime")).alias("message"), F.lit("s").alias("subscription"))


def _run(out: DataFrame, mode: str, path: str) -> None:
    """Runs a stream until all input is read; its rows are added below path, where its checkpoint is as well."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{path}/rows")

    out.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()


def _drained(out: DataFrame, mode: str = "append") -> DataFrame:
    """All rows that a stream yields, by way of the shared folder."""
    path = shared_path(out.sparkSession, "stream")
    _run(out, mode, path)
    return out.sparkSession.read.schema(out.schema).parquet(f"{path}/rows")


@query(f"with {CODED} select event_id::varchar as message_id, scene_id, sensor, case when sensor = 'zeppelin' then 'sensor' end as error from coded")
def stream_scene_events(spark, d):
    return _drained(events.parsed(_envelopes(_stream(spark, d)))).select("message_id", "scene_id", "sensor", "error")


@query(
    f"""with {CODED} select event_id::varchar as message_id, scene_id, task, md5(scene_id || ':' || task || ':{{}}') as product_id
    from coded, (values ('water_mask'), ('trend')) t(task) where sensor <> 'zeppelin'"""
)
def stream_task_fanout(spark, d):
    fanned = events.fan_out(events.accepted(_envelopes(_stream(spark, d))), ["water_mask", "trend"])
    return _drained(fanned).select("message_id", "scene_id", "task", "product_id")


@query("select time_bucket(interval 6 hours, ts) as start, event_type, count(*) as n from events group by all")
def stream_windowed_counts(spark, d):
    """Tumbling windows with a watermark; complete mode gives them all."""
    counted = events.windowed_counts(_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp")), window="6 hours")
    return _drained(counted, "complete").select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def _in_batches(rows: DataFrame, part: Column, parts: int, changes: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All change rows of a stream that gets rows in batches by the number in part: it is started anew from its checkpoint for each, which may be of any number of files."""
    spark = rows.sparkSession
    folder, path = shared_path(spark, "log"), shared_path(spark, "stream")
    for i in range(parts):
        rows.where(part == i).write.mode("append").parquet(folder)
        out = changes(spark.readStream.schema(rows.schema).parquet(folder))
        _run(out, "update", path)
    return spark.read.schema(out.schema).parquet(f"{path}/rows")


@query(ORACLE_SQL["scene_upsert_replay"])
def stream_scene_upserts(spark, d):
    """The upserts of scene_upsert_replay in three batches by line: the last change of each scene is its state."""
    changes = _in_batches(ingest._log(spark, d), F.least(F.floor((F.floor(F.col("seq") / 100_000_000_000) - 1) / 3), F.lit(2)), 3, upserts.scene_changes)
    last = changes.groupBy("scene_id").agg(F.max_by(F.struct("sensor", "acquisition_date", "file_hash", "status", "version_no"), "seq").alias("s"))
    return last.select("scene_id", "s.*")


@query(ORACLE_SQL["run_log_latest"])
def stream_run_states(spark, d):
    """The events of run_log_latest in four batches that are not in order: the last change of each run is its state."""
    log = ingest.run_log(spark, d)
    changes = _in_batches(log, F.pmod(F.floor(F.col("seq") / 1000) * 3, F.lit(4)), 4, upserts.run_changes)
    last = changes.groupBy("product_id").agg(F.max_by(F.struct("status", F.col("output_paths").alias("last_seq"), "error_message"), "seq").alias("s"))
    return last.select("product_id", "s.*")
