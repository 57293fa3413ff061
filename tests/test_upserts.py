"""Stateful upserts, runs and claims: batches against the replay of the whole log, repeats and late events."""

import pytest
from pyspark.sql import functions as F

from brackwater.operators import ingest
from brackwater.streaming import events, upserts

SCENE = "scene_id string, sensor string, file_hash string, seq long"
EVENT = "product_id string, base_scene_id string, task string, parameters string, status string, at timestamp, output_paths array<string>, error_message string, seq long"


def drained(spark, tmp_path, batches, schema, changes):
    """Change rows by batch, the stream being restarted for each from its checkpoint."""
    out = []
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        got = []
        stream = changes(spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(str(tmp_path / "log")))
        stream.writeStream.foreachBatch(lambda df, _, got=got: got.extend(df.collect())).outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        out.append(got)
    return out


def test_versions_over_restarts_equal_the_replay(spark, tmp_path):
    batches = [
        [("a", "s1", "x", 2), ("a", "s0", "x", 1), ("b", "s0", None, 1), (None, "s", "x", 9)],
        [("a", "s2", "y", 3), ("a", "s2", "z", 4), ("b", "s1", "q", 2)],
        [("a", "s2", "z", 4), ("a", "s9", "late", 2), ("b", "s1", "r", 3)],
    ]
    changed = drained(spark, tmp_path, batches, SCENE, upserts.scene_changes)
    assert [sorted((r.scene_id, r.version_no, r.applied, r.late) for r in rows) for rows in changed] == [[("a", 1, 2, 0), ("b", 1, 1, 0)], [("a", 3, 2, 0), ("b", 1, 1, 0)], [("a", 3, 0, 2), ("b", 2, 1, 0)]]
    log = spark.createDataFrame(batches[0][:3] + batches[1] + batches[2][2:], SCENE)
    want = {r.scene_id: (r.sensor, r.file_hash, r.version_no) for r in ingest.replay_scenes(log).collect()}
    assert {r.scene_id: (r.sensor, r.file_hash, r.version_no) for rows in changed for r in sorted(rows, key=lambda r: r.seq)} == want


def test_upserts_of_one_order_and_odd_rows(spark, tmp_path):
    """The first of one order counts, the others are late; nulls, lists and days come out as they went in; rows of no scene or order are left out."""
    import datetime as dt

    schema = "scene_id string, acquisition_date date, band_count int, minx double, file_locations array<string>, file_hash string, ingest_timestamp timestamp, seq long"
    day, at = dt.date(2000, 1, 31), dt.datetime(2020, 1, 1, 12)
    batches = [
        [("a", day, 6, 1.5, ["x", None], "h", at, 3), ("a", None, 7, None, ["late"], "i", None, 3), ("", None, None, None, None, None, None, -1), (None, day, 6, 1.5, [], "h", at, 1), ("b", day, 6, 1.5, [], "h", at, None)],
        [("a", None, 8, 2.5, [], None, None, 4), ("", day, 9, 0.0, None, "h", at, -1), ("a", None, 8, 2.5, ["y"], "j", at, 5), ("a", None, 8, 2.5, ["z"], "k", at, 5)],
    ]
    changed = drained(spark, tmp_path, batches, schema, upserts.scene_changes)
    assert [sorted(map(tuple, rows)) for rows in changed] == [
        [("", None, None, None, None, None, None, "active", 1, -1, 1, 0), ("a", day, 6, 1.5, ["x", None], "h", at, "active", 1, 3, 1, 1)],
        [("", None, None, None, None, None, None, "active", 1, -1, 0, 1), ("a", day, 6, 1.5, ["y"], "j", at, "active", 1, 5, 2, 1)],
    ]
    assert changed[0][0].__fields__ == ["scene_id", "acquisition_date", "band_count", "minx", "file_locations", "file_hash", "ingest_timestamp", "status", "version_no", "seq", "applied", "late"]


def test_runs_in_any_order_of_arrival(spark, tmp_path):
    import datetime as dt

    day = lambda i: dt.datetime(2020, 1, i)
    batches = [
        [("p", "s", "t", "{}", "complete", day(3), ["x"], None, 3), ("q", "s", "t", "{}", "running", day(2), None, None, 2)],
        [("p", "s0", "t", "{}", "not_started", day(1), None, None, 1), ("q", "s", "t", "{}", "failed", day(4), None, "boom", 4)],
    ]
    changed = drained(spark, tmp_path, batches, EVENT, upserts.run_changes)
    want = {r.product_id: r.asDict() for r in ingest.replay_runs(spark.createDataFrame(batches[0] + batches[1], EVENT)).collect()}
    got = {r.product_id: {k: v for k, v in r.asDict().items() if k != "seq"} for rows in changed for r in rows}
    assert got == want


def test_run_events_of_one_order_and_odd_rows(spark, tmp_path):
    """The first to come counts, in a batch and over batches; no event of a null run or order counts, nulls in others do."""
    batches = [
        [("p", "s1", "t", "{}", "running", None, ["x"], "a", 5), ("p", "s2", "u", None, "failed", None, None, "b", 5), (None, "s", "t", "{}", "failed", None, None, None, 1), ("p", "s", "t", "{}", "failed", None, None, None, None)],
        [("p", "s3", "v", "{}", "complete", None, None, "c", 5), ("q", None, None, None, None, None, None, None, -1), ("q", "s", "t", "{}", "complete", None, ["y"], None, -1)],
        [("p", "s4", "w", "{}", "complete", None, ["z"], "d", 6), ("p", "s5", "w", "{}", "failed", None, None, "e", 6), ("p", "s6", None, "{}", "failed", None, None, "e", 4), ("p", "s7", "w", "{}", "failed", None, None, "e", 4)],
    ]
    changed = drained(spark, tmp_path, batches, EVENT, upserts.run_changes)
    kept = lambda r: (r.product_id, r.base_scene_id, r.task, r.parameters, r.status, r.output_paths, r.error_message, r.seq)
    p, q = ("p", "s1", "t", "{}", "running", ["x"], "a", 5), ("q", None, None, None, None, None, None, -1)
    assert [sorted(map(kept, rows)) for rows in changed] == [[p], [p, q], [("p", "s6", None, "{}", "complete", ["z"], "d", 6)]]


def message(i, scene, sensor="landsat-7"):
    import base64
    import json

    body = base64.b64encode(json.dumps({"scene_id": scene, "sensor": sensor, "acquisition_date": "2000-01-01"}).encode()).decode()
    return json.dumps({"message": {"data": body, "messageId": str(i), "publishTime": "t"}, "subscription": "s"})


def test_runs_are_claimed_once_and_again_after_failure(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "log")
    folder.mkdir()
    broken = {"B"}

    def task(df):
        return df.withColumn("status", F.when(F.col("scene_id").isin(*broken) if broken else F.lit(False), "failed").otherwise("complete"))

    def turn(*messages):
        (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(messages))
        events.run_incremental(events.message_stream(spark, str(folder)), {"water_mask": task, "trend": task}, out, str(tmp_path / "state"), str(tmp_path / "dead")).awaitTermination()
        return sorted((r.scene_id, r.task, r.status) for r in spark.read.parquet(out).collect())

    first = turn(message(1, "A"), message(2, "A"), message(3, "B"), message(4, "C", "zeppelin"))
    assert first == sorted((s, t, x) for s, last in (("A", "complete"), ("B", "failed")) for t in ("water_mask", "trend") for x in ("not_started", last))
    assert spark.read.json(str(tmp_path / "dead")).count() == 1
    broken.clear()
    again = turn(message(5, "A"), message(6, "B"))
    assert len(again) == len(first) + 4 and again.count(("B", "trend", "complete")) == 1 and again.count(("A", "trend", "complete")) == 1
    assert turn(message(7, "B")) == again


def test_log_order_is_needed(spark):
    with pytest.raises(Exception, match="seq"):
        upserts.scene_changes(spark.createDataFrame([("a", "x")], "scene_id string, file_hash string"))
