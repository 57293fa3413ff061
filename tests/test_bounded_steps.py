"""Steps that could grow faster than their input: groups of scenes in state, claims before the shuffle, pixels that stay in place."""

import base64

import pyarrow as pa
from pyspark.sql import functions as F

from brackwater.operators import ingest, metrics
from brackwater.streaming import events, upserts


def test_scenes_of_one_group_share_calls_and_state(spark, tmp_path):
    """Twenty scenes in two groups over two batches: versions, applied and late are each scene's own."""
    first = [(f"s{i}", f"sensor {i}", None if i % 5 == 0 else f"h{i % 3}", i + 100 * k) for i in range(20) for k in (1, 2)]
    second = [(f"s{i}", "other", f"h{i % 4}", 300 + i) for i in range(0, 20, 2)] + [("s1", "late", "x", 1), ("new", "n", None, 1)]
    schema, got = "scene_id string, sensor string, file_hash string, seq long", []
    for rows in (first, second):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "log"))
        stream = upserts.scene_changes(spark.readStream.schema(schema).parquet(str(tmp_path / "log")), groups=2)
        stream.writeStream.foreachBatch(lambda df, _: got.append(df.collect())).outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert [len(rows) for rows in got] == [20, 12]
    assert {(r.applied, r.late) for r in got[0]} == {(2, 0)} and {r.scene_id: (r.applied, r.late) for r in got[1] if r.scene_id in ("s1", "s2", "new")} == {"s1": (0, 1), "s2": (1, 0), "new": (1, 0)}
    want = {r.scene_id: (r.sensor, r.file_hash, r.version_no) for r in ingest.replay_scenes(spark.createDataFrame(first + [r for r in second if r[1] != "late"], schema)).collect()}
    assert {r.scene_id: (r.sensor, r.file_hash, r.version_no) for rows in got for r in sorted(rows, key=lambda r: r.seq)} == want


def test_only_rows_that_decide_a_claim_are_shuffled():
    rows = [("p", None, "2", None), ("p", None, None, None), ("p", None, "1", None), ("q", None, None, None), ("q", None, "9", None), ("p", "failed", "1", 5), ("p", "complete", "1", 2**60), ("p", "failed", "1", 2**60 - 1)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("product_id", "status", "message_id", "seq"), r, strict=True)) for r in rows], pa.schema([("product_id", pa.string()), ("status", pa.string()), ("message_id", pa.string()), ("seq", pa.int64())]))
    (kept,) = upserts._foremost(iter([batch]))
    assert [tuple(r.values()) for r in kept.to_pylist()] == [rows[2], rows[4], rows[6]]


def test_only_the_ends_of_a_run_are_shuffled():
    rows = [("p", 5, "a"), ("q", 7, "b"), ("p", 5, "c"), ("p", 2**60, "d"), ("p", 2**60 - 1, "e"), ("p", 2**60, "f"), (None, 1, "g")]
    batch = pa.RecordBatch.from_pylist([dict(zip(("product_id", "seq", "status"), r, strict=True)) for r in rows], pa.schema([("product_id", pa.string()), ("seq", pa.int64()), ("status", pa.string())]))
    assert [tuple(r.values()) for kept in upserts._ends("seq")(iter([batch, batch.slice(0, 0), batch])) for r in kept.to_pylist()] == [rows[0], rows[1], rows[3]]
    assert sum(len(kept) for kept in upserts._ends("seq")(iter([batch.slice(0, 0)]))) == 0


def test_claims_of_null_runs_and_empty_batches():
    rows = [(None, None, "2", None), ("p", "failed", None, None), (None, None, "1", None), (None, "complete", None, 4), ("p", "complete", "0", None), (None, None, "1", None)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("product_id", "status", "message_id", "seq"), r, strict=True)) for r in rows], pa.schema([("product_id", pa.string()), ("status", pa.string()), ("message_id", pa.string()), ("seq", pa.int64())]))
    kept, none = upserts._foremost(iter([batch, batch.slice(0, 0)]))
    assert [tuple(r.values()) for r in kept.to_pylist()] == [rows[1], rows[2], rows[3]] and none.num_rows == 0


def test_envelopes_are_parsed_once_and_where_they_were_dealt(spark):
    sent = spark.range(8).repartition(3).select(F.struct(F.col("id").cast("string").alias("data"), F.col("id").cast("string").alias("messageId")).alias("message"))
    plan = events.accepted(sent)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.index("Filter") < plan.index("from_json(") < plan.index("Repartition")


def test_envelopes_with_nulls_are_rows_still(spark):
    body = lambda text: base64.b64encode(text.encode()).decode()
    sent = [None, (None, "1"), ("", "2"), ("***", "3"), (body("{}"), "4"), (body("null"), "5"), (body("[1"), "6"), (body('{"scene_id": "A", "sensor": "LANDSAT-7"}'), None), (body('{"scene_id": "A", "sensor": null}'), "8")] + [(body('{"scene_id": "A", "sensor": "zeppelin"}'), "9")] * 2
    found = events.parsed(spark.createDataFrame([(m,) for m in sent], "message struct<data:string,messageId:string>")).collect()
    want = [(None, "envelope"), ("1", "envelope"), ("2", "payload"), ("3", "payload"), ("4", "keys"), ("5", "keys"), ("6", "keys"), (None, None), ("8", "keys"), ("9", "sensor"), ("9", "sensor")]
    assert [(r.message_id, r.error) for r in found] == want and found[7].sensor == "landsat-7" and found[7].acquisition_date is None


def test_rows_of_a_group_travel_as_lists(monkeypatch):
    """In their order, whatever the columns hold; tasks hold a bounded number of bytes."""
    monkeypatch.setattr(upserts, "HELD", 1)
    rows = [(2, "a", ["x", None], 1), (1, "b", None, 2), (2, None, [], 3), (1, "b", ["y"], None), (3, "c", None, 5), (1, "d", None, 6)]
    names = ("_group", "scene_id", "file_locations", "seq")
    table = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema([("_group", pa.int64()), ("scene_id", pa.string()), ("file_locations", pa.list_(pa.string())), ("seq", pa.int64())]))
    got = [[tuple(r.values()) for r in b.to_pylist()] for b in upserts._listed(iter(table.to_batches(max_chunksize=4)))]
    assert got == [[(1, ["b", "b"], [None, ["y"]], [2, None]), (2, ["a", None], [["x", None], []], [1, 3])], [(1, ["d"], [None], [6]), (3, ["c"], [None], [5])]]
    monkeypatch.setattr(upserts, "HELD", 1 << 20)
    assert [b.num_rows for b in upserts._listed(iter(table.to_batches(max_chunksize=2)))] == [3]
    empty = pa.RecordBatch.from_pylist([], table.schema)
    assert [b.num_rows for b in upserts._listed(iter([empty]))] in ([], [0])


def test_stretched_pixels_are_not_shuffled_by_group(spark):
    pixels = spark.range(1000).select(F.when(F.col("id") % 3 != 0, "a").otherwise("b").alias("scene"), F.col("id").alias("red"))
    out = metrics.percentile_stretch(pixels, ("red",))
    assert out.count() == 1000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
