"""Upserts and runs as stateful streams (SNK1, SNK4, SNK5, ST4, ST5): what a key's past decides is kept in the state store.

A batch costs what it brings: a scene's version and last hash, a run's last status and its start are read
from the state of the keys that have rows, and the history is not read again. Change rows go out; the last
one of a key is its current state, and equals the replay of the whole log in operators.ingest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import itemgetter
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State of several values a key needs the store that keeps it on disk.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State grows with the keys ever seen, so it belongs on the executors' disks, not in their heaps. For streams started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def _fields(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([schema[n] for n in names if n in schema.names])


#: Groups that scenes are dealt into by a hash. Python is called and state is read once for a group and batch, not for every scene.
GROUPS = 1 << 12


class SceneVersions(StatefulProcessor):
    """The upserts of a group of scenes, in order within a batch, onto their state. They come as lists of scenes, orders, first and last fields; a group's changes go out as one row."""

    def __init__(self, first: T.StructType, last: T.StructType):
        self.first, self.last = first, last

    def init(self, handle: StatefulProcessorHandle) -> None:
        scene = T.StructType([T.StructField("scene_id", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("version", T.LongType()), *self.first.fields, *self.last.fields])
        self.state = handle.getValueState("scenes", T.StructType([T.StructField("scenes", T.ArrayType(scene))]))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        found = self.state.get()
        states = {scene[0]: list(scene[1:]) for scene in found[0]} if found else {}
        firsts, hash_at = len(self.first), len(self.first) + self.last.names.index("file_hash")
        counts: dict[str, list[int]] = {}
        for scene, seq, *fields in sorted((row for lists in rows for row in zip(*lists[1:], strict=True)), key=itemgetter(1)):
            state, count = states.get(scene), counts.setdefault(scene, [0, 0])
            if state is None:
                states[scene] = [seq, 1, *fields]
            elif seq <= state[0]:
                count[1] += 1
                continue
            else:
                before, now = state[2 + hash_at], fields[hash_at]
                state[0], state[1] = seq, state[1] + (before is not None and now is not None and before != now)
                state[2 + firsts :] = fields[firsts:]
            count[0] += 1
        if any(applied for applied, _ in counts.values()):
            self.state.update(([(scene, *state) for scene, state in states.items()],))
        yield Row("changes")([(scene, *states[scene][2:], "active", int(states[scene][1]), int(states[scene][0]), applied, late) for scene, (applied, late) in counts.items()])

    def close(self) -> None:
        pass


#: Bytes of rows that a task holds at a time to deal with them together.
HELD = 8 << 20


def _held(batches: Iterator) -> Iterator:
    """Arrow batches as tables of about HELD bytes."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        held, size = [*held, batch], size + batch.nbytes
        if size >= HELD:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _listed(batches: Iterator) -> Iterator:
    """Rows as one list for each group and column, in their order: Python then takes a group's lists apart and not each value of each row on its own."""
    import pyarrow as pa

    for rows in _held(batches):
        table = rows.take(pa.array(np.argsort(rows["_group"].to_numpy(), kind="stable")))
        groups, starts = np.unique(table["_group"].to_numpy(), return_index=True)
        ends = pa.array([*starts, len(table)], pa.int32())
        columns = [pa.ListArray.from_arrays(ends, pa.concat_arrays(c.chunks)) for c in table.columns[1:]]
        yield pa.RecordBatch.from_arrays([pa.array(groups), *columns], table.column_names)


def scene_changes(log: DataFrame, order: str = "seq", groups: int = GROUPS) -> DataFrame:
    """A stream of upserts to a stream of changed scenes (SNK1): as ingest.replay_scenes(), with seq (the last event applied), applied and late.

    The first upsert sets place, date, sensor, bands and crs, the last one files, hash and ingest time; the version
    grows at every hash that differs from the one before, unless one of them is null. Upserts of a scene must come in
    order over batches; within a batch they are sorted. One that is not behind the last applied is a repeat or late:
    it changes nothing and is counted in late. Scenes are dealt into groups by a hash; a batch holds a group's rows of that batch
    and the state of its scenes at a time, so bound a batch by files per trigger. The number of groups must stay as it is
    for a checkpoint. A null order or scene_id is refused by leaving the row out.
    """
    keep_state_on_disk(log.sparkSession)
    rows = log.where(F.col("scene_id").isNotNull() & F.col(order).isNotNull()).withColumn(order, F.col(order).cast("long"))
    first = _fields(rows.schema, "sensor", "acquisition_date", "band_count", "crs", "minx", "miny", "maxx", "maxy")
    last = _fields(rows.schema, "file_locations", "file_hash", "ingest_timestamp")
    out = T.StructType([rows.schema["scene_id"], *first.fields, *last.fields])
    out = out.add("status", "string").add("version_no", "long").add("seq", "long").add("applied", "long").add("late", "long")
    dealt = rows.select(F.pmod(F.xxhash64("scene_id"), F.lit(groups)).alias("_group"), "scene_id", order, *first.names, *last.names)
    listed = dealt.mapInArrow(_listed, T.StructType([T.StructField("_group", T.LongType()), *(T.StructField(f.name, T.ArrayType(f.dataType)) for f in dealt.schema.fields[1:])]))
    changed = listed.groupBy("_group").transformWithState(SceneVersions(first, last), T.StructType([T.StructField("changes", T.ArrayType(out))]), "Update", "None")
    return changed.select(F.inline("changes"))


class RunStates(StatefulProcessor):
    """The events of a run onto its state. Only the first and the last matter, so rows are not held."""

    FIRST, LAST = ("base_scene_id", "task", "parameters"), ("status", "at", "output_paths", "error_message")

    def __init__(self, schema: T.StructType, order: str):
        self.schema, self.order = schema, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", T.StructType([T.StructField("low", T.LongType()), T.StructField("started_at", self.schema["at"].dataType), *_fields(self.schema, *self.FIRST), T.StructField("high", T.LongType()), *_fields(self.schema, *self.LAST)]))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state = self.state.get()
        low, high = (tuple(state[: 2 + len(self.FIRST)]), tuple(state[2 + len(self.FIRST) :])) if state else (None, None)
        for row in rows:
            at = row[self.order]
            if low is None or at < low[0]:
                low = (at, row["at"], *[row[n] for n in self.FIRST])
            if high is None or at > high[0]:
                high = (at, *[row[n] for n in self.LAST])
        self.state.update((*low, *high))
        status, when = high[1], high[2]
        out = ("product_id", *self.FIRST, "started_at", "status", "completed_at", "output_paths", "error_message", "seq")
        yield Row(*out)(key[0], *low[2:], low[1], status, when if status in ("complete", "failed") else None, *high[3:], high[0])

    def close(self) -> None:
        pass


def _ends(order: str) -> Callable[[Iterator], Iterator]:
    """Of the rows held at a time, a run's first and last event; of several of one order, the one that came first. No other row decides anything in RunStates."""

    def kept(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for rows in _held(batches):
            runs = rows.select(["product_id", order]).to_pandas().groupby("product_id", sort=False)[order]
            yield from rows.take(pa.array(sorted({*runs.idxmin(), *runs.idxmax()}), pa.int64())).to_batches()

    return kept


def run_changes(log: DataFrame, order: str = "seq") -> DataFrame:
    """A stream of run events to a stream of changed runs (SNK4, SNK5): as ingest.replay_runs(), with seq, the last event's order.

    The first event by order registers the run, the last one sets status, outputs and error, whatever the order of arrival.
    """
    keep_state_on_disk(log.sparkSession)
    rows = log.where(F.col("product_id").isNotNull() & F.col(order).isNotNull()).withColumn(order, F.col(order).cast("long"))
    s = rows.schema
    rows = rows.select("product_id", order, "at", *RunStates.FIRST, *(n for n in RunStates.LAST if n != "at"))
    out = T.StructType([s["product_id"], *_fields(s, *RunStates.FIRST), T.StructField("started_at", s["at"].dataType), s["status"], T.StructField("completed_at", s["at"].dataType), s["output_paths"], s["error_message"], T.StructField("seq", T.LongType())])
    ends = rows.mapInArrow(_ends(order), rows.schema)  # before the shuffle: a run's other events are not sent
    return ends.groupBy("product_id").transformWithState(RunStates(s, order), out, "Update", "None")


def _foremost(batches: Iterator) -> Iterator:
    """Of each Arrow batch, a run's first request by message_id and its last log row by seq, nulls last: no other row decides anything in Claims."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def first_of_each_run(batch: pa.RecordBatch, rows: pa.Array, column: str, order: str) -> pa.Array:
        rows = rows.take(pc.sort_indices(batch.select([column]).take(rows), [(column, order)]))  # a stable sort
        runs = batch["product_id"].take(rows).dictionary_encode("encode").indices
        return rows.take(pa.array(np.unique(runs, return_index=True)[1]))

    for batch in batches:
        asks = pc.is_null(batch["status"])
        asked = first_of_each_run(batch, pc.indices_nonzero(asks), "message_id", "ascending")
        seen = first_of_each_run(batch, pc.indices_nonzero(pc.invert(asks)), "seq", "descending")
        yield batch.take(pa.array(np.sort(np.concatenate([asked, seen]))))


class Claims(StatefulProcessor):
    """Requests of a run and what became of it: a request goes through unless the run is complete or in someone's hands."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("status", "status string, seq bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = known, seq = self.state.get() or (None, -1)
        request = None
        for row in rows:
            if row["status"] is None:
                request = row if request is None or row["message_id"] < request["message_id"] else request
            elif seq is None or row["seq"] > seq:
                known, seq = row["status"], row["seq"]
        if request is not None and known in (None, "failed"):
            known = "claimed"
            yield request
        if known is not None and (known, seq) != before:
            self.state.update((known, seq))

    def close(self) -> None:
        pass


def claimed(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Requests of runs (product_id, message_id and more) that nobody has in hand and that are not complete, each once.

    log is the stream of their run log (product_id, status, seq). A request claims its run: more requests go
    through only after the log says that it failed. A batch that is repeated after a failure claims from the state
    before it, so nothing is lost.
    """
    keep_state_on_disk(requests.sparkSession)
    asked = requests.withColumns({"status": F.lit(None).cast("string"), "seq": F.lit(None).cast("long")})
    seen = log.where("status in ('complete', 'failed')").select("product_id", "status", "seq")
    both = asked.unionByName(seen, allowMissingColumns=True)
    both = both.mapInArrow(_foremost, both.schema)  # before the shuffle: many requests ask for few runs
    return both.groupBy("product_id").transformWithState(Claims(), both.schema, "Update", "None").select(*requests.columns)
