"""State of the live operators over several batches."""

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Row

from tidemark.streaming import live


def batches(spark, folder, schema, *parts):
    """A stream that takes one part after the other."""
    for i, rows in enumerate(parts):
        out = f"{folder}/{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(out)
        for name in os.listdir(out):
            os.utime(f"{out}/{name}", (1_700_000_000 + 100 * i,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def test_relay_takes_late_rows_in_their_place(spark, tmp_path):
    parts = [
        [(1, "2024-01-01 10:00:00", 1, "Closed relay to A1 and B1"), (1, "2024-01-01 10:00:40", 4, "7"), (2, "2024-01-01 10:00:01", 1, None)],
        [(1, "2024-01-01 10:00:20", 2, "Opened relay"), (1, "2024-01-01 10:00:30", 3, "5"), (1, "2024-01-01 10:00:50", 5, "Closed relay to A2 and B1"), (1, "2024-01-01 10:00:55", 6, " 9 "), (1, "2024-01-01 10:10:00", 7, "3")],
        [(1, "2024-01-01 12:00:00", 8, "4"), (3, "2024-01-01 11:00:00", 1, "4")],
        [(3, "2024-03-01 12:00:00", 2, "note")],
        [(1, "2024-03-01 12:10:00", 9, "6"), (3, "2024-03-02 12:00:00", 3, "note")],
    ]
    rows = batches(spark, tmp_path, "rec long, ts string, seq long, text string", *parts).selectExpr("rec", "cast(ts as timestamp) as ts", "seq", "text")
    out = sorted(tuple(r) for r in live.finished(live.relay_stream(rows)).collect())
    assert out == [(1, 6, "A2-B1", "9"), (1, 7, "A2-B1", "3"), (1, 8, "A2-B1", "4")]  # the pair is forgotten after 30 days


def test_ready_files_over_batches(spark, tmp_path):
    t = 1_704_067_200
    parts = [
        [("a", 5, t, t), ("a", 5, t + 100, t), ("b", 1, t, t), ("young", 1, t, t), ("done", 1, t, t - 900)],
        [("a", 5, t + 200, t), ("b", 2, t + 90, t + 80), ("young", 1, t + 90, t + 70), ("done", 1, t + 99, t - 900)],
        [("b", 2, t + 300, t + 80)],
        [("c", 1, t + 4000, t)],
        [("a", 5, t + 5000, t)],
        [("a", 5, t + 5100, t), ("a", 5, t + 5100, t)],
    ]
    listing = batches(spark, tmp_path, "path string, size long, at long, modified long", *parts)
    marked = spark.createDataFrame([("done",)], "path string")
    out = sorted(tuple(r) for r in live.finished(live.ready_files(listing, 50, 60, marked, forget_s=1000, late="200 seconds")).collect())
    assert out == [("a", 5, t + 100), ("a", 5, t + 5100), ("b", 2, t + 300)]


def test_rescan_takes_a_folder_once(spark, tmp_path):
    parts = [[("x",), ("y",), ("x",)], [("x",), ("z",), (None,)]]
    known = spark.createDataFrame([("y",)], "path string")
    out = live.finished(live.rescan(batches(spark, tmp_path, "path string", *parts), known)).collect()
    assert sorted(str(r.path) for r in out) == ["None", "x", "z"]


def test_stall_states_over_batches(spark, tmp_path):
    mb = 1 << 20
    clock = "2024-01-01 10:{:02d}:{:02d}".format
    parts = [
        [("a.edf", clock(0, 0), 0), ("a.edf", clock(0, 15), 5 * mb), ("b.edf", clock(0, 0), 9), ("c.edf", clock(0, 0), 1)],
        [("a.edf", clock(0, 45), 6 * mb), ("a.edf", clock(0, 30), 6 * mb), ("b.edf", clock(0, 20), 9), ("c(1).edf", clock(0, 30), 1)],  # a's two samples come in the wrong order
        [("a.edf", clock(1, 15), 6 * mb), ("a.edf", clock(1, 0), 6 * mb), ("c.edf", clock(2, 0), 1), ("C(12).EDF", clock(0, 40), 1)],
        [("a.edf", clock(1, 30), 6 * mb), ("a.edf", clock(1, 45), 20 * mb), ("a.edf", clock(2, 45), 20 * mb), ("b.edf", clock(1, 0), 9)],
        [("z.edf", clock(30, 0), 0)],
        [("z.edf", clock(40, 0), 0)],
    ]
    rows = batches(spark, tmp_path, "file string, ts string, size long", *parts).selectExpr("file", "cast(ts as timestamp) as ts", "size")
    out = sorted((r.file, r.us // 1_000_000 % 3600, r.state, r.quiet_s) for r in live.finished(live.stall_states(rows)).collect())
    assert [x for x in out if x[0] == "a.edf"] == [("a.edf", 75, "stalled", 60.0), ("a.edf", 105, "growing", 0.0), ("a.edf", 165, "stalled", 60.0)]
    assert ("b.edf", 60, "stalled", 60.0) in out and ("c.edf", 30, "replicated", 0.0) in out and ("C.EDF", 40, "replicated", 0.0) in out and not any(x[0] == "c.edf" and x[2] == "stalled" for x in out)


def test_state_goes_on_from_a_checkpoint(spark, tmp_path):
    """A stream that ends and starts again from its checkpoint finds the rows that wait and the open pair."""
    schema = "rec long, ts string, seq long, text string"
    folder, state, out = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "out")
    parts = [
        [(1, "2024-01-01 10:00:00", 1, "Closed relay to A1 and B1"), (1, "2024-01-01 10:00:40", 3, "7")],
        [(1, "2024-01-01 10:00:20", 2, "5"), (1, "2024-01-01 10:05:00", 4, "9"), (1, "2024-01-01 10:05:00", 4, "9")],
        [(1, "2024-01-01 11:00:00", 5, "x")],
    ]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder).selectExpr("rec", "cast(ts as timestamp) as ts", "seq", "text")
        live.relay_stream(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.seq, r.current) for r in spark.read.parquet(out).collect()) == [(2, "5"), (3, "7"), (4, "9"), (4, "9")]


def test_rows_that_wait_cost_no_call_each():
    class Kept:
        calls, value = 0, None

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.value, self.calls = value, self.calls + 1

        def clear(self):
            self.value = None

    class Rows(Kept):
        def get(self):
            self.calls += 1
            return iter(self.value or [])

        def appendList(self, rows):
            self.value, self.calls = [*(self.value or []), *rows], self.calls + 1

    class Handle:
        kept, rows, timers = Kept(), Rows(), set()
        getValueState = lambda self, *a: self.kept
        getListState = lambda self, *a: self.rows
        registerTimer = lambda self, t: self.timers.add(t)
        deleteTimer = lambda self, t: self.timers.discard(t)

    class Mark:
        getCurrentWatermarkInMs = lambda self: 4_000

    handle, relay = Handle(), live.Relay(86400)
    relay.init(handle)
    rows = [Row(us=k * 1000, place=k, text="Closed relay to A1 and B1" if k == 0 else str(k)) for k in range(5000)]
    list(relay.handleInputRows((1,), iter(reversed(rows)), Mark()))
    out = list(relay.handleExpiredTimer((1,), Mark(), None))
    assert [r.seq for r in out] == list(range(1, 4000)) and {r.pair for r in out} == {"A1-B1"}
    assert len(handle.rows.value) == 1000 and max(handle.timers) == 4001 and handle.rows.calls + handle.kept.calls < 20


class OneKey:
    """The state of a key, with the calls that it cost."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def getValueState(self, *a):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


class Entries:
    def __init__(self):
        self.calls, self.entries = 0, {}

    def keys(self):
        self.calls += 1
        return iter(self.entries)

    def getValue(self, key):
        self.calls += 1
        return self.entries[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.entries[key] = value

    def clear(self):
        self.calls, self.entries = self.calls + 1, {}


def test_samples_come_and_wait_in_packs():
    """A file's samples cost its task no row each (F3 of round 4: 36 million samples of 20 files)."""
    second, n = 1_000_000, 100_000
    us = np.random.default_rng(1).permutation(n) * second
    sizes = np.where(us < 50_000 * second, us // second, 50_000)  # a byte a second, then none
    batch = lambda a, b: pa.RecordBatch.from_pydict({"base": pa.array(["b.edf" if u % (2 * second) else "a.edf" for u in us[a:b].tolist()]), "us": pa.array(us[a:b]), "size": pa.array(sizes[a:b]), "own": pa.array([True] * (b - a))})
    rows = [r for at in range(0, n, 10_000) for part in live.packs([batch(at, at + 10_000)]) for r in part.to_pylist()]
    assert len(rows) == 20 and sum(len(r["samples"]) for r in rows) == n * live.SAMPLE.itemsize
    mine = [Row(**r) for r in rows if r["base"] == "a.edf"]
    assert max(r.last for r in mine) == (n - 2) * second

    class Mark:
        getCurrentWatermarkInMs = lambda self: 90_000_000

    handle, stall, waits = OneKey(), live.Stall(86400 * 9, 0.5, 60.0), Entries()
    handle.getMapState = lambda *a: waits
    stall.init(handle)
    list(stall.handleInputRows(("a.edf",), iter(mine), Mark()))
    assert len(waits.entries) < 10
    out = list(stall.handleExpiredTimer(("a.edf",), Mark(), None))
    assert [(r.us // second, r.state, r.quiet_s, r.size) for r in out] == [(50_060, "stalled", 60.0, 50_000)]
    assert sum(len(e[0]) for e in waits.entries.values()) == 5_000 * live.SAMPLE.itemsize and 90_000_001 in handle.timers
    assert handle.calls + waits.calls < 30
    before = dict(waits.entries)
    late = next(live.packs([pa.RecordBatch.from_pydict({"base": ["a.edf"], "us": [5 * second], "size": [1], "own": [True]})])).to_pylist()
    list(stall.handleInputRows(("a.edf",), iter([Row(**r) for r in late]), Mark()))
    assert waits.entries == before  # its place has passed


def test_stalls_with_late_samples_and_unknown_sizes(spark, tmp_path):
    clock = "2024-01-01 10:{:02d}:{:02d}".format
    parts = [
        [("a.edf", clock(0, 0), 5), ("a.edf", clock(0, 30), 5), ("u.edf", clock(0, 0), 5), ("u.edf", clock(0, 30), None), ("u.edf", clock(1, 0), 5), (None, clock(0, 0), 1)],
        [("a.edf", clock(5, 0), 6)],
        [("a.edf", clock(6, 0), 6), ("v(2).edf", clock(6, 0), None), ("v.edf", clock(5, 30), 3), ("v.edf", None, 3)],
        [("a.edf", "2024-01-01 09:59:30", 0), ("a.edf", clock(7, 0), 6)],  # the first comes too late, in one pack with the other
        [("z.edf", clock(30, 0), 0)],
        [("z.edf", clock(40, 0), 0)],
    ]
    rows = batches(spark, tmp_path, "file string, ts string, size long", *parts).selectExpr("file", "cast(ts as timestamp) as ts", "size")
    out = sorted((r.file, r.us // 1_000_000 % 3600, r.state, r.quiet_s, r.size) for r in live.finished(live.stall_states(rows, 1.0, 60.0)).collect())
    assert out == [("a.edf", 300, "stalled", 300.0, 6), ("v.edf", 360, "replicated", 0.0, 3)]
