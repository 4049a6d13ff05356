"""Live forms of the operators: file readiness, stalls, event cleaning, coverage, relay state, bursts.

Sources are file streams of the given tables; time is event time with watermarks. Every stream runs with a checkpoint
in the shared folder and an availableNow trigger, so that it takes what is there and ends; a service uses the
same transformations with another trigger.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, ListState, MapState, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions import phi
from tidemark.sources.shared import new_folder


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream; timestamps get a zone, which watermarks want."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    df = spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")  # a pattern: the table may be one file or a folder of them
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


#: Entries of maps and timers need a store that has them one by one.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def finished(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now into a new table of the shared folder, and read that.

    Other modes than append give each batch's rows; the last batch that wrote a key holds its final value."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    out, state = new_folder(spark, "stream"), new_folder(spark, "stream-state")
    if mode == "append":
        query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    else:

        def put(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/b{number}")  # the same place when a batch is tried again

        query = df.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    if mode == "append":
        return spark.read.schema(df.schema).parquet(out)
    return spark.read.option("recursiveFileLookup", "true").schema(StructType([*df.schema.fields, StructField("batch", IntegerType())])).parquet(out)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last batch's row of each key of an update stream."""
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in values])


def day_coverage(events: DataFrame) -> DataFrame:
    """R5. Events and hours of each subject and day, as an update stream over tumbling days."""
    w = events.withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 day"), "user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("hours"))
    return w.select(F.col("user_id").alias("subject"), F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n", "hours")


def clean_events(events: DataFrame) -> DataFrame:
    """R4. Events with their text redacted, each (subject, kind, value) once within the watermark's hour."""
    text = phi.redact(F.concat_ws(" ", "event_type", "props"))
    rows = events.select(F.col("user_id").alias("subject"), "ts", text.alias("text"))
    return rows.withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["subject", "text"]).select("subject", "text")


def event_sessions(events: DataFrame, gap: str = "6 hours") -> DataFrame:
    """R7. Bursts of a subject's events that pauses longer than gap part. Closed ones come out."""
    w = events.withWatermark("ts", "1 minute").groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return w.select(F.col("user_id").alias("subject"), F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start"), "n")


def stalls(sizes: DataFrame, least: float, window: str = "6 hours", slide: str = "3 hours") -> DataFrame:
    """R3 by windows. Sliding windows in which a file grew by less than least: file, start, grown. sizes: ts, file, size."""
    w = sizes.withWatermark("ts", "1 minute").groupBy(F.window("ts", window, slide), "file").agg((F.max("size") - F.min("size")).alias("grown"))
    return w.filter(F.col("grown") < least).select("file", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), F.round("grown", 6).alias("grown"))


class Readiness(StatefulProcessor):
    """The last size of a path, when it changed, whether it was told, the last listing; a timer drops a path that isn't listed any more."""

    def __init__(self, quiet_s: int, least_age_s: int, forget_s: int):
        self.quiet_s, self.least_age_s, self.forget_s = quiet_s, least_age_s, forget_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "size long, since long, told boolean, last long")

    def expiry(self, last: int) -> int:
        return (last + self.forget_s) * 1000

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        size, since, told, last = self.kept.get() or (None, None, False, None)
        timer = last
        for at, now, modified in sorted((r.at, r.size, r.modified) for r in rows):
            if now != size or at - last > self.forget_s:
                size, since, told = now, at, False
            elif at - since >= self.quiet_s and at - modified >= self.least_age_s and not told:
                told = True
                yield Row(path=key[0], size=now, at=at)
            last = at
        self.kept.update((size, since, told, last))
        if timer != last:
            if timer is not None:
                self.handle.deleteTimer(self.expiry(timer))
            self.handle.registerTimer(self.expiry(last))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.kept.clear()
        return iter(())


def ready_files(listing: DataFrame, quiet_s: int, least_age_s: int = 0, marked: DataFrame | None = None, forget_s: int = 86400, late: str = "1 hour") -> DataFrame:
    """R2. Paths whose size stayed the same for quiet_s or more, in a listing at which they were least_age_s old or more: path, size, at; once for each size that they come to.

    listing: path, size, at, modified (epoch seconds). marked: a table of paths that are done with. A path that isn't listed for forget_s starts anew, and its
    state is dropped."""
    if marked is not None:
        listing = listing.join(marked.select("path"), "path", "left_anti")
    rows = listing.select("path", "size", "at", "modified", F.timestamp_seconds("at").alias("ts")).withWatermark("ts", late)
    return rows.groupBy("path").transformWithState(Readiness(quiet_s, least_age_s, forget_s), "path string, size long, at long", "append", "EventTime")


#: Rows that go to a key's list at a time.
PIECE = 1000


class InOrder(StatefulProcessor):
    """Takes a key's rows in the order of (us, place), whatever batches bring them: rows wait in a list until the watermark has passed them.

    One timer stands for the earliest row that waits, else for when the key is forgotten (forget_s after its last row). start: the state of a new or forgotten key; state:
    its fields; fields: what a row carries besides us and place. step() gives the next state and the rows that come out."""

    start: tuple = ()
    state = ""
    fields: tuple[str, ...] = ()
    field_types = ""

    def __init__(self, forget_s: int):
        self.forget_s = forget_s

    def step(self, key: tuple, state: tuple, us: int, place: int, values: tuple) -> tuple[tuple, list[Row]]:
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = self.waiting_rows(handle)
        # n: rows so far, so that equal ones stay apart; timer: for when it is set; last: the time of the last row that was taken
        self.kept = handle.getValueState("kept", f"n long, timer long, last long, {self.state}")

    def waiting_rows(self, handle: StatefulProcessorHandle) -> ListState | MapState:
        # a list, as a call for each row would cost more than the row
        return handle.getListState("rows", f"us long, place long, n long, {self.field_types}")

    def hold(self, rows: Iterator[Row], n: int, last: int | None) -> tuple[int, int | None]:
        """Puts rows to those that wait; the new n, and when the first of them is due."""
        due, held = None, []
        for r in rows:
            held.append((r.us, r.place, n, *(r[f] for f in self.fields)))
            n += 1
            due = r.us // 1000 + 1 if due is None else min(due, r.us // 1000 + 1)
            if len(held) >= PIECE:
                self.waiting.appendList(held)
                held = []
        if held:
            self.waiting.appendList(held)
        return n, due

    def take(self, mark: int) -> tuple[Iterable[tuple], int | None]:
        """Takes the rows before mark from those that wait: us, place and fields in order, and when the first of the others is due."""
        waiting = [tuple(w) for w in self.waiting.get()]
        due = sorted((w for w in waiting if w[0] // 1000 < mark), key=lambda w: w[:3])
        left = [w for w in waiting if w[0] // 1000 >= mark]
        if due:
            self.waiting.clear()
            for at in range(0, len(left), PIECE):
                self.waiting.appendList(left[at : at + PIECE])
        return ((us, place, *values) for us, place, _, *values in due), min((w[0] // 1000 + 1 for w in left), default=None)

    def set_timer(self, old: int | None, new: int) -> int:
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)
        return new

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        n, timer, last, *state = self.kept.get() or (0, None, None, *self.start)
        n, due = self.hold(rows, n, last)
        if due is not None:
            forgets = last is not None and timer == self.forgotten(last)
            timer = self.set_timer(timer, due if timer is None or forgets else min(timer, due))
            self.kept.update((n, timer, last, *state))
        return iter(())

    def forgotten(self, last: int) -> int:
        return last // 1000 + self.forget_s * 1000

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        kept = self.kept.get()
        if kept is None:
            return
        n, _, last, *state = kept
        mark = timerValues.getCurrentWatermarkInMs()
        due, next_due = self.take(mark)
        for us, place, *values in due:
            if last is not None and us - last > self.forget_s * 1_000_000:
                state = self.start
            last = us
            state, out = self.step(key, tuple(state), us, place, tuple(values))
            yield from out
        if next_due is None and last is not None and mark > self.forgotten(last):
            self.kept.clear()
            return
        timer = self.forgotten(last) if next_due is None else next_due
        self.handle.registerTimer(timer)  # the one that has expired is gone
        self.kept.update((n, timer, last, *state))


class Relay(InOrder):
    start, state, fields, field_types = ("",), "pair string", ("text",), "text string"

    def step(self, key: tuple, state: tuple, us: int, place: int, values: tuple) -> tuple[tuple, list[Row]]:
        (pair,), t = state, (values[0] or "").strip(" ")
        if m := re.match(r"Closed relay to (\S+) and (\S+)", t):
            return (f"{m[1]}-{m[2]}",), []
        if "Opened relay" in t or "De-block" in t:
            return ("",), []
        return state, [Row(rec=key[0], seq=place, pair=pair, current=t)] if pair and re.fullmatch("[0-9]+", t) else []


def relay_stream(events: DataFrame, late: str = "1 minute", forget_s: int = 30 * 86400) -> DataFrame:
    """R6. Currents of the relay's open pair: rec, seq, pair, current. events: rec, ts, seq, text.

    Rows wait until the watermark has passed them and are taken in the order of (ts, seq), so that a row of a later batch finds its place. A recording without rows for
    forget_s has no open pair any more, and its state is dropped."""
    rows = events.withWatermark("ts", late).select("rec", "ts", F.unix_micros("ts").alias("us"), F.col("seq").alias("place"), "text")
    return rows.groupBy("rec").transformWithState(Relay(forget_s), "rec long, seq long, pair string, current string", "append", "EventTime")


#: A sample of a file's size. Copies come before others of their time and size.
SAMPLE = np.dtype([("us", "<i8"), ("size", "<i8"), ("own", "?")])

#: A size that isn't known; it comes after others of its time.
UNKNOWN = 2**63 - 1

#: Samples in an entry of those that wait.
PACK = 16384


def packs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """base, last (the time of the last sample), samples (SAMPLEs as bytes): the samples of each file in a batch. batches: base, us, size, own."""
    for b in batches:
        if not b.num_rows:
            continue
        samples = np.empty(b.num_rows, SAMPLE)
        for field in SAMPLE.names:
            samples[field] = b.column(field).to_numpy(zero_copy_only=False)
        files = b.column("base").dictionary_encode(null_encoding="encode").indices.to_numpy()
        order = np.argsort(files, kind="stable")
        samples, starts = samples[order], np.flatnonzero(np.diff(files[order], prepend=-1))
        last = np.maximum.reduceat(samples["us"], starts)
        yield pa.RecordBatch.from_arrays([b.column("base").take(pa.array(order[starts])), pa.array(last), pa.array([p.tobytes() for p in np.split(samples, starts[1:])], pa.binary())], names=["base", "last", "samples"])


class Stall(InOrder):
    """quiet: seconds of too little growth so far; told: a stall that goes on is told once; copied: a copy of the file was seen, which is the end of its watch.

    Samples come and wait as packs, as one file may have a great part of them, and a row for each would cost its task many times the step. What comes when a later
    sample of the file has been taken is dropped, as Spark drops late rows, but packs only whole."""

    start, state = (None, None, 0.0, False, False), "size long, at long, quiet double, told boolean, copied boolean"

    def __init__(self, forget_s: int, bytes_s: float, stall_s: float):
        super().__init__(forget_s)
        self.bytes_s, self.stall_s = bytes_s, stall_s

    def waiting_rows(self, handle: StatefulProcessorHandle) -> ListState | MapState:
        # a map, as adding to a list costs more the longer it is
        return handle.getMapState("packs", "number long", "samples binary")

    def hold(self, rows: Iterator[Row], n: int, last: int | None) -> tuple[int, int | None]:
        due, held, count = None, [], 0
        for r in rows:
            samples = np.frombuffer(r.samples, SAMPLE)
            if last is not None:
                samples = samples[samples["us"] > last]
            if not len(samples):
                continue
            first = int(samples["us"].min()) // 1000 + 1
            due = first if due is None else min(due, first)
            held.append(samples)
            count += len(samples)
            if count >= PACK:
                n = self.put(n, np.concatenate(held))
                held, count = [], 0
        return self.put(n, np.concatenate(held)) if held else n, due

    def put(self, n: int, samples: np.ndarray) -> int:
        """Entries have the number of their first sample."""
        for at in range(0, len(samples), PACK):
            self.waiting.updateValue((n + at,), (samples[at : at + PACK].tobytes(),))
        return n + len(samples)

    def take(self, mark: int) -> tuple[Iterable[tuple], int | None]:
        waiting = np.concatenate([np.empty(0, SAMPLE), *(np.frombuffer(self.waiting.getValue(number)[0], SAMPLE) for number in list(self.waiting.keys()))])
        passed = waiting["us"] < mark * 1000
        due, left = waiting[passed], waiting[~passed]
        if len(due):
            self.waiting.clear()
            self.put(0, left)  # new samples have higher numbers
        due = due[np.lexsort((due["own"], due["size"], due["us"]))]
        return (s for at in range(0, len(due), PACK) for s in due[at : at + PACK].tolist()), int(left["us"].min()) // 1000 + 1 if len(left) else None

    def step(self, key: tuple, state: tuple, us: int, place: int, values: tuple) -> tuple[tuple, list[Row]]:
        size, at, quiet, told, copied = state
        now, copy = None if place == UNKNOWN else place, not values[0]
        row = lambda what: [Row(file=key[0], us=us, state=what, quiet_s=round(quiet, 6), size=size)]
        if copied:
            return state, []
        if copy:
            return (size, at, quiet, told, True), row("replicated")
        if at is None:
            return (now, us, 0.0, False, False), []
        seconds = (us - at) / 1e6
        if now is None or size is None or now - size >= self.bytes_s * seconds:
            out = [Row(file=key[0], us=us, state="growing", quiet_s=0.0, size=now)] if told else []
            return (now, us, 0.0, False, False), out
        quiet, size = quiet + seconds, now
        stalled = quiet >= self.stall_s and not told
        return (now, us, quiet, told or stalled, False), row("stalled") if stalled else []


#: A copy that an exporter makes beside a file: its name with a number in brackets.
COPY = r"^(.*)\(\d+\)(\.edf)$"


def stall_states(sizes: DataFrame, bytes_s: float = 10 * 1024 * 1024 / 60, stall_s: float = 60.0, late: str = "1 minute", forget_s: int = 86400) -> DataFrame:
    """R3. file, us, state, quiet_s, size: `stalled` when a file grew by less than bytes_s a second from sample to sample for stall_s or more, once until it is `growing` again, which comes
    after a stall; `replicated` when a copy of it, name(n).edf, is listed, after which it isn't watched any more. sizes: ts, file, size.

    Samples are taken in the order of their time, also over batches; a file without samples for forget_s starts anew. A size that isn't known counts as growth."""
    base = F.coalesce(F.nullif(F.concat(F.regexp_extract("file", f"(?i){COPY}", 1), F.regexp_extract("file", f"(?i){COPY}", 2)), F.lit("")), F.col("file"))
    rows = sizes.filter("ts is not null").select(base.alias("base"), F.unix_micros("ts").alias("us"), F.coalesce(F.col("size").cast("long"), F.lit(UNKNOWN)).alias("size"), F.coalesce(base == F.col("file"), F.lit(True)).alias("own"))
    rows = rows.mapInArrow(packs, "base string, last long, samples binary").select("base", F.timestamp_micros("last").alias("ts"), "samples").withWatermark("ts", late)
    return rows.groupBy("base").transformWithState(Stall(forget_s, bytes_s, stall_s), "file string, us long, state string, quiet_s double, size long", "append", "EventTime")


def watch(files: DataFrame, markers: DataFrame) -> DataFrame:
    """R1. Stream of recordings joined with the table of their marks: those that passed and have no result yet."""
    return files.join(markers, "path", "left").filter("passed and not coalesce(done, false)").select("path")


def rescan(listings: DataFrame, known: DataFrame, again: str = "1 hour") -> DataFrame:
    """R8. Stream of listings without the folders that are known to be good; a folder that was taken is not taken again before `again` has passed. Time is ts, where listings have it, else the clock's."""
    timed = listings if "ts" in listings.columns else listings.withColumn("ts", F.current_timestamp())
    return timed.join(known, "path", "left_anti").withWatermark("ts", again).dropDuplicatesWithinWatermark(["path"]).select(*listings.columns)
