"""EDF recordings as a Spark data source, and as files that a job writes.

    spark.dataSource.register(edf_files.Recordings)
    spark.read.format("recordings").option("path", folder).option("what", "samples").load().filter("channel = 1 and record >= 100 and record < 200")

`what`: headers (256 bytes and 256 for each signal of a file are read), samples (a row for each channel and record), annotations (only the bytes of annotation
signals are looked at), chunks (SHA-256 of the header and of pieces of a file of any kind), archives (unpacked sizes from the last bytes). A large file is dealt to many tasks by ranges of records, small ones share a task; a task
seeks to its records and holds CHUNK bytes at a time. Filters on channel, record and path decide what is read (spark.sql.python.filterPushdown.enabled), as the options
channels, first and stop do.

Files lie in any store that pyarrow opens. A file that can't be read has one row with the reason, one that ends early has its whole records and a row with the reason, and a channel
without a range has a row with its number and the reason.
"""

from __future__ import annotations

import fnmatch
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from tidemark.sources import archives, edf_bytes
from tidemark.sources.edf_bytes import Header, Malformed

SIGNAL = pa.struct([(k, pa.string()) for k in ("label", "unit", "phys_min", "phys_max", "dig_min", "dig_max", "prefilter", "spr")])
ARROW = {
    "headers": dict(path=pa.string(), size=pa.int64(), patient=pa.string(), recording=pa.string(), day=pa.string(), clock=pa.string(), header_bytes=pa.int32(), reserved=pa.string(), said_records=pa.int64(), record_s=pa.float64(), signals=pa.list_(SIGNAL), record_bytes=pa.int64(), n_records=pa.int64(), reason=pa.string()),
    "samples": dict(path=pa.string(), channel=pa.int32(), record=pa.int64(), values=pa.list_(pa.float64()), reason=pa.string()),
    "annotations": dict(path=pa.string(), record=pa.int64(), place=pa.int32(), onset=pa.float64(), duration=pa.float64(), text=pa.string(), reason=pa.string()),
    "chunks": dict(path=pa.string(), chunk=pa.int32(), sha256=pa.string(), reason=pa.string()),
    "archives": dict(path=pa.string(), kind=pa.string(), stored=pa.int64(), unpacked=pa.int64(), reason=pa.string()),
}
ARROW = {what: pa.schema(list(fields.items())) for what, fields in ARROW.items()}
SCHEMAS = {what: from_arrow_schema(schema) for what, schema in ARROW.items()}
#: Rows of an Arrow batch, bytes of a task's share of files.
ROWS, SHARE = 4096, 128 << 20
MOST = 1 << 62
#: Values of an Arrow batch; bytes that a file counts for beside its own, as it has to be opened.
WEIGHT, OPENING = 1 << 19, 1 << 19
#: Of these a task reads a few bytes only, whatever a file's size.
TAIL_ONLY = ("headers", "archives")


def at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path within it; file:/x is taken as file:///x."""
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


@dataclass
class Wanted:
    """What is read of a file."""

    what: str
    channels: frozenset[int] | None = None
    first: int = 0
    stop: int = MOST
    paths: frozenset[str] | None = None
    head: int = 256
    piece: int = 102_400


@dataclass
class Block:
    """Rows of samples: a channel's values in consecutive records, a row of the matrix for each."""

    path: str
    channel: int
    first: int
    values: np.ndarray


@dataclass
class Share(InputPartition):
    """Parts of files: path, size, part and number of parts."""

    parts: list[tuple[str, int, int, int]] = field(default_factory=list)

    def __init__(self, parts: list[tuple[str, int, int, int]]):
        super().__init__(None)
        self.parts = parts


def header_row(path: str, h: Header) -> tuple:
    signals = [{k: s[k] for k in ("label", "unit", "phys_min", "phys_max", "dig_min", "dig_max", "prefilter", "spr")} for s in h.signals]
    f = h.fields
    try:
        seconds = float(f["record_s"])
    except ValueError:
        seconds = None
    return (path, h.size, f["patient"], f["recording"], f["day"], f["clock"], h.header_bytes, f["reserved"], int(f["said_records"]), seconds, signals, h.record_bytes, h.n_records, h.reason)


def rows_of(f, path: str, size: int, part: int, parts: int, wanted: Wanted) -> Iterator[tuple | Block]:
    """Rows of a part of a file, those of samples in blocks; the reason of a file that is cut comes with its last part, that of one that can't be read with its first."""
    if wanted.what == "chunks":
        yield from chunk_rows(f, path, size, part, parts, wanted)
        return
    if wanted.what == "archives":
        kind, unpacked, reason = archives.unpacked_size(f, path, size)
        yield path, kind, size, unpacked, reason
        return
    try:
        head = edf_bytes.header_of(f, size)
        if wanted.what == "headers":
            yield header_row(path, head)
            return
        lo, hi = head.n_records * part // parts, head.n_records * (part + 1) // parts
        lo, hi = max(lo, wanted.first), min(hi, wanted.stop)
        if wanted.what == "samples":
            asked = []
            for c, signal in enumerate(head.signals):
                if edf_bytes.is_signal(signal) and (wanted.channels is None or c in wanted.channels):
                    try:
                        edf_bytes.scale(head, c)
                        asked.append(c)
                    except Malformed as e:
                        if not part:
                            yield path, c, None, None, str(e)
            for start, block in edf_bytes.records(f, head, lo, hi) if asked else ():
                for c in asked:
                    found = edf_bytes.values(head, c, block)
                    step = max(1, min(ROWS, WEIGHT // max(1, found.shape[1])))
                    for at in range(0, len(found), step):
                        yield Block(path, c, start + at, found[at : at + step])
        elif any(not edf_bytes.is_signal(s) for s in head.signals):
            for row in edf_bytes.annotations(f, head, lo, hi):
                yield (path, *row, None)
        if head.reason and part == parts - 1:
            yield failure(path, head.reason, wanted.what)
    except Malformed as e:
        if not part:
            yield failure(path, str(e), wanted.what)


def chunk_rows(f, path: str, size: int, part: int, parts: int, wanted: Wanted) -> Iterator[tuple]:
    """The header's bytes are chunk -1."""
    n = max(0, -(-(size - wanted.head) // wanted.piece))
    if not part:
        yield path, -1, hashlib.sha256(f.read(wanted.head)).hexdigest(), None
    for k in range(n * part // parts, n * (part + 1) // parts):
        f.seek(wanted.head + k * wanted.piece)
        yield path, k, hashlib.sha256(f.read(wanted.piece)).hexdigest(), None


def failure(path: str | None, reason: str, what: str) -> tuple:
    return (path, *[None] * (len(ARROW[what]) - 2), reason)


def batches(rows: Iterator[tuple | Block], what: str) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of at most ROWS rows, and fewer where their values are many. Blocks become columns as they are."""
    schema, held, blocks, n, weight = ARROW[what], [], [], 0, 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], t) for i, t in enumerate(schema.types)], schema=schema)

    def batch_of_blocks() -> pa.RecordBatch:
        sizes = [len(b.values) for b in blocks]
        paths = pa.array([b.path for b in blocks], pa.string()).take(pa.array(np.repeat(np.arange(len(blocks)), sizes)))
        records = np.concatenate([np.arange(b.first, b.first + len(b.values)) for b in blocks])
        offsets = np.concatenate([[0], np.cumsum(np.repeat([b.values.shape[1] for b in blocks], sizes))])
        values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([b.values.ravel() for b in blocks]), pa.float64()))
        columns = [paths, pa.array(np.repeat([b.channel for b in blocks], sizes), pa.int32()), pa.array(records, pa.int64()), values, pa.nulls(len(records), pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for r in rows:
        if isinstance(r, Block):
            if blocks and (n + len(r.values) > ROWS or weight + r.values.size > WEIGHT):
                yield batch_of_blocks()
                blocks, n, weight = [], 0, 0
            blocks.append(r)
            n, weight = n + len(r.values), weight + r.values.size
            continue
        held.append(r)
        if len(held) >= ROWS:
            yield batch()
            held = []
    if blocks:
        yield batch_of_blocks()
    if held:
        yield batch()


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.pattern, self.share = options["path"], options.get("pattern", "*"), int(options.get("share", SHARE))
        channels = options.get("channels")
        self.wanted = Wanted(
            options.get("what", "samples"), None if channels is None else frozenset(int(c) for c in channels.split(",") if c), int(options.get("first", 0)), int(options.get("stop", MOST)),
            head=int(options.get("head", 256)), piece=int(options.get("piece", 102_400)),
        )

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Those on channel, record and path that single out or bound values; others are left to Spark."""
        w = self.wanted
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else ""
            # equality doesn't tell rows without a value, so the reasons stay out as in SQL
            some = frozenset([f.value]) if isinstance(f, EqualTo) else frozenset(f.value) if isinstance(f, In) else None
            if name == "path" and some is not None:
                w.paths = some if w.paths is None else w.paths & some
            elif name == "channel" and some is not None and w.what == "samples":
                w.channels = some if w.channels is None else w.channels & some
            elif name == "record" and w.what in ("samples", "annotations") and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    w.first = max(w.first, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    w.stop = min(w.stop, f.value + (not isinstance(f, LessThan)))
            yield f  # Spark looks again: rows with a reason have no channel and no record

    def partitions(self) -> list[Share]:
        """Listed files, dealt in shares of bytes; only sizes are asked for."""
        system, root = at(self.root)
        found = system.get_file_info(root)
        infos = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True)) if found.type == fs.FileType.Directory else []
        files = sorted((i.path, i.size) for i in infos if i.type == fs.FileType.File and fnmatch.fnmatch(i.base_name, self.pattern) and not i.base_name.startswith((".", "_")))
        if self.wanted.paths is not None:
            files = [x for x in files if x[0] in self.wanted.paths]
        out, held, weight = [], [], 0
        for path, size in files:
            parts = 1 if self.wanted.what in TAIL_ONLY else max(1, -(-size // self.share))
            if parts > 1:
                out += [Share([(path, size, k, parts)]) for k in range(parts)]
                continue
            held.append((path, size, 0, 1))
            weight += (0 if self.wanted.what in TAIL_ONLY else size) + OPENING
            if weight >= self.share:
                out.append(Share(held))
                held, weight = [], 0
        return [*out, Share(held)] if held or not out else out

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        system = at(self.root)[0]

        def rows() -> Iterator[tuple]:
            for path, size, part, parts in partition.parts:
                with system.open_input_file(path) as f:
                    yield from rows_of(f, path, size, part, parts, self.wanted)

        yield from batches(rows(), self.wanted.what)


class Recordings(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recordings"

    def schema(self) -> StructType:
        return SCHEMAS[self.options.get("what", "samples")]

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))


def read(spark: SparkSession, path: str, what: str = "samples", **options: str | int) -> DataFrame:
    """S4, S5, S6, A20, N5: a folder, or one file, by the data source; options as above (channels, first, stop, pattern, share, head, piece)."""
    spark.dataSource.register(Recordings)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    source = spark.read.format("recordings").option("path", path).option("what", what)
    for k, v in options.items():
        source = source.option(k, str(v))
    return source.load()


def from_column(files: DataFrame, key: str, content: str, wanted: Wanted) -> DataFrame:
    """The same rows from a table with the bytes in a column; the key, as text, stands for the path. A null content has a reason."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:

            def rows(b: pa.RecordBatch = b) -> Iterator[tuple]:
                for path, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    if not raw.is_valid:
                        yield failure(path, "no content", wanted.what)
                        continue
                    with pa.BufferReader(raw.as_buffer()) as f:
                        yield from rows_of(f, path, len(raw.as_buffer()), 0, 1, wanted)

            yield from batches(rows(), wanted.what)

    return files.select(F.col(key).cast("string").alias("path"), F.col(content).cast("binary").alias("content")).mapInArrow(run, SCHEMAS[wanted.what])


def write(rows: DataFrame, folder: str, signals: list[dict[str, str]], annotation_bytes: int = 0, wide: int = 2, patient: str = "X X X X", recording: str = "Startdate X X X X", day: str = "02.01.24", clock: str = "03.04.05", record_s: str = "1", count: bool = True) -> DataFrame:
    """Writes one file for each rec below folder: rec, path, size, n_records. rows: rec, record, n_records, channel (place in signals, or their number for annotations), values, tal (bytes).

    Rows go to one task a recording in the order of records and channels, which writes as they come and holds one record. Channels and records that are missing get values
    nearest to 0 and no annotations. count: whether the header says how many records there are. A file appears under its name when it is whole, so a task may be tried again."""
    every = [*signals, *([{"label": "EDF Annotations", "phys_min": "-1", "phys_max": "1", "dig_min": "-32768", "dig_max": "32767", "spr": str(annotation_bytes // wide)}] if annotation_bytes else [])]

    blanks = [edf_bytes.encoded_values(s, [], wide) for s in signals]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = at(folder)
        system.create_dir(root, recursive=True)
        done: list[tuple] = []
        out = temporary = key = None
        at_record = n = 0
        cells: dict[int, bytes] = {}

        def record() -> bytes:
            parts = [cells.get(c, blank) for c, blank in enumerate(blanks)] if cells else blanks
            if annotation_bytes:
                raw = cells.get(len(signals), b"")
                if len(raw) > annotation_bytes:
                    raise ValueError(f"annotations of {len(raw)} bytes, room for {annotation_bytes}")
                parts = [*parts, raw.ljust(annotation_bytes, b"\x00")]
            return b"".join(parts)

        def upto(stop: int) -> None:
            nonlocal at_record, cells
            while at_record < stop:
                out.write(record())
                at_record, cells = at_record + 1, {}

        def close() -> None:
            if out is None:
                return
            upto(n)
            size = out.tell()
            out.close()
            final = f"{root}/{key}.edf"
            system.move(temporary, final)
            done.append((key, final, size, n))

        for b in frames:
            rec_to_channel, encoded = [b.column(i).to_pylist() for i in range(4)], edf_bytes.encoded_cells(signals, b.column(3), b.column(4), wide)
            for rec, number, total, channel, raw, tal in zip(*rec_to_channel, encoded, b.column(5).to_pylist(), strict=True):
                if rec != key:
                    close()
                    key, n, at_record, cells = rec, total, 0, {}
                    temporary = f"{root}/.{key}-{uuid.uuid4().hex}"
                    out = system.open_output_stream(temporary, compression=None)
                    out.write(edf_bytes.encoded_header(every, patient, recording, day, clock, "EDF+C" if wide == 2 else "24BIT", n if count else -1, record_s))
                upto(number)
                cells[channel] = (tal or b"") if channel == len(signals) else raw + blanks[channel][len(raw) :]
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["rec", "path", "size", "n_records"])

    sent = rows.select(F.col("rec").cast("string").alias("rec"), F.col("record").cast("long").alias("record"), F.col("n_records").cast("long").alias("n_records"), F.col("channel").cast("int").alias("channel"), "values", "tal")
    return sent.repartition("rec").sortWithinPartitions("rec", "record", "channel").mapInArrow(run, "rec string, path string, size long, n_records long")
