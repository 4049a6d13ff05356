"""The data source of recordings, archives and chunks: parts of files, filters, malformed files, sparse large files."""

import hashlib
import gzip
import io
import math
import os
import random
import struct
import zipfile

import pytest
import pyarrow as pa
import numpy as np
from pyspark.sql import functions as F

from tidemark.sources import archives, edf, edf_bytes, edf_files

SIGNALS = [{"label": f"A{i}", "unit": "uV", "phys_min": "-500", "phys_max": "500", "dig_min": "-2000", "dig_max": "2000", "spr": str(spr)} for i, spr in enumerate((4, 2, 3))]
NOTES = {"label": "EDF Annotations", "phys_min": "-1", "phys_max": "1", "dig_min": "-32768", "dig_max": "32767", "spr": "32"}


def made(n, said=None, wide=2, start=0, notes=True, signals=SIGNALS):
    """Bytes of a recording whose channel c has the values (record * 10 + c) / 4, and a note in each record."""
    every = [*signals, *([NOTES] if notes else [])]
    head = edf_bytes.encoded_header(every, "X X X X", "Startdate X X X X", "02.01.24", "03.04.05", "EDF+C" if wide == 2 else "24BIT", n if said is None else said, "1")
    body = b""
    for r in range(n):
        for c, s in enumerate(signals):
            body += edf_bytes.encoded_values(s, [(r * 10 + c) / 4] * int(s["spr"]), wide)
        if notes:
            body += (f"+{r + start}\x14\x14\x00" + f"+{r}.25\x14note {r % 3}\x14\x00").encode().ljust(32 * wide, b"\x00")
    return head + body


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("recordings")
    contents = {
        "whole.edf": made(7), "wide.edf": made(5, wide=3, notes=False), "unknown.edf": made(4, said=-1), "cut.edf": made(6)[:-7], "short.edf": made(1)[:100], "cut_head.edf": made(1)[:700], "empty.edf": b"",
        "no_number.edf": made(2)[:252] + b"x   " + made(2)[256:], "flat.edf": made(2, signals=[SIGNALS[0] | {"dig_min": "2000"}]), "late.edf": made(3, start=2), "no_records.edf": made(0), "other.txt": b"nothing",
    }
    for name, raw in contents.items():
        (path / name).write_bytes(raw)
    return path


def by_name(rows):
    out = {}
    for r in rows:
        out.setdefault(os.path.basename(r.path), []).append(r)
    return out


def test_headers(spark, folder):
    rows = by_name(edf_files.read(spark, str(folder), "headers", pattern="*.edf").collect())
    assert {k: (v[0].n_records, v[0].reason) for k, v in rows.items()} == {
        "whole.edf": (7, None), "wide.edf": (5, None), "unknown.edf": (4, None), "cut.edf": (5, "cut: 5 of 6 records"), "short.edf": (None, "100 bytes are no header"), "cut_head.edf": (None, "the header of 4 signals is cut"), "empty.edf": (None, "0 bytes are no header"),
        "no_number.edf": (None, "n_signals is no number: 'x'"), "flat.edf": (2, None), "late.edf": (3, None), "no_records.edf": (0, None),
    }
    assert all(len(v) == 1 for v in rows.values()) and [s.label for s in rows["whole.edf"][0].signals] == ["A0", "A1", "A2", "EDF Annotations"]


@pytest.mark.parametrize("share", [1 << 27, 100])
def test_samples_in_parts(spark, folder, share):
    rows = by_name(edf_files.read(spark, str(folder), "samples", pattern="*.edf", share=share).collect())
    for name, n in (("whole.edf", 7), ("wide.edf", 5), ("unknown.edf", 4), ("cut.edf", 5), ("late.edf", 3)):
        got = sorted((r.channel, r.record, tuple(r["values"])) for r in rows[name] if r.reason is None)
        assert got == sorted((c, r, ((r * 10 + c) / 4,) * int(SIGNALS[c]["spr"])) for c in range(3) for r in range(n))
    assert {k: [r.reason for r in v if r.reason] for k, v in rows.items() if any(r.reason for r in v)} == {
        "cut.edf": ["cut: 5 of 6 records"], "short.edf": ["100 bytes are no header"], "cut_head.edf": ["the header of 4 signals is cut"], "empty.edf": ["0 bytes are no header"], "no_number.edf": ["n_signals is no number: 'x'"], "flat.edf": ["channel 0 has no range"],
    }


def test_a_channel_without_a_range(spark, tmp_path):
    (tmp_path / "a.edf").write_bytes(made(2, signals=[SIGNALS[0], SIGNALS[1] | {"dig_min": "2000"}, SIGNALS[2]]))
    rows = edf_files.read(spark, str(tmp_path), share=100).collect()
    assert sorted((r.channel, r.record) for r in rows if r.reason is None) == [(0, 0), (0, 1), (2, 0), (2, 1)] and [(r.channel, r.reason) for r in rows if r.reason] == [(1, "channel 1 has no range")]


def test_filters_reach_the_reader(spark, folder):
    df = edf_files.read(spark, f"{folder}/whole.edf").filter("channel in (0, 2) and record > 1 and record <= 4 and values[0] > 0")
    assert sorted((r.channel, r.record) for r in df.collect()) == [(c, r) for c in (0, 2) for r in (2, 3, 4)]
    reader = edf_files.Reader({"path": str(folder)})
    kept = list(reader.pushFilters([edf_files.In(("channel",), (0, 2)), edf_files.GreaterThan(("record",), 1), edf_files.LessThanOrEqual(("record",), 4), edf_files.EqualTo(("path",), f"{folder}/whole.edf")]))
    assert len(kept) == 4 and (reader.wanted.channels, reader.wanted.first, reader.wanted.stop) == ({0, 2}, 2, 5)
    assert [p[0] for s in reader.partitions() for p in s.parts] == [f"{folder}/whole.edf"]
    options = edf_files.read(spark, f"{folder}/whole.edf", channels="1", first=2, stop=3).collect()
    assert [(r.channel, r.record) for r in options] == [(1, 2)]


def test_annotations(spark, folder):
    rows = by_name(edf.events_of(edf_files.read(spark, str(folder), "annotations", pattern="*.edf", share=100)).collect())
    assert sorted((r.record, r.place, r.onset, r.text) for r in rows["whole.edf"]) == [(r, 1, r + 0.25, f"note {r % 3}") for r in range(7)]
    assert sorted(r.onset for r in rows["late.edf"]) == [-1.75, -0.75, 0.25] and "wide.edf" not in rows


def test_samples_are_never_annotations(spark, tmp_path):
    """Bytes of samples that look like a list."""
    trap = b"+1\x14trap\x14\x00+2\x14trap\x14\x00"
    signals = [SIGNALS[0] | {"spr": str(len(trap) // 2)}, NOTES]
    head = edf_bytes.encoded_header(signals, "X", "R", "02.01.24", "03.04.05", "EDF+C", 1, "1")
    (tmp_path / "a.edf").write_bytes(head + trap + b"+0\x14\x14\x00+1\x14\xe9 true\x14\x00".ljust(64, b"\x00"))
    assert [(r.onset, r.text) for r in edf_files.read(spark, str(tmp_path), "annotations").collect()] == [(1.0, "é true")]


def test_a_sparse_file_over_two_gib(spark, tmp_path):
    """Only the header and the asked records of a file of 3 GB are read."""
    signals = [SIGNALS[0] | {"spr": str(1 << 19)}]
    n = 3000
    path = tmp_path / "large.edf"
    with path.open("wb") as f:
        f.write(edf_bytes.encoded_header(signals, "X", "R", "02.01.24", "03.04.05", "EDF+C", n, "1"))
        f.truncate(512 + n * (1 << 20))
        f.seek(512 + 2990 * (1 << 20))
        f.write(struct.pack("<h", 40))
    df = edf_files.read(spark, str(path)).filter("record = 2990").select("record", F.col("values")[0].alias("v"), F.size("values").alias("n"))
    assert [tuple(r) for r in df.collect()] == [(2990, 10.0, 1 << 19)]
    assert edf_files.read(spark, str(path), "headers").first().n_records == n
    assert len(edf_files.Reader({"path": str(path)}).partitions()) == -(-path.stat().st_size // edf_files.SHARE)


def test_bytes_in_a_column(spark, folder):
    rows = [(p.name, bytearray(p.read_bytes())) for p in folder.iterdir()] + [("null", None), ("whole.edf", bytearray(made(7)))]
    df = spark.createDataFrame(rows, "path string, content binary")
    heads = edf.header(df).collect()
    assert sum(r.path == "whole.edf" and r.n_records == 7 for r in heads) == 2 and {r.reason for r in heads if r.path == "null"} == {"no content"}
    got = edf.samples(df, channels=[1], first=1, stop=3).filter("path = 'whole.edf'").collect()
    assert sorted((r.channel, r.record) for r in got) == [(1, 1), (1, 1), (1, 2), (1, 2)]


def test_chunks(spark, tmp_path):
    raw = random.Random(1).randbytes(10_000)
    for name, n in (("a", 10_000), ("b", 64), ("c", 10), ("d", 0), ("e", 1064)):
        (tmp_path / name).write_bytes(raw[:n])
    want = {(name, k, hashlib.sha256(raw[:n][64 + 1000 * k : 1064 + 1000 * k] if k >= 0 else raw[:n][:64]).hexdigest()) for name, n in (("a", 10_000), ("b", 64), ("c", 10), ("d", 0), ("e", 1064)) for k in range(-1, max(0, math.ceil((n - 64) / 1000)))}
    for share in (1 << 27, 900):
        assert {(os.path.basename(r.path), r.chunk, r.sha256) for r in edf_files.read(spark, str(tmp_path), "chunks", head=64, piece=1000, share=share).collect()} == want


def test_write_and_read_again(spark, tmp_path):
    rows = [(rec, r, 3, c, [float(r), -2.0 * c, None], None) for rec in ("x", "y") for r in (0, 2) for c in (0, 2)] + [("x", 1, 3, 3, None, bytearray(b"+0\x14\x14\x00+1\x14caf\xc3\xa9\x14\x00"))]
    df = spark.createDataFrame(rows, "rec string, record long, n_records long, channel int, values array<double>, tal binary")
    for wide in (2, 3):
        out = tmp_path / str(wide)
        done = {r.rec: r for r in edf_files.write(df, str(out), SIGNALS, annotation_bytes=60, wide=wide).collect()}
        assert {k: v.n_records for k, v in done.items()} == {"x": 3, "y": 3} and all(os.path.getsize(v.path) == v.size for v in done.values()) and sorted(os.listdir(out)) == ["x.edf", "y.edf"]
        got = {(os.path.basename(r.path), r.channel, r.record): r["values"] for r in edf_files.read(spark, str(out)).collect()}
        assert len(got) == 18 and got["x.edf", 2, 2] == [2.0, -4.0, 0.0] and got["y.edf", 0, 0] == [0.0, 0.0, 0.0, 0.0] and got["x.edf", 1, 0] == [0.0, 0.0]
        assert [(r.record, r.text) for r in edf_files.read(spark, str(out), "annotations").collect()] == [(1, "café")]


def zipped(sizes, comment=b"", prefix=b""):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for i, n in enumerate(sizes):
            z.writestr(f"f{i}", b"a" * n)
        z.comment = comment
    return prefix + held.getvalue()


def zip64(sizes):
    """A directory alone, whose sizes and numbers need 64 bits."""
    entries = b""
    for i, n in enumerate(sizes):
        name = f"big{i}".encode()
        extra = struct.pack("<HHQ", 9, 8, 5) + struct.pack("<HHQQ", 1, 16, n, 7)
        entries += archives.ENTRY + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 8, 0, 0, 0, archives.FULL32, archives.FULL32, len(name), len(extra), 0, 0, 0, 0, 0) + name + extra
    start = 33
    end64 = archives.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(sizes), len(sizes), len(entries), start)
    locator = archives.LOCATOR + struct.pack("<IQI", 0, start + len(entries), 1)
    return b"\x00" * start + entries + end64 + locator + archives.END + struct.pack("<HHHHIIH", 0, 0, archives.FULL16, archives.FULL16, archives.FULL32, archives.FULL32, 0)


def test_archives(spark, tmp_path):
    contents = {
        "a.zip": zipped([10, 0, 100_000]), "comment.zip": zipped([3], b"PK\x05\x06 in a comment" * 3), "front.zip": zipped([5, 6], prefix=b"#!stub" * 9), "none.zip": zipped([]), "wide.zip": zip64([5 << 32, 1 << 33, 9]), "cut.zip": zipped([7])[:-30], "empty.zip": b"",
        "many.zip": zipped([1] * 3000), "a.edf.gz": gzip.compress(b"x" * 12345), "bad.gz": b"no gzip file at all", "a.rar": b"Rar!", "plain.edf": b"x" * 77,
    }
    for name, raw in contents.items():
        (tmp_path / name).write_bytes(raw)
    with (tmp_path / "wrapped.gz").open("wb") as f:  # says 17 bytes, but can't be
        f.write(b"\x1f\x8b" + b"\x08" * 30)
        f.truncate(3_000_000)
        f.seek(2_999_996)
        f.write(struct.pack("<I", 17))
    got = {os.path.basename(r.path): (r.kind, r.unpacked, r.reason) for r in edf_files.read(spark, str(tmp_path), "archives").collect()}
    assert got == {
        "a.zip": ("zip", 100_010, None), "comment.zip": ("zip", 3, None), "front.zip": ("zip", 11, None), "none.zip": ("zip", 0, None), "wide.zip": ("zip", (5 << 32) + (1 << 33) + 9, None), "cut.zip": ("zip", 0, "no end record"), "empty.zip": ("zip", 0, "no end record"),
        "many.zip": ("zip", 3000, None), "a.edf.gz": ("gzip", 12345, None), "bad.gz": ("gzip", 0, "no gzip file"), "a.rar": ("archive", 0, "no reader for this kind"), "plain.edf": ("file", 77, None), "wrapped.gz": ("gzip", 17, "over 4 GiB: the size is a remainder"),
    }


def test_cells_of_a_batch_are_those_of_single_rows():
    signals = [{"phys_min": "-500", "phys_max": "500", "dig_min": "-2000", "dig_max": "2000", "spr": "3"}, {"phys_min": "0", "phys_max": "10", "dig_min": "5", "dig_max": "500", "spr": "2"}]
    rows = [(0, [1.0, None, 3.25]), (2, None), (1, [2.0]), (0, []), (0, [float("inf"), float("-inf"), 9e9, 1.0]), (1, [None, 4.0, 5.0]), (0, None), (0, [float("nan"), -0.1])]
    values = pa.array([None, *[v for _, v in rows]], pa.list_(pa.float64())).slice(1)
    for wide in (2, 3):
        cells = list(edf_bytes.encoded_cells(signals, pa.array([c for c, _ in rows], pa.int32()), values, wide))
        blanks = [edf_bytes.encoded_values(s, [], wide) for s in signals]
        for (c, v), cell in zip(rows, cells, strict=True):
            if c < 2 and v != rows[4][1]:
                assert cell + blanks[c][len(cell) :] == edf_bytes.encoded_values(signals[c], v or [], wide)
        assert [int.from_bytes(cells[4][i : i + wide], "little", signed=True) for i in range(0, 3 * wide, wide)] == [2000, -2000, 2000] and cells[1] == b""


def test_blocks_of_samples_become_bounded_batches():
    blocks = [edf_files.Block(f"f{k}", k, 10 * k, np.full((3, 50), float(k))) for k in range(3000)]
    out = list(edf_files.batches(iter([*blocks[:2], edf_files.failure("bad", "why", "samples"), *blocks[2:]]), "samples"))
    assert all(b.num_rows <= edf_files.ROWS and len(b.column(3).flatten()) <= edf_files.WEIGHT for b in out) and len(out) < 10
    rows = {(r["path"], r["record"]): r for b in out for r in b.to_pylist()}
    assert len(rows) == 9001 and rows["bad", None]["reason"] == "why" and rows["f7", 72] == {"path": "f7", "channel": 7, "record": 72, "values": [7.0] * 50, "reason": None}


def test_leaves_of_large_note_files_come_in_bounded_batches():
    note = "(" + "".join(f'(."Text", "t{i}")' for i in range(30_000)) + ")"
    files = pa.RecordBatch.from_arrays([pa.array(["a", "b", None, "c"]), pa.array([note.encode(), None, b"", b'(."x", 1)'], pa.binary())], names=["rec", "content"])
    out = list(edf.leaf_batches(iter([files, files]), "rec"))
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    assert all(0 < b.num_rows <= edf.LEAVES for b in out) and len(out) == 4 and len(rows) == 2 * 30_001
    assert rows[:30_001] == [(k, p, v) for k, c in zip(["a", "c"], [note, '(."x", 1)'], strict=True) for p, v in edf.note_leaves(c)] and rows[30_001:] == rows[:30_001]
