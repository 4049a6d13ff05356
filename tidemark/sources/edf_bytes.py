"""What an EDF or EDF+ recording's bytes say, read piece by piece from anything that can seek: a file of any store, or bytes of a column."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The widths of a signal's header fields, in order.
FIELDS = {"label": 16, "transducer": 80, "unit": 8, "phys_min": 8, "phys_max": 8, "dig_min": 8, "dig_max": 8, "prefilter": 80, "spr": 8, "reserved": 32}
#: The widths of the first header fields, in order.
FIRST = {"version": 8, "patient": 80, "recording": 80, "day": 8, "clock": 8, "header_bytes": 8, "reserved": 44, "said_records": 8, "record_s": 8, "n_signals": 4}
#: Bytes of records that are read at a time.
CHUNK = 4 << 20
ANNOTATIONS = "Annotations"
#: One annotation list: onset, duration, texts parted by 0x14, an end by 0x00.
TAL = re.compile(rb"([+-]\d+(?:\.\d*)?)(?:\x15(\d+(?:\.\d*)?))?\x14([^\x00]*?)\x14?\x00")


class Malformed(ValueError):
    """The reason why a recording can't be read."""


@dataclass
class Header:
    """All first fields as texts, signals as dictionaries of texts, and what follows from them."""

    size: int
    fields: dict[str, str]
    signals: list[dict[str, str]] = field(default_factory=list)
    header_bytes: int = 0
    record_bytes: int = 0
    n_records: int = 0
    reason: str | None = None

    @property
    def wide(self) -> int:
        return 3 if "24BIT" in self.fields["reserved"] else 2

    @property
    def starts(self) -> list[int]:
        """Where each signal's bytes start within a record, and the record's end."""
        out = [0]
        for s in self.signals:
            out.append(out[-1] + int(s["spr"]) * self.wide)
        return out


def number(text: str, kind: type, what: str):
    try:
        return kind(text)
    except ValueError:
        raise Malformed(f"{what} is no number: {text[:20]!r}") from None


def header_of(f: BinaryIO, size: int) -> Header:
    """Reads 256 bytes and 256 for each signal. n_records: as many whole records as the size holds, and no more than the header says (where it doesn't say -1)."""
    raw = f.read(256)
    if len(raw) < 256:
        raise Malformed(f"{len(raw)} bytes are no header")
    fields, at = {}, 0
    for name, width in FIRST.items():
        fields[name] = raw[at : at + width].decode("latin-1").strip(" ")
        at += width
    count = number(fields["n_signals"], int, "n_signals")
    if count < 0:
        raise Malformed(f"n_signals is {count}")
    more = f.read(256 * count)
    if len(more) < 256 * count:
        raise Malformed(f"the header of {count} signals is cut")
    head, at = Header(size, fields, [{} for _ in range(count)]), 0
    for name, width in FIELDS.items():
        for i in range(count):
            head.signals[i][name] = more[at + i * width : at + (i + 1) * width].decode("latin-1").strip(" ")
        at += count * width
    head.header_bytes = number(fields["header_bytes"], int, "header_bytes")
    if any(number(s["spr"], int, "spr") < 0 for s in head.signals):
        raise Malformed("spr is below 0")
    if head.header_bytes < 256 * (count + 1):
        raise Malformed(f"header_bytes is {head.header_bytes}")
    said = number(fields["said_records"], int, "said_records")
    head.record_bytes = head.starts[-1]
    there = max(0, size - head.header_bytes) // head.record_bytes if head.record_bytes else 0
    head.n_records = there if said < 0 else min(said, there)
    if said > there:
        head.reason = f"cut: {there} of {said} records"
    return head


def records(f: BinaryIO, head: Header, first: int, stop: int) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of whole records in [first, stop) as (number of the first, matrix of bytes), CHUNK bytes at a time."""
    step = max(1, CHUNK // max(1, head.record_bytes))
    for at in range(first, min(stop, head.n_records), step):
        n = min(step, stop - at, head.n_records - at)
        f.seek(head.header_bytes + at * head.record_bytes)
        raw = f.read(n * head.record_bytes)
        if len(raw) < n * head.record_bytes:
            raise Malformed(f"record {at + len(raw) // head.record_bytes} is cut")
        yield at, np.frombuffer(raw, np.uint8).reshape(n, head.record_bytes)


def is_signal(signal: dict[str, str]) -> bool:
    return ANNOTATIONS not in signal["label"]


def scale(head: Header, channel: int) -> tuple[float, float]:
    """Gain and offset: a physical value is gain * (digital + offset)."""
    s = head.signals[channel]
    dig_min, dig_max = (number(s[k], float, k) for k in ("dig_min", "dig_max"))
    phys_min, phys_max = (number(s[k], float, k) for k in ("phys_min", "phys_max"))
    if dig_max == dig_min or phys_max == phys_min:
        raise Malformed(f"channel {channel} has no range")
    gain = (phys_max - phys_min) / (dig_max - dig_min)
    return gain, phys_max / gain - dig_max


def values(head: Header, channel: int, block: np.ndarray) -> np.ndarray:
    """Physical values of a channel in a block of records: a row for each record."""
    gain, offset = scale(head, channel)
    lo, hi = head.starts[channel : channel + 2]
    part = np.ascontiguousarray(block[:, lo:hi])
    if head.wide == 2:
        digital = part.view("<i2").astype(np.float64)
    else:
        p = part.reshape(len(part), -1, 3).astype(np.int64)
        digital = (((p[..., 0] | p[..., 1] << 8 | p[..., 2] << 16) ^ 0x800000) - 0x800000).astype(np.float64)
    return gain * (digital + offset)


def text_of(raw: bytes) -> str:
    """UTF-8, as the format asks for, else Latin-1."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def lists_in(raw: bytes) -> Iterator[tuple[float, float | None, list[str]]]:
    """Onset, duration and texts of the annotation lists in these bytes."""
    for m in TAL.finditer(raw):
        yield float(m[1]), None if m[2] is None else float(m[2]), text_of(m[3]).split("\x14")


def annotation_bytes(head: Header, block: np.ndarray) -> Iterator[bytes]:
    """The bytes of all annotation signals of each record of a block; other signals are not looked at."""
    at = head.starts
    channels = [c for c, s in enumerate(head.signals) if not is_signal(s)]
    for row in block:
        yield b"".join(row[at[c] : at[c + 1]].tobytes() + b"\x00" for c in channels)


def start_offset(f: BinaryIO, head: Header) -> float:
    """What onsets are shifted by: less the onset of the first list, where its text is empty."""
    for _, block in records(f, head, 0, 1):
        for raw in annotation_bytes(head, block):
            for onset, _, texts in lists_in(raw):
                return -onset if texts == [""] else 0.0
    return 0.0


CONTROL = re.compile(r"[\x00-\x1f\x7f-\x9f]")


def annotations(f: BinaryIO, head: Header, first: int, stop: int) -> Iterator[tuple[int, int, float, float | None, str]]:
    """record, place (of the list within its record), onset, duration, text, for all texts that aren't blank without control characters."""
    offset = start_offset(f, head)
    for at, block in records(f, head, first, stop):
        for r, raw in enumerate(annotation_bytes(head, block)):
            for place, (onset, duration, texts) in enumerate(lists_in(raw)):
                for text in texts:
                    if clean := CONTROL.sub("", text).strip(" "):
                        yield at + r, place, round(onset + offset, 6), duration, clean


def encoded_header(signals: list[dict[str, str]], patient: str, recording: str, day: str, clock: str, reserved: str, n_records: int, record_s: str) -> bytes:
    """A header; texts are cut to their fields."""
    values = {"version": "0", "patient": patient, "recording": recording, "day": day, "clock": clock, "header_bytes": str(256 * (len(signals) + 1)), "reserved": reserved, "said_records": str(n_records), "record_s": record_s, "n_signals": str(len(signals))}
    fit = lambda text, width: text[:width].ljust(width).encode("latin-1", "replace")
    return b"".join(fit(values[k], w) for k, w in FIRST.items()) + b"".join(fit(s.get(k, ""), w) for k, w in FIELDS.items() for s in signals)


def encoded_values(signal: dict[str, str], physical: list[float | None], wide: int) -> bytes:
    """A channel's values of a record as bytes, rounded and held to the digital range; nulls and what is missing at the end are the digital value nearest to 0."""
    low, high = int(signal["dig_min"]), int(signal["dig_max"])
    gain = (float(signal["phys_max"]) - float(signal["phys_min"])) / max(high - low, 1)
    digital = np.full(int(signal["spr"]), 0, np.int64)
    given = np.array([np.nan if v is None else v for v in physical[: len(digital)]], np.float64)
    scaled = given / gain - float(signal["phys_max"]) / gain + high
    digital[: len(given)] = np.where(np.isnan(given), 0, np.round(np.nan_to_num(scaled)))
    digital = np.clip(digital, low, high)
    return digital.astype("<i2").tobytes() if wide == 2 else digital.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def encoded_cells(signals: list[dict[str, str]], channels: pa.Array, values: pa.Array, wide: int) -> Iterator[bytes]:
    """The same for many rows at a time, without what is missing at the end: channels is each row's place in signals (any other: none), values its list."""
    low, high, phys_max, gain, most = (np.zeros(len(signals) + 1) for _ in range(5))
    for c, s in enumerate(signals):
        low[c], high[c], phys_max[c], most[c] = int(s["dig_min"]), int(s["dig_max"]), float(s["phys_max"]), int(s["spr"])
        gain[c] = (float(s["phys_max"]) - float(s["phys_min"])) / max(int(s["dig_max"]) - int(s["dig_min"]), 1)
    gain[len(signals)] = 1
    sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = channels.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(at, sizes)
    given = pc.cast(pc.list_flatten(values), pa.float64()).to_numpy(zero_copy_only=False)
    scaled = given / gain[of] - phys_max[of] / gain[of] + high[of]
    digital = np.clip(np.where(np.isnan(given), 0, np.round(scaled)), low[of], high[of])
    raw = digital.astype("<i2").tobytes() if wide == 2 else digital.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    ends = np.cumsum(sizes)
    for start, stop in zip((ends - sizes).tolist(), np.minimum(ends, ends - sizes + most[at].astype(np.int64)).tolist(), strict=True):
        yield raw[start * wide : stop * wide]
