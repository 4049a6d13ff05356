"""D3. Table functions for SQL: parsers of bytes and texts for LATERAL joins, and a decoder over a table that is dealt by recording.

    tables.register(spark)
    spark.sql("SELECT path, t.onset, t.text FROM files, LATERAL parse_tal(content) t")
    spark.sql("SELECT * FROM relay_pairs(TABLE(events))")
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from tidemark.functions import blocks
from tidemark.sources import edf, edf_bytes


def schema(**fields: str) -> StructType:
    kinds = {"int": IntegerType(), "string": StringType()}
    out = StructType()
    for name, kind in fields.items():
        out = out.add(name, kinds[kind])
    return out


def checked(arguments: tuple[AnalyzeArgument, ...], kinds: tuple[tuple[type, ...], ...], name: str) -> None:
    """An error while the query is analysed, not in its tasks."""
    if len(arguments) != len(kinds):
        raise ValueError(f"{name} takes {len(kinds)} arguments")
    for i, (a, kind) in enumerate(zip(arguments, kinds, strict=True)):
        if not isinstance(a.dataType, kind):
            raise ValueError(f"{name}: argument {i + 1} is {a.dataType.simpleString()}")


TEXT = (BinaryType, StringType)


def raw(content: bytes | str | None) -> bytes:
    return content.encode() if isinstance(content, str) else bytes(content or b"")


@udtf(returnType="place int, onset double, duration double, text string")
class ParseTal:
    """The texts of annotation lists: place of the list, onset, duration, text. Null content has none."""

    def eval(self, content: bytes) -> Iterator[tuple]:
        for place, (onset, duration, texts) in enumerate(edf_bytes.lists_in(raw(content))):
            for text in texts:
                yield place, onset, duration, text


@udtf
class ParseNotes:
    """The leaves of a note file: path, value."""

    @staticmethod
    def analyze(content: AnalyzeArgument) -> AnalyzeResult:
        checked((content,), (TEXT,), "parse_notes")
        return AnalyzeResult(schema(path="string", value="string"))

    def eval(self, content: bytes) -> Iterator[tuple]:
        yield from edf.note_leaves(raw(content).decode("latin-1"))


@udtf
class DiffLines:
    """What differs between the lines of two texts: block, kind, from and to in each, and the first text's lines with `context` more on each side. Nulls are empty texts."""

    @staticmethod
    def analyze(a: AnalyzeArgument, b: AnalyzeArgument, context: AnalyzeArgument) -> AnalyzeResult:
        checked((a, b, context), ((StringType,), (StringType,), (IntegerType,)), "diff_lines")
        return AnalyzeResult(schema(block="int", kind="string", a_from="int", a_to="int", b_from="int", b_to="int", context_from="int", context_to="int"))

    def eval(self, a: str, b: str, context: int) -> Iterator[tuple]:
        lines = (a or "").split("\n")
        for i, o in enumerate(blocks.changes(lines, (b or "").split("\n"))):
            yield i, *o, max(0, o[1] - context), min(len(lines), o[2] + context)


@udtf
class RelayPairs:
    """The relay's open pair at the numbers of a recording. Its argument is a table with rec, seq and text; it asks for the table by rec in the order of seq, so that callers needn't."""

    @staticmethod
    def analyze(events: AnalyzeArgument) -> AnalyzeResult:
        if not events.isTable:
            raise ValueError("relay_pairs takes a table")
        kinds = {f.name: f.dataType for f in events.dataType.fields}
        if missing := {"rec", "seq", "text"} - set(kinds):
            raise ValueError(f"relay_pairs: the table has no {sorted(missing)[0]}")
        out = StructType().add("rec", kinds["rec"]).add("seq", kinds["seq"]).add("pair", StringType()).add("current", StringType())
        return AnalyzeResult(out, partitionBy=[PartitioningColumn("rec")], orderBy=[OrderingColumn("seq")])

    def __init__(self) -> None:
        self.pair = ""

    def eval(self, row: Row) -> Iterator[tuple]:
        t = (row["text"] or "").strip(" ")
        if m := re.match(r"Closed relay to (\S+) and (\S+)", t):
            self.pair = f"{m[1]}-{m[2]}"
        elif "Opened relay" in t or "De-block" in t:
            self.pair = ""
        elif self.pair and re.fullmatch("[0-9]+", t):
            yield row["rec"], row["seq"], self.pair, t

    def terminate(self) -> Iterator[tuple]:
        return iter(())


FUNCTIONS = {"parse_tal": ParseTal, "parse_notes": ParseNotes, "diff_lines": DiffLines, "relay_pairs": RelayPairs}


def register(spark: SparkSession) -> None:
    for name, function in FUNCTIONS.items():
        spark.udtf.register(name, function)
