"""Byte-level BPE encoding and decoding with a local rank file.

The tiktoken library merges; Spark partitions. Every text is encoded whole, with no special tokens. Texts longer
than CHUNK characters are cut first, only where no match of the pre-splitting pattern can reach across, so that the
ids are those of the uncut text.

Defined results: a null text counts as the empty text, which has no tokens, no id bytes and no decoded bytes. A null
or repeated id is returned as it is, one row for each row. An empty table gives an empty table. Other columns of the
input are not looked at.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import bounded_batches, text_or_empty

CHUNK = 1 << 16
#: Safe boundaries of the public pattern: a space after an ASCII letter or digit starts a new match. Another pattern needs its own, or None.
WORD_END = re.compile(r"(?<=[0-9A-Za-z])(?= )")
#: White space as the library's pattern engine has it: without U+001C to U+001F, which Python's \\s counts, too.
BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: A long run of blanks: all but its last (all of it at the end of the text) is one match, too long for the library's
#: pattern engine.
LONG_BLANKS = re.compile(rf"(?<!{BLANK}){BLANK}{{4096,}}(?!{BLANK})")


@lru_cache(maxsize=8)
def encoding(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local-ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def whole(ranks_path: str):
    """An encoding that takes any text as one match."""
    return encoding(ranks_path, r"(?s).+")


def cut(text: str, size: int, boundary: re.Pattern) -> Iterator[str]:
    """Cut at safe boundaries: a little over size characters each, or up to the next boundary there is."""
    start = 0
    while len(text) - start > size and (m := boundary.search(text, start + size)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


def encode_text(text: str, ranks_path: str, pattern: str, size: int = CHUNK, boundary: re.Pattern | None = WORD_END) -> list[int]:
    enc = encoding(ranks_path, pattern)
    if len(text) <= min(size, 4096) or boundary is None:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for m in LONG_BLANKS.finditer(text):
        for part in cut(text[start : m.start()], size, boundary):
            ids += enc.encode_ordinary(part)
        start = m.end() - (m.end() < len(text))
        ids += whole(ranks_path).encode_ordinary(text[m.start() : start])
    for part in cut(text[start:], size, boundary):
        ids += enc.encode_ordinary(part)
    return ids


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", boundary: re.Pattern | None = WORD_END) -> DataFrame:
    """doc_id, n_tokens, token_ids: the ids as little-endian unsigned 32-bit integers, as training loaders map them.

    boundary: empty matches where no match of the pattern can reach across; None for a pattern without any, whose texts then are never cut.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, packed = [], []
            for text in b.column(1).to_pylist():
                ids = encode_text(text, ranks_path, pattern, boundary=boundary)
                n.append(len(ids))
                packed.append(np.asarray(ids, dtype="<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "n_tokens", "token_ids"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_tokens long, token_ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Add `decoded`: the raw bytes of the ids, valid UTF-8 or not. Null ids decode to no bytes."""
    bounded_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for b in batches:
            out = [enc.decode_bytes(np.frombuffer(x or b"", dtype="<u4").tolist()) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=["doc_id", "n_tokens", "token_ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "token_ids").mapInArrow(run, "doc_id long, n_tokens long, token_ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
