"""Media columns: texts kept as baseline JPEG files in a binary column, read back with dimensions and thumbnail hashes.

Defined results: a null text counts as the empty text, stored as one unit of 576 bytes 255. Equal texts have equal
media. A null or repeated id is returned as it is, one row for each row. Other columns aren't looked at. A null file in
`describe` gives nulls; one that isn't a baseline JPEG file gives nulls and the reason in `error`.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import jpeg
from tidemark.llm.work import bounded_batches, words_source

#: Bytes of files that are decoded in step.
TOGETHER = 2 << 20
#: What a malformed file can raise in the reader.
BAD = (ValueError, IndexError, KeyError, ArithmeticError, struct.error)


def padded(data: bytes) -> bytes:
    n = max(1, -(-len(data) // jpeg.UNIT)) * jpeg.UNIT
    return data + b"\xff" * (n - len(data))


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (of the text), media (the JPEG file)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            media = pa.array([jpeg.write(padded(x)) for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, texts), pa.int64()), media], names=["doc_id", "n_bytes", "media"])

    return words_source(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def described(files: list[bytes | None]) -> list[tuple]:
    """width, height, thumbnail (PGM rows), thumbnail hash, payload or None, error: of each file."""
    out: list[tuple] = [(None,) * 6] * len(files)
    ready = []
    for i, x in enumerate(files):
        if x is not None:
            ready.append(i)

    def finish(i: int, head: jpeg.Header, coefs) -> None:
        pixels = jpeg.thumbnail(head, coefs)
        kept = jpeg.payload(head, coefs) if head.comment.startswith(b"payload ") else None
        out[i] = (head.width, head.height, pixels.tobytes(), jpeg.thumbnail_hash(pixels), kept, None)

    group: list[int] = []
    size = 0
    for j, i in enumerate(ready):
        group.append(i)
        size += len(files[i])
        if size >= TOGETHER or j == len(ready) - 1:
            try:
                for k, (head, coefs) in zip(group, jpeg.read([files[k] for k in group]), strict=True):
                    finish(k, head, coefs)
            except BAD:  # one bad file: find it by taking each alone
                for k in group:
                    try:
                        finish(k, *jpeg.read([files[k]])[0])
                    except BAD as e:
                        out[k] = (*(None,) * 5, str(e) or type(e).__name__)
            group, size = [], 0
    return out


def describe(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """doc_id, n_bytes, media, width, height, thumbnail, thumb_hash, payload (if store() wrote the file), error."""
    bounded_batches(media.sparkSession)
    names = ["doc_id", "n_bytes", "media", "width", "height", "thumbnail", "thumb_hash", "payload", "error"]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.binary(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = described(b.column(2).to_pylist())
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=names)

    size = F.col("n_bytes") if "n_bytes" in media.columns else F.lit(None)
    narrow = media.select(F.col(id_col).cast("long").alias("doc_id"), size.cast("long").alias("n_bytes"), F.col(media_col).alias("media"))
    return narrow.mapInArrow(run, "doc_id long, n_bytes long, media binary, width int, height int, thumbnail binary, thumb_hash string, payload binary, error string")


def digests(described_media: DataFrame) -> DataFrame:
    return described_media.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.concat_ws("x", "width", "height"), "thumb_hash").alias("feature"), "width", "height", "error",
    )
