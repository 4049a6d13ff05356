"""Baseline JPEG in numpy: a reader for any sequential Huffman file of up to four components, and a writer that keeps
a byte string in the quantised coefficients of a grey image.

The reader decodes many restart segments in step: each numpy operation advances every segment of a batch by one
symbol. A file without restart markers is one segment, and so is decoded beside the other files of the batch.

The writer gives every byte b one coefficient, in scan order. Its eight additional bits are b itself (category 8), so
no coefficient is zero and no block has runs. The Huffman tables give category 8 the one-bit code.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass, field

import numpy as np

# The zig-zag order of the 64 coefficients.
ZIGZAG = np.array([
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
])
UNIT = 576  # bytes of 3 x 3 blocks
SLICE = 1 << 14  # blocks coded at a time
QUANT = 4
#: DHT bodies: code lengths 1 to 16, then symbols in code order. Category 8 comes first; then 0 (DC), end of block and
#: sixteen zeros (AC).
DC_TABLE = bytes([1, 1, *[0] * 14]) + bytes([0x08, 0x00])
AC_TABLE = bytes([1, 1, 1, *[0] * 13]) + bytes([0x08, 0x00, 0xF0])


def segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def write(payload: bytes) -> bytes:
    """A grey image whose coefficients hold payload, of a positive multiple of 576 bytes; a comment says how many."""
    units = len(payload) // UNIT
    if units < 1 or len(payload) % UNIT:
        raise ValueError("the payload must be a positive multiple of 576 bytes")
    across = math.isqrt(units - 1) + 1
    down = -(-units // across)
    blocks = np.full((9 * across * down, 64), 255, np.uint8)
    blocks.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    # blocks stand alone, so that a long payload is coded a slice at a time
    scan = b"".join(coded(blocks[at : at + SLICE], at) for at in range(0, len(blocks), SLICE))[:-2]
    head = b"\xff\xd8" + segment(0xFE, b"payload %d" % len(payload)) + segment(0xDB, bytes([0]) + bytes([QUANT]) * 64)
    head += segment(0xC0, struct.pack(">BHHBBBB", 8, 24 * down, 24 * across, 1, 1, 0x11, 0))
    head += segment(0xC4, bytes([0x00]) + DC_TABLE) + segment(0xC4, bytes([0x10]) + AC_TABLE)
    head += segment(0xDD, struct.pack(">H", 1)) + segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
    return b"".join((head, scan, b"\xff\xd9"))


def coded(blocks: np.ndarray, first: int) -> bytes:
    """Entropy-coded blocks, each with the restart marker of its number after it."""
    bits = np.zeros((len(blocks), 64, 9), np.uint8)  # the code 0, then the byte
    bits[:, :, 1:] = np.unpackbits(blocks, axis=1).reshape(-1, 64, 8)
    body = np.empty((len(blocks), 74), np.uint8)
    body[:, :72] = np.packbits(bits.reshape(len(blocks), -1), axis=1)
    body[:, 72] = 0xFF
    body[:, 73] = 0xD0 + (first + np.arange(len(blocks))) % 8
    stuffed = body == 0xFF
    stuffed[:, 72:] = False
    flat, extra = body.reshape(-1), stuffed.reshape(-1)
    place = np.arange(len(flat)) + np.cumsum(extra) - extra
    out = np.zeros(len(flat) + int(extra.sum()), np.uint8)
    out[place] = flat
    return out.tobytes()


@dataclass
class Header:
    width: int = 0
    height: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, quantisation table
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    huffman: dict[int, bytes] = field(default_factory=dict)  # class * 16 + number -> DHT body
    scan: list[tuple[int, int, int]] = field(default_factory=list)  # component index, DC and AC table
    restart: int = 0
    comment: bytes = b""
    data_at: int = 0


def parse(data: bytes) -> Header:
    """Markers up to the scan. Raises ValueError where the file isn't a baseline (or extended sequential 8-bit) one."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no SOI marker")
    head, at = Header(), 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise ValueError(f"no marker at {at}")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0x01 or 0xD0 <= marker <= 0xD7:
            at += 2
            continue
        (size,) = struct.unpack_from(">H", data, at + 2)
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xDB:
            i = 0
            while i < len(body):
                wide, number = body[i] >> 4, body[i] & 15
                n = 128 if wide else 64
                head.quant[number] = np.frombuffer(body[i + 1 : i + 1 + n], ">u2" if wide else np.uint8).astype(np.int64)
                i += 1 + n
        elif marker == 0xC4:
            i = 0
            while i < len(body):
                n = 17 + sum(body[i + 1 : i + 17])
                head.huffman[body[i]] = bytes(body[i + 1 : i + n])
                i += n
        elif marker in (0xC0, 0xC1):
            precision, head.height, head.width, n = struct.unpack_from(">BHHB", body)
            if precision != 8:
                raise ValueError("only 8-bit samples")
            head.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a baseline file")
        elif marker == 0xDD:
            (head.restart,) = struct.unpack_from(">H", body)
        elif marker == 0xFE:
            head.comment = bytes(body)
        elif marker == 0xDA:
            ids = [c[0] for c in head.components]
            head.scan = [(ids.index(body[1 + 2 * i]), body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
            if len(head.scan) != len(head.components) or not head.scan or not head.width or not head.height:
                raise ValueError("only files with one scan of all components")
            if not all(1 <= c[1] <= 4 and 1 <= c[2] <= 4 for c in head.components):
                raise ValueError("no such sampling")
            across, down, order = layout(head)
            if across * down * len(order) > 4 * (len(data) - at):  # a block takes two bits or more
                raise ValueError("the scan is too short for this size")
            head.data_at = at
            return head
    raise ValueError("no scan")


def lookup(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code length and symbol for each 16 bits that can follow; length 0 where no code fits."""
    length, symbol = np.zeros(65536, np.uint8), np.zeros(65536, np.uint8)
    code = k = 0
    for bits in range(1, 17):
        for _ in range(body[bits - 1]):
            lo = code << (16 - bits)
            hi = (code + 1) << (16 - bits)
            length[lo:hi], symbol[lo:hi] = bits, body[16 + k]
            code, k = code + 1, k + 1
        code <<= 1
    return length, symbol


def layout(head: Header) -> tuple[int, int, list[tuple[int, int, int]]]:
    """MCUs across and down; for each block of an MCU its component's place in the scan, and its row and column in it."""
    hmax, vmax = max(c[1] for c in head.components), max(c[2] for c in head.components)
    if len(head.components) == 1:
        return -(-head.width // 8), -(-head.height // 8), [(0, 0, 0)]
    order = [(i, y, x) for i, (c, _, _) in enumerate(head.scan) for y in range(head.components[c][2]) for x in range(head.components[c][1])]
    return -(-head.width // (8 * hmax)), -(-head.height // (8 * vmax)), order


def unstuffed(scan: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes without stuffing and markers, and where each restart segment starts in them."""
    ff = np.flatnonzero(scan[:-1] == 0xFF)
    follow = scan[ff + 1]
    ends = ff[(follow != 0) & (follow != 0xFF) & ((follow < 0xD0) | (follow > 0xD7))]
    stop = int(ends[0]) if len(ends) else len(scan)
    ff, follow = ff[ff < stop], follow[ff < stop]
    keep = np.ones(stop, bool)
    keep[(ff + 1)[(follow == 0) & (ff + 1 < stop)]] = False
    restarts = ff[(follow >= 0xD0) & (follow <= 0xD7)]
    keep[restarts] = False
    keep[restarts[restarts + 1 < stop] + 1] = False
    before = np.cumsum(keep)
    starts = np.concatenate(([0], before[restarts])).astype(np.int64)
    return scan[:stop][keep], starts


def coefficients(files: list[tuple[Header, bytes]]) -> list[np.ndarray]:
    """For each file its coefficients, blocks in scan order x 64 in zig-zag order. All files must share tables and layout of an MCU."""
    first = files[0][0]
    _, _, order = layout(first)
    tables = [(lookup(first.huffman[dc]), lookup(first.huffman[16 + ac])) for _, dc, ac in first.scan]
    buffers, starts, mcus, base, blocks, at = [], [], [], [], [0], 0
    for head, data in files:
        across, down, _ = layout(head)
        n = across * down
        buf, seg = unstuffed(np.frombuffer(data, np.uint8)[head.data_at :])
        every = head.restart or n
        want = -(-n // every)
        if len(seg) < want:
            raise ValueError("restart segments are missing")
        starts.append(seg[:want] + at)
        mcus.append(np.minimum(every, n - every * np.arange(want)))
        base.append((blocks[-1] + every * np.arange(want)) * len(order) if len(order) == 1 else blocks[-1] + every * np.arange(want) * len(order))
        blocks.append(blocks[-1] + n * len(order))
        buffers.append(buf)
        at += len(buf)
    buf = np.concatenate([*buffers, np.zeros(16, np.uint8)])
    ahead = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, 8)).view(">u8").reshape(-1).astype(np.uint64)
    bit, left, block = np.concatenate(starts) * 8, np.concatenate(mcus), np.concatenate(base)
    out = np.zeros((blocks[-1], 64), np.int16)
    flat = out.reshape(-1)
    predicted = np.zeros((len(first.scan), len(bit)), np.int64)
    last = len(ahead) - 1
    one = np.uint64(1)

    def symbols(pos: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next symbol of each segment, the value of its additional bits, and the bits that both take."""
        if len(pos) and int(pos.max()) >> 3 > last:
            raise ValueError("the scan ends early")
        word = ahead[pos >> 3] << (pos & 7).astype(np.uint64)
        code = (word >> np.uint64(48)).astype(np.int64)
        bits = table[0][code]
        if len(bits) and not bits.all():
            raise ValueError("no such Huffman code")
        symbol = table[1][code].astype(np.int64)
        size = symbol & 15
        wide = size.astype(np.uint64)
        more = ((word << bits.astype(np.uint64)) >> (np.uint64(63) - wide) >> one).astype(np.int64)
        span = np.left_shift(1, size)
        return symbol, np.where(2 * more < span, more - span + 1, more) * (size > 0), bits.astype(np.int64) + size

    for m in range(int(left.max())):
        live = np.flatnonzero(left > m)
        for j, (c, _, _) in enumerate(order):
            dc, ac = tables[c]
            where = (block[live] + m * len(order) + j) * 64
            _, value, used = symbols(bit[live], dc)
            bit[live] += used
            predicted[c, live] += value
            flat[where] = predicted[c, live]
            seg, place, k = live, where, np.ones(len(live), np.int64)
            while len(seg):
                symbol, value, used = symbols(bit[seg], ac)
                bit[seg] += used
                k = k + (symbol >> 4)
                some = (symbol & 15) > 0
                if (k[some] > 63).any():
                    raise ValueError("a block has too many coefficients")
                flat[(place + np.minimum(k, 63))[some]] = value[some]
                k += 1
                more = ((symbol != 0) & (k < 64))
                if not more.all():
                    seg, place, k = seg[more], place[more], k[more]
    return [out[a:b] for a, b in zip(blocks, blocks[1:], strict=False)]


def read(files: list[bytes]) -> list[tuple[Header, np.ndarray]]:
    """Decode files together; those with other tables or sampling form a batch of their own."""
    heads = [parse(x) for x in files]
    groups: dict[tuple, list[int]] = {}
    for i, h in enumerate(heads):
        key = (tuple(sorted(h.huffman.items())), tuple(h.scan), tuple((c[1], c[2]) for c in h.components))
        groups.setdefault(key, []).append(i)
    out: list = [None] * len(files)
    for members in groups.values():
        for i, c in zip(members, coefficients([(heads[i], files[i]) for i in members]), strict=True):
            out[i] = (heads[i], c)
    return out


def thumbnail(head: Header, coefs: np.ndarray) -> np.ndarray:
    """One luminance pixel for each 8 x 8 block, from the DC coefficients alone."""
    across, down, order = layout(head)
    component = head.components[head.scan[0][0]]
    mine = [j for j, o in enumerate(order) if o[0] == 0]
    h, v = (1, 1) if len(order) == 1 else (component[1], component[2])
    dc = coefs[:, 0].reshape(down, across, len(order))[:, :, mine].astype(np.int64) * int(head.quant[component[3]][0])
    dc = dc.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
    hmax, vmax = max(c[1] for c in head.components), max(c[2] for c in head.components)
    rows, cols = -(-head.height * component[2] // (8 * vmax)), -(-head.width * component[1] // (8 * hmax))
    return np.clip(np.rint(dc[:rows, :cols] / 8 + 128), 0, 255).astype(np.uint8)


def thumbnail_hash(pixels: np.ndarray) -> str:
    """64 bits: whether each cell of an 8 x 8 grid is brighter than the mean of the cells."""
    rows, cols = (np.arange(8) * n // 8 for n in pixels.shape)
    sums = np.add.reduceat(np.add.reduceat(pixels.astype(np.int64), rows, axis=0), cols, axis=1)
    high = [np.maximum(np.diff(np.append(e, n)), 1) for e, n in ((rows, pixels.shape[0]), (cols, pixels.shape[1]))]
    cells = sums / (high[0][:, None] * high[1][None, :])
    return np.packbits((cells > cells.mean()).reshape(-1)).tobytes().hex()


def payload(head: Header, coefs: np.ndarray) -> bytes:
    """The bytes that write() has put into the coefficients. DC coefficients are no differences here: every block restarts."""
    size = int(head.comment.removeprefix(b"payload "))
    values = coefs.reshape(-1)[:size].astype(np.int64)
    return np.where(values < 0, values + 255, values).astype(np.uint8).tobytes()
