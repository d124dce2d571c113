"""Media columns: FLAC.

The decoder reads whole streams: it finds frames by their checked headers, verifies
the CRC-8 of every header and the CRC-16 of every frame (bytes inside a frame that
look like the next header are passed over), decodes Rice residuals,
restores constant, verbatim, fixed and linear predictors of one to eight channels
(with left, right and middle/side pairs), and compares the MD5 of the samples with
the stream's.  ``pcm_blocks`` writes a row of PCM for each frame with the offset of
its first sample, so that any range of samples is found by a filter.

All frames of a bounded slice of rows are decoded side by side: sample i of every
frame in one array operation.  The encoder (8-bit mono, blocks of 576, a seek
table) does the same; it is what stores texts as media.

Null media give null results; a damaged stream raises an error that names the row.
Null texts are stored as empty ones.  Repeated rows get equal results, and very
long texts are stored whole, with one more frame for each 576 bytes.  Other columns
may have any names.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_of

BLOCK = 576
RATE_CODE, RATE = 4, 8000
SEEK_EVERY = 16
PARTS = 4  # Rice partitions of a frame, as the encoder writes them
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
LPC_ORDER, LPC_BITS = 4, 10


# --- checksums ----------------------------------------------------------------


@functools.cache
def _crc_table(poly: int, bits: int) -> np.ndarray:
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    out = np.zeros(256, np.uint32)
    for b in range(256):
        c = b << (bits - 8)
        for _ in range(8):
            c = (c << 1 ^ poly) & mask if c & top else c << 1 & mask
        out[b] = c
    return out


def crc8(rows: np.ndarray) -> np.ndarray:
    """Of each row of bytes; zeros in front don't count."""
    table, c = _crc_table(0x07, 8), np.zeros(len(rows), np.uint32)
    for col in rows.T:
        c = table[c ^ col]
    return c


def crc16(rows: np.ndarray) -> np.ndarray:
    """Of each row of bytes; zeros in front don't count."""
    table, c = _crc_table(0x8005, 16), np.zeros(len(rows), np.uint32)
    for col in np.ascontiguousarray(rows.T):
        c = table[c >> 8 ^ col] ^ (c << 8 & 0xFFFF)
    return c


def _right_aligned(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The byte ranges as rows, filled with zeros in front."""
    width = int((end - start).max(initial=0))
    at = end[:, None] - width + np.arange(width)
    return np.where(at >= start[:, None], data[np.maximum(at, 0)], 0).astype(np.uint8)


# --- encoder ------------------------------------------------------------------


def _number_bytes(n: int) -> bytes:
    """A frame number in the UTF-8 like code of FLAC."""
    if n < 128:
        return bytes([n])
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1))
    tail = [0x80 | n >> 6 * i & 0x3F for i in range(size - 2, -1, -1)]
    return bytes([(0xFF << (8 - size - 1) & 0xFF if size == 7 else 0xFF << (8 - size) & 0xFF) | n >> 6 * (size - 1), *tail])


@functools.lru_cache(maxsize=1 << 14)
def _header(number: int) -> bytes:
    raw = bytes([0xFF, 0xF8, 0x20 | RATE_CODE, 0x02]) + _number_bytes(number)
    return raw + bytes([int(crc8(np.frombuffer(raw, np.uint8)[None])[0])])


def _lpc(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients (frames, order) and shifts, by Levinson's recursion."""
    f = x.astype(float)
    lag = np.stack([(f[:, k:] * f[:, : f.shape[1] - k]).sum(1) for k in range(LPC_ORDER + 1)], 1)
    error, a = lag[:, 0] + 1e-9, np.zeros((len(x), LPC_ORDER))
    for i in range(LPC_ORDER):
        k = (lag[:, i + 1] - (a[:, :i] * lag[:, i:0:-1]).sum(1)) / error
        a[:, :i], a[:, i] = a[:, :i] - k[:, None] * a[:, :i][:, ::-1], k
        error = np.maximum(error * (1 - k * k), 1e-9)
    top = np.abs(a).max(1)
    shift = np.clip(LPC_BITS - 2 - np.frexp(np.maximum(top, 1e-9))[1], 0, 15)
    limit = 1 << (LPC_BITS - 1)
    return np.clip(np.rint(a * 2.0 ** shift[:, None]), -limit, limit - 1).astype(np.int64), shift.astype(np.int64)


def _predict(x: np.ndarray, coef: np.ndarray, shift: np.ndarray, order: int) -> np.ndarray:
    out = np.zeros((len(x), x.shape[1] - order), np.int32)
    coef, shift = coef.astype(np.int32), shift.astype(np.int32)
    for j in range(order):
        out += coef[:, j, None] * x[:, order - 1 - j : x.shape[1] - 1 - j]
    return x[:, order:] - (out >> shift[:, None])


def _encode_frames(x: np.ndarray, numbers: list[int]) -> list[bytes]:
    """Frames for rows of 576 samples."""
    n = len(x)
    coef, shift = _lpc(x)
    zero = np.zeros(n, np.int64)
    residual = [np.concatenate([np.zeros((n, o), np.int32), _predict(x, np.tile(np.array(FIXED[o], np.int64), (n, 1)), zero, o)], 1) for o in range(3)]
    residual.append(np.concatenate([np.zeros((n, LPC_ORDER), np.int32), _predict(x, coef, shift, LPC_ORDER)], 1))
    kind = np.argmin(np.stack([np.abs(r).sum(1) for r in residual], 1), 1)
    order = np.array([0, 1, 2, LPC_ORDER])[kind]
    r = np.stack(residual)[kind, np.arange(n)]
    coded = (r << 1) ^ (r >> 31)
    part = coded.reshape(n, PARTS, -1)
    size = np.full((n, PARTS), part.shape[2])
    size[:, 0] -= order
    mean = part.sum(2) / size
    rice = np.clip(np.frexp(np.maximum(mean * 0.7, 1e-9))[1], 0, 14).astype(np.int32)
    k = np.repeat(rice, part.shape[2], 1)
    length = (coded >> k) + 1 + k
    one = np.int32(1) << k
    value = one | (coded & (one - 1))
    warm = np.arange(BLOCK) < order[:, None]
    length[warm] = 0
    value[warm] = 0
    # Columns: subframe, warm-up, precision and shift, coefficients, method, then
    # for each partition its parameter and samples.
    head = 1 + LPC_ORDER + 1 + LPC_ORDER + 1
    v, w = np.zeros((n, head + PARTS + BLOCK), np.int32), np.zeros((n, head + PARTS + BLOCK), np.int32)
    linear = kind == 3
    v[:, 0], w[:, 0] = np.where(linear, 0x40 | (LPC_ORDER - 1) << 1, 0x10 | order << 1), 8
    for j in range(LPC_ORDER):
        v[:, 1 + j], w[:, 1 + j] = x[:, j] & 0xFF, np.where(j < order, 8, 0)
        v[:, 6 + j], w[:, 6 + j] = coef[:, j] & ((1 << LPC_BITS) - 1), np.where(linear, LPC_BITS, 0)
    v[:, 5], w[:, 5] = (LPC_BITS - 1) << 5 | shift, np.where(linear, 9, 0)
    v[:, 10], w[:, 10] = PARTS.bit_length() - 1, 6
    each = BLOCK // PARTS
    for q in range(PARTS):
        at = head + q * (each + 1)
        v[:, at], w[:, at] = rice[:, q], 4
        v[:, at + 1 : at + 1 + each], w[:, at + 1 : at + 1 + each] = value[:, q * each : (q + 1) * each], length[:, q * each : (q + 1) * each]
    plain = w.sum(1) >= 8 * (1 + BLOCK)
    flat = (x == x[:, :1]).all(1)
    for rows, code in ((plain & ~flat, 0x02), (flat, 0x00)):
        v[rows], w[rows] = 0, 0
        v[rows, 0], w[rows, 0] = code, 8
    for q in range(PARTS):
        at = head + q * (each + 1) + 1
        rows = plain & ~flat
        v[rows, at : at + each], w[rows, at : at + each] = x[rows, q * each : (q + 1) * each] & 0xFF, 8
    v[flat, 1], w[flat, 1] = x[flat, 0] & 0xFF, 8

    heads = [_header(i) for i in numbers]
    lead = np.array([len(h) for h in heads])
    total = w.sum(1)
    whole = lead + (total + 7) // 8
    start = np.cumsum(whole) - whole
    last = (start + lead)[:, None] * 8 + np.cumsum(w, 1, dtype=np.int64) - 1  # place of each field's last bit
    v[w == 0] = 0
    used = v != 0
    bit, num = last[used], v[used]
    out = np.zeros(int(whole.sum()) + 8, np.float64)
    byte, num = bit >> 3, num << (7 - (bit & 7))
    for i in range(4):
        some = num >> (8 * i) & 0xFF
        on = some != 0
        if i == 0 or on.any():
            out += np.bincount(byte[on] - i, some[on], len(out))
    data = out.astype(np.uint8)
    joined, begin = np.frombuffer(b"".join(heads), np.uint8), np.cumsum(lead) - lead
    data[np.repeat(start - begin, lead) + np.arange(len(joined))] = joined
    sums = crc16(_right_aligned(data, start, start + whole))
    raw = data.tobytes()
    return [raw[a : a + b] + int(c).to_bytes(2, "big") for a, b, c in zip(start.tolist(), whole.tolist(), sums.tolist(), strict=True)]


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC streams of 8-bit payloads whose lengths are multiples of 576."""
    counts = [len(p) // BLOCK for p in payloads]
    x = (np.frombuffer(b"".join(payloads), np.uint8).astype(np.int32) - 128).reshape(-1, BLOCK)
    numbers = [i for n in counts for i in range(n)]
    frames: list[bytes] = []
    for a in range(0, len(x), 1024):
        frames += _encode_frames(x[a : a + 1024], numbers[a : a + 1024])
    out, at = [], 0
    for payload, n in zip(payloads, counts, strict=True):
        own = frames[at : at + n]
        at += n
        sizes = [len(f) for f in own]
        digest = hashlib.md5((np.frombuffer(payload, np.uint8) - np.uint8(128)).tobytes()).digest()
        packed = RATE << 44 | 0 << 41 | 7 << 36 | n * BLOCK
        info = BLOCK.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + packed.to_bytes(8, "big") + digest
        offset = np.cumsum([0, *sizes[:-1]]).tolist()
        seek = b"".join((i * BLOCK).to_bytes(8, "big") + offset[i].to_bytes(8, "big") + BLOCK.to_bytes(2, "big") for i in range(0, n, SEEK_EVERY))
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + b"".join(own))
    return out


# --- decoder ------------------------------------------------------------------


@dataclass
class Info:
    """Of a stream: what its first metadata block says, and where frames begin."""

    rate: int
    channels: int
    bits: int
    samples: int
    md5: bytes
    block: int
    frames_at: int
    seek: list[tuple[int, int]]


def stream_info(data: bytes) -> Info:
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, last, info, seek = 4, False, None, []
    while not last:
        last, kind, size = bool(data[at] & 0x80), data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4], "big")
        body = data[at + 4 : at + 4 + size]
        at += 4 + size
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            info = (packed >> 44, (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & (1 << 36) - 1, body[18:34], int.from_bytes(body[2:4], "big"))
        elif kind == 3:
            seek = [(int.from_bytes(body[i : i + 8], "big"), int.from_bytes(body[i + 8 : i + 16], "big")) for i in range(0, size, 18)]
    if info is None:
        raise ValueError("no stream info")
    return Info(*info, at, [p for p in seek if p[0] != (1 << 64) - 1])


#: Block sizes and sample sizes by their codes in a frame's header.
_BLOCKS = {1: 192, **{i: 576 << (i - 2) for i in range(2, 6)}, **{i: 256 << (i - 8) for i in range(8, 16)}}
_DEPTHS = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}


def _frame_header(data: bytes, at: int, info: Info) -> tuple[int, int, int, int, int] | None:
    """(number, block size, channel code, bits, header size) if a valid frame
    header stands there."""
    h = data[at : at + 16]
    if len(h) < 6 or h[0] != 0xFF or h[1] & 0xFE != 0xF8 or h[3] & 1:
        return None
    lead = h[4]
    size = 1 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length()
    if size > 7 or 0x80 <= lead < 0xC0:
        return None
    number = lead if size == 1 else lead & ((1 << (7 - size)) - 1)
    for b in h[5 : 4 + size]:
        number = number << 6 | b & 0x3F
    end, code = 4 + size, h[2] >> 4
    if code in (6, 7):
        block = int.from_bytes(h[end : end + code - 5], "big") + 1
        end += code - 5
    else:
        block = _BLOCKS.get(code, 0)
    end += {12: 1, 13: 2, 14: 2}.get(h[2] & 15, 0)
    depth = _DEPTHS.get(h[3] >> 1 & 7, info.bits if h[3] >> 1 & 7 == 0 else 0)
    if not block or not depth or h[3] >> 4 > 10 or len(h) <= end:
        return None
    table, c = _crc_table(0x07, 8), 0
    for b in h[: end + 1]:
        c = int(table[c ^ b])
    return None if c else (number if h[1] == 0xF8 else -1, block, h[3] >> 4, depth, end + 1)


Frame = tuple[int, int, int, int, int, int, int]


def _frames(data: bytes, info: Info, checked: bool = False) -> list[Frame]:
    """(start, end, first sample, block size, channel code, bits, header size) of
    each frame: the next frame starts where a valid header carries the next number
    and, with ``checked``, the bytes up to it pass their CRC-16."""
    out, at, sample, head = [], info.frames_at, 0, _first_header(data, info)
    while head is not None:
        number, block, code, depth, size = head
        end, head = at + size, None
        while True:
            end = data.find(b"\xff", end)
            if end < 0:
                end = len(data)
                break
            if data[end + 1 : end + 2] in (b"\xf8", b"\xf9") and (after := _frame_header(data, end, info)) and after[0] in (number + 1, -1):
                if after[0] == number + 1 and not checked or not _crc16_of(data[at:end]):
                    head = after
                    break
            end += 1
        out.append((at, end, sample, block, code, depth, size))
        at, sample = end, sample + block
    return out


def _walked(data: bytes, info: Info) -> list[Frame]:
    """As ``_frames``, but each frame ends where its own samples do."""
    out, at, sample, head = [], info.frames_at, 0, _first_header(data, info)
    bits = _Bits(np.frombuffer(data, np.uint8))
    while head is not None:
        _, block, code, depth, size = head
        row = np.array([(at, len(data), sample, block, code, depth, size)], np.int64)
        end = int(_samples(bits, row)[1][0])
        out.append((at, end, sample, block, code, depth, size))
        at, sample = end, sample + block
        head = _frame_header(data, at, info)
    if at != len(data):
        raise ValueError("no frame where one should start")
    return out


def _first_header(data: bytes, info: Info) -> tuple[int, int, int, int, int] | None:
    head = _frame_header(data, info.frames_at, info)
    if head is None and (info.frames_at != len(data) or info.samples):
        raise ValueError("no frame after the metadata")
    return head


def _crc16_of(raw: bytes) -> int:
    table, c = _crc_list(), 0
    for b in raw:
        c = table[c >> 8 ^ b] ^ (c << 8 & 0xFFFF)
    return c


@functools.cache
def _crc_list() -> list[int]:
    return _crc_table(0x8005, 16).tolist()


class _Bits:
    """Reads bit fields at many places of one byte array."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        self.words = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1)).copy().view(">u8").ravel().astype(np.uint64)

    def window(self, pos: np.ndarray) -> np.ndarray:
        """57 bits or more from each position, at the top of a word."""
        return self.words[np.minimum(pos >> 3, len(self.words) - 1)] << (pos & 7).astype(np.uint64)

    def read(self, pos: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        # Two shifts, since one by 64 is not defined.
        return (self.window(pos) >> np.uint64(1) >> np.asarray(63 - width, np.uint64)).astype(np.int64)

    def signed(self, pos: np.ndarray, width: np.ndarray) -> np.ndarray:
        x = self.read(pos, width)
        return x - ((x >> np.maximum(width - 1, 0) & 1) << width) * (width > 0)

    def zeros(self, pos: np.ndarray) -> np.ndarray:
        """Zero bits before the next one bit."""
        x = self.window(pos) >> np.uint64(11)
        out = 53 - np.frexp(x.astype(float))[1].astype(np.int64)
        todo = np.flatnonzero(x == 0)
        while len(todo):
            x = self.window(pos[todo] + out[todo]) >> np.uint64(11)
            out[todo] += 53 - np.frexp(x.astype(float))[1]
            if ((pos[todo] + out[todo]) >> 3 > len(self.words) + 8).any():
                raise ValueError("a Rice code runs over the end")
            todo = todo[x == 0]
        return out


def _subframes(bits: _Bits, pos: np.ndarray, block: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples (frames, longest block) of one channel, and the place after it."""
    n, longest = len(pos), int(block.max())
    head = bits.read(pos, 8)
    pos = pos + 8
    kind, wasted = head >> 1 & 0x3F, np.zeros(n, np.int64)
    some = np.flatnonzero(head & 1)
    if len(some):
        wasted[some] = bits.zeros(pos[some]) + 1
        pos[some] += wasted[some]
    depth = depth - wasted
    linear, fixed = kind >= 32, (kind >= 8) & (kind <= 12)
    if not (linear | fixed | (kind <= 1)).all():
        raise ValueError("a reserved kind of subframe")
    order = np.where(linear, kind - 31, np.where(fixed, kind - 8, 0))
    x = np.zeros((n, longest), np.int64)
    for j in range(int(order.max(initial=0))):
        on = order > j
        x[on, j] = bits.signed(pos[on], depth[on])
        pos[on] += depth[on]
    constant = np.flatnonzero(kind == 0)
    if len(constant):
        x[constant] = bits.signed(pos[constant], depth[constant])[:, None]
        pos[constant] += depth[constant]
    coef, shift = np.zeros((n, max(4, int(order.max(initial=0)))), np.int64), np.zeros(n, np.int64)
    for o, c in enumerate(FIXED):
        coef[fixed & (order == o), :o] = c
    on = np.flatnonzero(linear)
    if len(on):
        precision = bits.read(pos[on], 4) + 1
        shift[on] = bits.signed(pos[on] + 4, np.full(len(on), 5))
        pos[on] += 9
        for j in range(int(order[on].max())):
            more = order[on] > j
            coef[on[more], j] = bits.signed(pos[on[more]], precision[more])
            pos[on[more]] += precision[more]
    coded = linear | fixed
    wide, parts = np.zeros(n, np.int64), np.zeros(n, np.int64)
    on = np.flatnonzero(coded)
    if len(on):
        wide[on] = 4 + bits.read(pos[on], 2)
        parts[on] = bits.read(pos[on] + 2, 4)
        pos[on] += 6
        if (wide[on] > 5).any():
            raise ValueError("a reserved residual method")
        if (block[on] >> parts[on] << parts[on] != block[on]).any() or (block[on] >> parts[on] < order[on]).any():
            raise ValueError("partitions that don't fit the block")
    plain = np.flatnonzero(kind == 1)
    for size in np.unique(block[plain]):
        some = plain[block[plain] == size]
        at = pos[some, None] + depth[some, None] * np.arange(size)
        x[some, :size] = bits.signed(at, np.broadcast_to(depth[some, None], at.shape))
        pos[some] += depth[some] * size
    c = np.flatnonzero(coded)
    if len(c):
        x[c], pos[c] = _restore(bits, pos[c], block[c], order[c], wide[c], block[c] >> parts[c], coef[c], shift[c], x[c])
    return x << wasted[:, None], pos


def _restore(bits: _Bits, pos: np.ndarray, block: np.ndarray, order: np.ndarray, wide: np.ndarray, each: np.ndarray, coef: np.ndarray, shift: np.ndarray,
    warm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Predicted samples of frames side by side, from their coded residuals."""
    x, taps = np.ascontiguousarray(warm.T), np.ascontiguousarray(coef.T)
    n, first, shortest = len(pos), int(order.max()), int(block.min())
    rice, raw, escapes = np.zeros(n, np.int64), np.full(n, -1, np.int64), False
    step = int(np.gcd.reduce(each))
    down, up = np.maximum(shift, 0), np.maximum(-shift, 0)
    for i in range(len(x)):
        if i <= first or i % step == 0:
            fresh = np.flatnonzero((i < block) & (i >= order) & ((i % each == 0) | (i == order)))
            got = bits.read(pos[fresh], wide[fresh])
            pos[fresh] += wide[fresh]
            rice[fresh], raw[fresh] = got, -1
            escaped = fresh[got == (1 << wide[fresh]) - 1]
            if len(escaped):
                escapes = True
                raw[escaped] = bits.read(pos[escaped], 5)
                pos[escaped] += 5
        whole = i >= first and i < shortest and not escapes
        on = slice(None) if whole else np.flatnonzero((i < block) & (i >= order) & (raw < 0))
        p, k = pos[on], rice[on]
        q = bits.zeros(p)
        p = p + q + 1
        u = q << k | bits.read(p, k)
        pos[on] = p + k
        residual = (u >> 1) ^ -(u & 1)
        if whole:
            x[i] = residual
        else:
            x[i, on] = residual
            if escapes and len(rest := np.flatnonzero((i < block) & (i >= order) & (raw >= 0))):
                x[i, rest] = bits.signed(pos[rest], raw[rest])
                pos[rest] += raw[rest]
        if i:
            width = min(i, len(taps))
            predicted = np.einsum("ij,ij->j", x[i - width : i][::-1], taps[:width])
            predicted = predicted >> down << up
            x[i] += predicted if whole else np.where((i < block) & (i >= order), predicted, 0)
    return x.T, pos


@dataclass
class Pcm:
    """Decoded: samples (samples, channels), and the first sample, size and bytes
    of each frame."""

    info: Info
    samples: np.ndarray
    frames: list[tuple[int, int, int]]


def _samples(bits: _Bits, rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Samples (samples, channels) of each frame, and the place after its CRC-16."""
    start, _, _, block, code, depth, head = rows.T
    channels = np.where(code < 8, code + 1, 2)
    pos = (start + head) * 8
    side = np.stack([code == 9, (code == 8) | (code == 10)], 1)  # channels with one bit more
    got = np.zeros((len(pos), int(channels.max()), int(block.max())), np.int64)
    for c in range(got.shape[1]):
        on = np.flatnonzero(channels > c)
        extra = side[on, c].astype(np.int64) if c < 2 else 0
        x, pos[on] = _subframes(bits, pos[on], block[on], depth[on] + extra)
        got[on, c, : x.shape[1]] = x
    pair = got[:, :2]
    left, right, middle = (np.flatnonzero(code == v) for v in (8, 9, 10))
    if len(left):
        pair[left, 1] = pair[left, 0] - pair[left, 1]
    if len(right):
        pair[right, 0] += pair[right, 1]
    if len(middle):
        m, d = pair[middle, 0] << 1 | pair[middle, 1] & 1, pair[middle, 1]
        pair[middle, 0], pair[middle, 1] = (m + d) >> 1, (m - d) >> 1
    return [got[i, : channels[i], : block[i]].T for i in range(len(pos))], (pos + 7 >> 3) + 2


def _decoded_frames(streams: list[bytes], infos: list[Info], found: list[list[Frame]]) -> list[Pcm]:
    base = np.cumsum([0, *map(len, streams)])
    data = np.frombuffer(b"".join(streams), np.uint8)
    rows = np.array([(base[i] + f[0], base[i] + f[1], *f[2:]) for i, frames in enumerate(found) for f in frames], np.int64).reshape(-1, 7)
    blocks: list[np.ndarray] = []
    bits = _Bits(data)
    for a in range(0, len(rows), 4096):
        part = rows[a : a + 4096]
        if crc16(_right_aligned(data, part[:, 0], part[:, 1])).any():
            raise ValueError("a frame fails its CRC-16")
        x, end = _samples(bits, part)
        if (end != part[:, 1]).any():
            raise ValueError("a frame has bytes left over")
        blocks += x
    out, at = [], 0
    for info, frames in zip(infos, found, strict=True):
        own = blocks[at : at + len(frames)]
        at += len(frames)
        x = np.ascontiguousarray(np.concatenate(own)) if own else np.zeros((0, info.channels), np.int64)
        if info.samples and len(x) != info.samples:
            raise ValueError("samples are missing")
        wide = -(-info.bits // 8)
        raw = x.astype("<i8").view(np.uint8).reshape(len(x), -1, 8)[:, :, :wide].tobytes()
        if any(info.md5) and hashlib.md5(raw).digest() != info.md5:
            raise ValueError("samples fail their MD5")
        out.append(Pcm(info, x, [(f[2], f[3], f[1] - f[0]) for f in frames]))
    return out


def decode(streams: list[bytes]) -> list[Pcm]:
    """All samples of the streams, every checksum verified.  Frames are taken to end
    at the first header with the next number; only a stream whose checksums deny that
    is read again, first with a CRC-16 for each such header, then frame by frame."""
    infos = [stream_info(s) for s in streams]
    try:
        return _decoded_frames(streams, infos, [_frames(s, i) for s, i in zip(streams, infos, strict=True)])
    except ValueError:
        if len(streams) > 1:
            return [pcm for s in streams for pcm in decode([s])]
    try:
        return _decoded_frames(streams, infos, [_frames(streams[0], infos[0], checked=True)])
    except ValueError as error:
        try:
            return _decoded_frames(streams, infos, [_walked(streams[0], infos[0])])
        except ValueError:
            raise error from None


def pcm_bytes(x: np.ndarray, bits: int) -> bytes:
    """Samples as in a WAV file: unsigned to 8 bits, little-endian signed above."""
    if bits <= 8:
        return (x + 128).astype(np.uint8).tobytes()
    wide = -(-bits // 8)
    return np.ascontiguousarray(x).astype("<i8").view(np.uint8).reshape(*x.shape, 8)[..., :wide].tobytes()


# --- DataFrames ---------------------------------------------------------------


def padded(text: str) -> tuple[bytes, int]:
    """A text's bytes up to a positive multiple of 576, and their number before."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (-len(raw) % BLOCK or (0 if raw else BLOCK)), len(raw)


def store_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, media (a FLAC stream of the padded text) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        payloads, sizes = zip(*map(padded, batch.column(1).to_pylist()), strict=True)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(encode(list(payloads)), pa.binary())], ["doc_id", "n_bytes", "media"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return map_batches(source, run, "doc_id long, n_bytes long, media binary", limit=1 << 21)


def _decoded(batch: pa.RecordBatch) -> list[Pcm | None]:
    media = batch.column(batch.schema.get_field_index("media")).to_pylist()
    some = [i for i, m in enumerate(media) if m is not None]
    out: list[Pcm | None] = [None] * len(media)
    try:
        for i, pcm in zip(some, decode([media[i] for i in some]), strict=True):
            out[i] = pcm
    except ValueError as error:
        for i in some:  # which one?
            try:
                decode([media[i]])
            except ValueError:
                raise ValueError(f"row {batch.column(0)[i].as_py()}: {error}") from error
        raise
    return out


def blocks(pcm: Pcm) -> list[tuple[int, int, bytes]]:
    """Sample offset, samples and PCM bytes of each frame: any of them can be sought by its offset."""
    return [(a, n, pcm_bytes(pcm.samples[a : a + n], pcm.info.bits)) for a, n, _ in pcm.frames]


def pcm_blocks(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """key, sample_offset, n_samples, channels, bits, rate, pcm: a row for each
    frame, with the offset of its first sample in its stream."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for k, pcm in zip(batch.column(0).to_pylist(), _decoded(batch), strict=True):
            if pcm is not None:
                i = pcm.info
                rows += [(k, a, n, i.channels, i.bits, i.rate, block) for a, n, block in blocks(pcm)]
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        types = [batch.schema.field(0).type] + [pa.int64()] * 5 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["key", "sample_offset", "n_samples", "channels", "bits", "rate", "pcm"]
    kind = media.schema[key].dataType.simpleString()
    source = media.select(F.col(key).alias("key"), F.col(column).alias("media"))
    out = map_batches(source, run, f"key {kind}, sample_offset long, n_samples long, channels long, bits long, rate long, pcm binary", column="media", limit=1 << 21)
    return out.withColumnRenamed("key", key)


def features(pcm: Pcm) -> str:
    """Whole numbers only, so equal samples give equal strings: frames, peak, sum of
    squares, sum of absolute steps and changes of sign of the first channel."""
    x = pcm.samples[:, 0] if len(pcm.samples) else np.zeros(0, np.int64)
    step = np.abs(np.diff(x)).sum()
    signs = np.count_nonzero((x[1:] < 0) != (x[:-1] < 0))
    return f"frames={len(pcm.frames)};peak={int(np.abs(x).max(initial=0))};energy={int((x * x).sum())};steps={int(step)};crossings={signs}"


def media_digests(media: DataFrame) -> DataFrame:
    """Of doc_id, n_bytes, media: the stored bytes read back, and their digests; status is ok,
    missing (a null medium) or the reason why a stream can't be read, and then the rest is null
    (but for the size and digest of a stream that is there)."""

    def read(raw: bytes | None) -> tuple:
        if raw is None:
            return (None,) * 6 + ("missing",)
        stored = (len(raw), hashlib.sha256(raw).hexdigest())
        try:
            (pcm,) = decode([raw])
        except ValueError as error:
            return (None, None, None, *stored, None, str(error))
        return of(pcm, raw)

    def of(pcm: Pcm, raw: bytes) -> tuple:
        # The payload is put together from its blocks, in the order of their sample offsets.
        payload = b"".join(block for _, _, block in sorted(blocks(pcm)))
        digest = hashlib.sha256(raw).hexdigest()
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(raw), digest, features(pcm), "ok"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raws = batch.column(2).to_pylist()
        some = [r for r in raws if r is not None]
        try:
            found = iter([of(pcm, raw) for pcm, raw in zip(decode(some), some, strict=True)])
            rows = [read(None) if r is None else next(found) for r in raws]
        except ValueError:  # a damaged one: each on its own
            rows = [read(r) for r in raws]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "status"]
    types = ("long", "long", "long", "string", "long", "long", "string", "string", "string")
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
    return map_batches(media.select("doc_id", "n_bytes", "media"), run, schema, column="media", limit=1 << 21)

