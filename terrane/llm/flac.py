"""FLAC columns: a lossless coder and decoder for mono streams, done on whole columns of frames at once.

The coder picks, frame by frame, a constant, verbatim, fixed (order 0 to 2) or quantised linear (order 2)
predictor and a Rice parameter. The decoder finds frames by the seek table, or by sync codes with sound
header checksums; checks each header's CRC-8, each frame's CRC-16 and the stream's MD5; decodes Rice
residuals, with partitions and escapes, in step across frames; and undoes the predictors.

Defined cases: a null or empty text has a payload of padding only; a stream that isn't FLAC, isn't mono,
or fails a checksum raises ValueError in `decode` and gives null samples with the reason in the column
functions, and no blocks; long texts are coded whole; repeated rows each get a result; a kept column that
has the name of a result gives way to it; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from .common import columns_of, map_texts, slices

BLOCK = 576
PAD = 255
RATE = 8000
# Fixed values of the format: sizes of blocks, rates and samples by their codes in a frame's header.
BLOCK_CODES = {1: 192, 2: 576, 3: 1152, 4: 2304, 5: 4608, 8: 256, 9: 512, 10: 1024, 11: 2048, 12: 4096, 13: 8192, 14: 16384, 15: 32768}
RATE_8K, BITS_CODES = 4, {1: 8, 2: 12, 4: 16, 5: 20, 6: 24}
LPC_PRECISION = 10
LPC_SHIFT = 8


@cache
def _crc_table(poly: int, width: int) -> np.ndarray:
    table = []
    for i in range(256):
        c = i << (width - 8)
        for _ in range(8):
            c = ((c << 1) ^ poly if c >> (width - 1) & 1 else c << 1) & ((1 << width) - 1)
        table.append(c)
    return np.array(table, np.uint16)


def crc8(data: bytes) -> int:
    table, c = _crc_table(0x07, 8), 0
    for b in data:
        c = int(table[c ^ b])
    return c


def crc16(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-16 of each stretch, a byte a step for all; leading zeros don't change it, so all end together."""
    table, most = _crc_table(0x8005, 16), int((end - start).max(initial=0))
    c = np.zeros(len(start), np.uint16)
    for left in range(most, 0, -1):
        at = end - left
        byte = np.where(at >= start, buf[np.maximum(at, 0)], 0)
        c = (c << np.uint16(8)) ^ table[(c >> np.uint16(8)) ^ byte]
    return c


def coded_number(n: int) -> bytes:
    """A frame's number as the format writes it, like UTF-8 up to 36 bits."""
    if n < 0x80:
        return bytes([n])
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1))
    tail = bytes(0x80 | n >> 6 * i & 0x3F for i in range(size - 2, -1, -1))
    return bytes([(0xFF << (8 - size) & 0xFF) | n >> 6 * (size - 1)]) + tail


@cache
def frame_header(number: int) -> bytes:
    head = bytes([0xFF, 0xF8, 2 << 4 | RATE_8K, 0 << 4 | 1 << 1]) + coded_number(number)
    return head + bytes([crc8(head)])


def _zigzag(e: np.ndarray) -> np.ndarray:
    return (e << 1) ^ (e >> 31)


def _put(bits: np.ndarray, at: np.ndarray, value: np.ndarray, width: int) -> None:
    for j in range(width):
        bits[at + j] = value >> (width - 1 - j) & 1


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """8-bit payloads, each a positive multiple of BLOCK bytes, as FLAC streams."""
    data = np.frombuffer(b"".join(payloads), np.uint8)
    s = data.reshape(-1, BLOCK).astype(np.int32) - 128
    counts = np.array([len(p) // BLOCK for p in payloads])
    number = np.arange(len(s)) - np.repeat(np.cumsum(counts) - counts, counts)
    # predictors: 0 to 2 fixed, 3 linear of order 2
    errors = [s, np.diff(s, 1, axis=1), np.diff(s, 2, axis=1)]
    r = [np.einsum("ij,ij->i", s[:, k:], s[:, : BLOCK - k]).astype(float) for k in range(3)]
    even = r[0] ** 2 - r[1] ** 2
    even[even <= 0] = 1.0
    top = (1 << (LPC_PRECISION - 1)) - 1
    coefs = np.clip(np.rint(np.stack([r[1] * (r[0] - r[2]) / even, (r[0] * r[2] - r[1] ** 2) / even], 1) * (1 << LPC_SHIFT)), -top - 1, top).astype(np.int32)
    errors.append(s[:, 2:] - ((coefs[:, :1] * s[:, 1:-1] + coefs[:, 1:] * s[:, :-2]) >> LPC_SHIFT))
    order, extra = (0, 1, 2, 2), (0, 0, 0, 9 + 2 * LPC_PRECISION)
    us = [_zigzag(e) for e in errors]
    rough = np.stack([u.sum(1, dtype=np.int64) for u in us], 1)
    kind = rough.argmin(1)
    bits = np.empty(len(s), np.int64)
    rice = np.zeros(len(s), np.int64)
    for p in range(4):
        rows = np.flatnonzero(kind == p)
        if len(rows):
            u = us[p][rows]
            cost = np.stack([(u >> k).sum(1, dtype=np.int64) + u.shape[1] * (k + 1) for k in range(9)], 1)
            rice[rows] = cost.argmin(1)
            bits[rows] = cost.min(1) + 8 * order[p] + extra[p] + 10
    kind[bits >= 8 * BLOCK] = 4  # verbatim
    bits[kind == 4] = 8 * BLOCK
    same = (s == s[:, :1]).all(1)
    kind[same], bits[same] = 5, 8
    headers = [frame_header(i) for i in number.tolist()]
    head = np.array([len(h) for h in headers])
    size = head + 1 + (bits + 7) // 8 + 2
    end = np.cumsum(size)
    start = end - size
    raw = np.zeros(int(end[-1]) * 8, np.uint8)
    at = (start + head) * 8
    codes = np.array([0b001000, 0b001001, 0b001010, 0b100001, 0b000001, 0b000000])
    _put(raw, at, codes[kind] << 1, 8)
    at = at + 8
    for p in range(4):
        rows = np.flatnonzero(kind == p)
        if not len(rows):
            continue
        pos = at[rows]
        for i in range(order[p]):
            _put(raw, pos, s[rows, i] & 0xFF, 8)
            pos = pos + 8
        if p == 3:
            _put(raw, pos, np.full(len(rows), (LPC_PRECISION - 1) << 5 | LPC_SHIFT), 9)
            for i in range(2):
                _put(raw, pos + 9 + LPC_PRECISION * i, coefs[rows, i] & ((1 << LPC_PRECISION) - 1), LPC_PRECISION)
            pos = pos + extra[3]
        _put(raw, pos, rice[rows], 10)  # method 0, one partition, its parameter
        pos = pos + 10
        for k in np.unique(rice[rows]).tolist():
            own = rice[rows] == k
            u = us[p][rows[own]]
            q = u >> k
            length = q + (k + 1)
            place = pos[own][:, None] + np.cumsum(length, 1) - (k + 1)
            _put(raw, place.ravel(), (u & ((1 << k) - 1) | 1 << k).ravel(), k + 1)
    rows = np.flatnonzero(kind == 4)
    if len(rows):
        place = at[rows][:, None] + 8 * np.arange(BLOCK)
        _put(raw, place.ravel(), (s[rows] & 0xFF).ravel(), 8)
    rows = np.flatnonzero(kind == 5)
    _put(raw, at[rows], s[rows, 0] & 0xFF, 8)
    buf = np.packbits(raw)
    for n in np.unique(head).tolist():
        rows = np.flatnonzero(head == n)
        buf[start[rows][:, None] + np.arange(n)] = np.frombuffer(b"".join(headers[i] for i in rows), np.uint8).reshape(-1, n)
    crc = crc16(buf, start, end - 2)
    buf[end - 2], buf[end - 1] = crc >> 8, crc & 0xFF
    out, a = [], 0
    for payload, n in zip(payloads, counts.tolist(), strict=True):
        own, first = slice(a, a + n), int(start[a])
        md5 = hashlib.md5((data[a * BLOCK : (a + n) * BLOCK] ^ 0x80).tobytes()).digest()
        info = BLOCK.to_bytes(2) * 2 + int(size[own].min()).to_bytes(3) + int(size[own].max()).to_bytes(3) + (RATE << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8) + md5
        seek = np.zeros(n, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")]))
        seek["sample"], seek["offset"], seek["count"] = np.arange(n) * BLOCK, start[own] - first, BLOCK
        seeks = seek.tobytes()
        out.append(b"fLaC\x00" + len(info).to_bytes(3) + info + b"\x83" + len(seeks).to_bytes(3) + seeks + buf[first : int(end[a + n - 1])].tobytes())
        a += n
    return out


class _Bits:
    """Reads fields at many places of one buffer at once."""

    def __init__(self, buf: np.ndarray):
        b = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint32)
        self.window = (b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]).astype(np.uint32)

    def peek(self, pos: np.ndarray) -> np.ndarray:
        """The 32 bits at each place, of which the first 25 are sound."""
        return self.window[pos >> 3] << (pos & 7).astype(np.uint32)

    def read(self, pos: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        """Unsigned fields of up to 25 bits."""
        return (self.peek(pos).astype(np.int64)) >> (32 - np.asarray(width, np.int64))

    def signed(self, pos: np.ndarray, width: np.ndarray | int) -> np.ndarray:
        v, width = self.read(pos, width), np.asarray(width, np.int64)
        return v - ((v >> np.maximum(width - 1, 0)) << width) * (width > 0)

    def rice(self, pos: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Folded values and the places after them."""
        word = self.peek(pos)
        q = 32 - np.frexp(word.astype(np.float64))[1].astype(np.int64)
        if int((q + k).max(initial=0)) < 25:
            rest = (word << (q + 1).astype(np.uint32)).astype(np.int64) >> (32 - k)
            return q << k | rest, pos + (q + 1 + k)
        q = np.zeros(len(pos), np.int64)
        open_ = np.ones(len(pos), bool)
        while open_.any():
            word = self.peek(pos) >> np.uint32(7)
            empty = open_ & (word == 0)
            done = open_ & ~empty
            zeros = 25 - np.frexp(word.astype(np.float64))[1].astype(np.int64)
            q = q + np.where(empty, 25, np.where(done, zeros, 0))
            pos = pos + np.where(empty, 25, np.where(done, zeros + 1, 0))
            open_ = empty
            if (pos >> 3).max() >= len(self.window):
                raise ValueError("a residual runs over the end")
        return q << k | self.read(pos, k), pos + k


def _frames_by_sync(data: bytes, first: int) -> list[int]:
    """Starts of frames: a sync code whose header has a sound checksum and the next number."""
    out, at, number = [], first, 0
    while (at := data.find(b"\xff\xf8", at)) >= 0:
        n = len(coded_number(number))
        extra = {6: 1, 7: 2}.get(data[at + 2] >> 4, 0) + {12: 1, 13: 2, 14: 2}.get(data[at + 2] & 15, 0) if at + 4 + n < len(data) else 0
        head = data[at : at + 4 + n + extra]
        if head[4 : 4 + n] == coded_number(number) and len(data) > at + len(head) and crc8(head) == data[at + len(head)]:
            out.append(at)
            number, at = number + 1, at + len(head)
        else:
            at += 1
    return out


def _parse(data: bytes) -> tuple[dict, list[int]]:
    """What the stream says of itself, and where its frames start."""
    if data[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, info, seeks = 4, None, None
    while True:
        if at + 4 > len(data):
            raise ValueError("metadata runs over the end")
        kind, size = data[at], int.from_bytes(data[at + 1 : at + 4])
        body = data[at + 4 : at + 4 + size]
        at += 4 + size
        if kind & 0x7F == 0:
            packed = int.from_bytes(body[10:18])
            info = {"rate": packed >> 44, "channels": (packed >> 41 & 7) + 1, "bits": (packed >> 36 & 31) + 1, "samples": packed & ((1 << 36) - 1), "md5": body[18:34]}
        elif kind & 0x7F == 3:
            table = np.frombuffer(body[: len(body) // 18 * 18], np.dtype([("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")]))
            seeks = table[table["sample"] != 2**64 - 1]
        if kind & 0x80:
            break
    if info is None:
        raise ValueError("no stream info")
    if info["channels"] != 1:
        raise ValueError("only mono streams are read")
    if seeks is not None and int(seeks["count"].sum()) == info["samples"]:  # a point for each frame
        return info, (at + seeks["offset"].astype(np.int64)).tolist()
    return info, _frames_by_sync(data, at)


def decode_streams(streams: list[bytes]) -> list[np.ndarray]:
    """Samples of each stream. Raises ValueError where a stream is broken."""
    if not streams:
        return []
    infos, starts, ends, owners, base = [], [], [], [], 0
    for i, data in enumerate(streams):
        info, at = _parse(data)
        infos.append(info)
        starts += [base + a for a in at]
        ends += [base + a for a in [*at[1:], len(data)]]
        owners += [i] * len(at)
        base += len(data)
    buf = np.frombuffer(b"".join(streams), np.uint8)
    start, end, owner = np.array(starts, np.int64), np.array(ends, np.int64), np.array(owners, np.int64)
    if not len(start):
        return [_checked(np.zeros(0, np.int64), info) for info in infos]
    if (end - start < 9).any() or (start < 0).any() or (end > len(buf)).any():
        raise ValueError("a frame is cut short")
    if (buf[start] != 0xFF).any() or (buf[start + 1] != 0xF8).any():
        raise ValueError("no sync code where a frame starts")
    if (crc16(buf, start, end - 2) != (buf[end - 2].astype(np.uint16) << 8 | buf[end - 1])).any():
        raise ValueError("a frame fails its checksum")
    parts: list[np.ndarray | None] = [None] * len(start)
    sizes, body, depth = [], [], []
    for a, i in zip(start.tolist(), owners, strict=True):
        code = int(buf[a + 2]) >> 4
        lead = int(buf[a + 4])
        n = 1 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length()
        at = a + 4 + n
        if code in (6, 7):
            size = 1 + int.from_bytes(buf[at : at + code - 5].tobytes())
            at += code - 5
        else:
            size = BLOCK_CODES[code]
        at += {12: 1, 13: 2, 14: 2}.get(int(buf[a + 2]) & 15, 0)
        key = buf[a:at].tobytes()
        if _header_crc(key) != buf[at]:
            raise ValueError("a header fails its checksum")
        sizes.append(size)
        body.append(at + 1)
        depth.append(BITS_CODES.get(int(buf[a + 3]) >> 1 & 7, infos[i]["bits"]))
    bits, size, body_at, depth_of = _Bits(buf), np.array(sizes), np.array(body, np.int64), np.array(depth)
    for n, d in sorted(set(zip(sizes, depth, strict=True))):
        rows = np.flatnonzero((size == n) & (depth_of == d))
        got = _subframes(bits, body_at[rows] * 8, n, d)
        for r, x in zip(rows.tolist(), got, strict=True):
            parts[r] = x
    out, a = [], 0
    for i, info in enumerate(infos):
        n = int((owner == i).sum()) if len(infos) == 1 else int(np.searchsorted(owner, i, "right") - np.searchsorted(owner, i, "left"))
        out.append(_checked(np.concatenate(parts[a : a + n]) if n else np.zeros(0, np.int64), info))
        a += n
    return out


@cache
def _header_crc(head: bytes) -> int:
    return crc8(head)


def _checked(samples: np.ndarray, info: dict) -> np.ndarray:
    if len(samples) != info["samples"]:
        raise ValueError("samples are missing")
    width = -(-info["bits"] // 8)
    raw = samples.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()
    if any(info["md5"]) and hashlib.md5(raw).digest() != info["md5"]:
        raise ValueError("samples fail the stream's checksum")
    return samples


def _subframes(bits: _Bits, pos: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Samples [frames, n] of mono subframes that start at the bit places pos."""
    head = bits.read(pos, 8)
    if (head & 0x80).any():
        raise ValueError("a subframe starts with a one")
    kind, wasted = head >> 1 & 0x3F, np.zeros(len(pos), np.int64)
    pos = pos + 8
    flagged = np.flatnonzero(head & 1)
    if len(flagged):
        zero, after = bits.rice(pos[flagged], np.zeros(len(flagged), np.int64))
        wasted[flagged], pos = zero + 1, pos.copy()
        pos[flagged] = after
    width = depth - wasted
    out = np.zeros((len(pos), n), np.int64)
    constant, verbatim = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    out[constant] = bits.signed(pos[constant], width[constant])[:, None]
    for i in range(n if len(verbatim) else 0):
        out[verbatim, i] = bits.signed(pos[verbatim] + i * width[verbatim], width[verbatim])
    fixed, linear = (kind >= 8) & (kind <= 12), kind >= 32
    if not (fixed | linear | (kind < 2)).all():
        raise ValueError("a reserved kind of subframe")
    coded = np.flatnonzero(fixed | linear)
    if len(coded):
        order = np.where(linear[coded], kind[coded] - 31, kind[coded] - 8)
        at, w = pos[coded].copy(), width[coded]
        rows = out[coded]
        for i in range(int(order.max())):
            has = np.flatnonzero(order > i)
            rows[has, i] = bits.signed(at[has], w[has])
            at[has] += w[has]
        lin = np.flatnonzero(linear[coded])
        coefs, shift = np.zeros((len(coded), 32), np.int64), np.zeros(len(coded), np.int64)
        if len(lin):
            precision = bits.read(at[lin], 4) + 1
            shift[lin] = bits.signed(at[lin] + 4, 5)
            at[lin] += 9
            for j in range(int(order[lin].max())):
                has = order[lin] > j
                coefs[lin[has], j] = bits.signed(at[lin[has]], precision[has])
                at[lin[has]] += precision[has]
        residual = _residuals(bits, at, order, n)
        for p in np.unique(order).tolist():
            own = np.flatnonzero((order == p) & ~linear[coded])
            if len(own):
                rows[own] = _undo_fixed(rows[own], residual[own], p)
            own = np.flatnonzero((order == p) & linear[coded])
            if len(own):
                rows[own] = _undo_linear(rows[own], residual[own], coefs[own, :p], shift[own])
        out[coded] = rows
    return out << wasted[:, None]


def _residuals(bits: _Bits, pos: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Residuals [frames, n]; the first `order` of a row stay zero."""
    method = bits.read(pos, 2)
    if (method > 1).any():
        raise ValueError("a reserved residual method")
    width = np.where(method == 1, 5, 4)
    span = n >> bits.read(pos + 2, 4)
    pos = pos + 6
    out = np.zeros((n, len(pos)), np.int64)
    k, escape, raw = np.zeros(len(pos), np.int64), np.zeros(len(pos), bool), np.zeros(len(pos), np.int64)
    every, most, least = np.unique(span), int(order.max()), int(order.min())
    for i in range(least, n):
        ready = order <= i
        begins = ready & ((i % span == 0) | (order == i)) if i <= most or (i % every == 0).any() else None
        if begins is not None and begins.any():
            b = np.flatnonzero(begins)
            k[b] = bits.read(pos[b], width[b])
            escape[b] = k[b] == (1 << width[b]) - 1
            pos[b] += width[b]
            e = b[escape[b]]
            raw[e] = bits.read(pos[e], 5)
            pos[e] += 5
        if escape.any() or not ready.all():
            own = np.flatnonzero(ready & ~escape)
            out[i, own], pos[own] = _unfolded(*bits.rice(pos[own], k[own]))
            own = np.flatnonzero(ready & escape)
            out[i, own] = np.where(raw[own] > 0, bits.signed(pos[own], raw[own]), 0)
            pos[own] += raw[own]
        else:
            out[i], pos = _unfolded(*bits.rice(pos, k))
    return out.T


def _unfolded(u: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (u >> 1) ^ -(u & 1), pos


def _undo_fixed(warm: np.ndarray, residual: np.ndarray, order: int) -> np.ndarray:
    """Sums as often as the order says, each from the matching difference of the first samples."""
    x = residual[:, order:]
    for p in range(order, 0, -1):
        first = np.diff(warm[:, :order], p - 1, axis=1)[:, -1:]
        x = first + np.cumsum(x, 1)
    return np.concatenate([warm[:, :order], x], 1) if order else x


def _undo_linear(warm: np.ndarray, residual: np.ndarray, coefs: np.ndarray, shift: np.ndarray) -> np.ndarray:
    p = coefs.shape[1]
    x = np.ascontiguousarray(residual.T)
    x[:p] = warm[:, :p].T
    for i in range(p, x.shape[0]):
        x[i] += sum(coefs[:, j] * x[i - 1 - j] for j in range(p)) >> shift
    return x.T


def payload(text: str | None) -> bytes:
    """UTF-8 of a text, filled up to a positive multiple of BLOCK bytes."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes([PAD]) * (BLOCK * max(1, -(-len(raw) // BLOCK)) - len(raw))


def features(samples: list[np.ndarray]) -> list[str]:
    """Level, peak, zero crossings and mean step of each clip."""
    out = []
    for x in samples:
        n = max(1, len(x))
        step = np.diff(x)
        out.append(f"rms={np.sqrt((x * x).sum() / n):.4f};peak={np.abs(x).max(initial=0)};zcr={((x[1:] < 0) != (x[:-1] < 0)).sum() / n:.5f};mean={x.sum() / n:.4f};step={np.abs(step).sum() / n:.4f};n={len(x)}")
    return out


def encoded(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep's columns, n_bytes, and media: the text's payload as a FLAC stream."""

    def each(texts: list) -> tuple[list, None]:
        sizes, media = [], []
        for a, b in slices(texts, 1_500_000):
            sizes += [len((t or "").encode("utf-8", "surrogatepass")) for t in texts[a:b]]
            media += encode_streams([payload(t) for t in texts[a:b]])
        return [sizes, media], None

    return map_texts(docs, lambda: each, "n_bytes long, media binary", keep, text)


def _tolerant(streams: list[bytes | None]) -> list[tuple[np.ndarray | None, str | None]]:
    try:
        return [(x, None) for x in decode_streams(streams)]
    except (ValueError, IndexError, KeyError, TypeError) as whole:
        if len(streams) == 1:
            return [(None, str(whole) or "broken")]
        return [r for s in streams for r in _tolerant([s])]


def read_back(rows: DataFrame, keep: tuple[str, ...] = ("doc_id", "n_bytes"), media: str = "media") -> DataFrame:
    """keep's columns, and what decoding gives: sizes and hashes of the 8-bit payload and of the stream, features, error."""
    sha = lambda xs: [None if x is None else hashlib.sha256(x).hexdigest() for x in xs]

    def each(streams: list) -> tuple[list, None]:
        got = [x for a, b in slices(streams, 1_500_000) for x in _tolerant(streams[a:b])]
        raw = [None if x is None else (x + 128).astype(np.uint8).tobytes() for x, _ in got]
        feats = [None if x is None else features([x])[0] for x, _ in got]
        return [[None if x is None else len(x) for x in raw], sha(raw), [None if x is None else zlib.crc32(x[-32:]) for x in raw], [None if x is None else len(x) for x in streams], sha(streams), feats, [e for _, e in got]], None

    return map_texts(rows, lambda: each, "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string", keep, media)


def pcm_blocks(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), media: str = "media", block: int = 4096) -> DataFrame:
    """keep's columns and a row for each block of PCM: block, sample_offset, n_samples, pcm (signed, as wide as samples are)."""

    def each(streams: list) -> tuple[list, list[int]]:
        found, owner = [], []
        for i, data in enumerate(streams):
            samples, _ = _tolerant([data])[0]
            if samples is None:
                continue
            width = -(-_parse(data)[0]["bits"] // 8)
            raw = samples.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :width]
            for k, a in enumerate(range(0, len(samples), block)):
                own = raw[a : a + block]
                owner.append(i)
                found.append((k, a, len(own), own.tobytes()))
        return columns_of(found, 4), owner

    return map_texts(rows, lambda: each, "block int, sample_offset long, n_samples int, pcm binary", keep, media)
