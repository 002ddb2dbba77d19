"""Decoders of the binary formats, plain functions over bytes that the Arrow functions of tables.py call."""

from __future__ import annotations

import gzip
import struct
import zipfile
import zlib
from collections.abc import Iterator
from io import BytesIO
from pathlib import PurePosixPath

# ---------------------------------------------------------------- protobuf


class Broken(ValueError):
    """Bytes that don't follow their format."""


def varint(data: bytes, at: int) -> tuple[int, int]:
    """A base-128 number and the place after it."""
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise Broken("a varint runs over the end")
        b = data[at]
        value |= (b & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if b < 0x80:
            return value, at


def varints(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        value, at = varint(data, at)
        out.append(value)
    return out


def unzigzag(n: int) -> int:
    return n >> 1 ^ -(n & 1)


def fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(number, wire type, value) of a message; lengths and fixed widths as bytes."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = varint(data, at)
        else:
            if wire == 2:
                size, at = varint(data, at)
            elif wire in (1, 5):
                size = 8 if wire == 1 else 4
            else:
                raise Broken(f"wire type {wire}")
            if at + size > len(data):
                raise Broken("a field runs over the end")
            value, at = data[at : at + size], at + size
        yield number, wire, value


def inflated(data: bytes, codec: int) -> bytes:
    """By the archive's number of the compression: 1 none, 2 gzip."""
    if codec == 1:
        return data
    if codec == 2:
        return gzip.decompress(data)
    raise Broken(f"compression {codec} isn't read")


# ---------------------------------------------------------------- tile archives

HEADER = struct.Struct("<7sB11Q6B4iB2i")
HEADER_FIELDS = (
    "magic version root_offset root_length metadata_offset metadata_length leaf_offset leaf_length data_offset data_length addressed entries contents "
    "clustered internal_compression tile_compression tile_type min_zoom max_zoom min_lon min_lat max_lon max_lat center_zoom center_lon center_lat"
).split()


def header(data: bytes) -> dict:
    """The fixed head of a version 3 archive; degrees from their ten-millionths."""
    if len(data) < HEADER.size:
        raise Broken("the header is cut short")
    out = dict(zip(HEADER_FIELDS, HEADER.unpack_from(data), strict=True))
    if out["magic"] != b"PMTiles" or out["version"] != 3:
        raise Broken("not a version 3 tile archive")
    return {k: v / 1e7 if k.endswith(("_lon", "_lat")) else v for k, v in out.items() if k != "magic"}


def directory(data: bytes) -> list[tuple[int, int, int, int]]:
    """(tile id, offset, length, run) of a directory, whose columns lie one after another; offset 0 goes on where the last ended."""
    numbers = varints(data)
    n = numbers[0] if numbers else 0
    if len(numbers) != 1 + 4 * n:
        raise Broken("a directory's columns aren't of one length")
    ids, runs, lengths, offsets = (numbers[1 + i * n : 1 + (i + 1) * n] for i in range(4))
    out, tile, after = [], 0, 0
    for i in range(n):
        tile += ids[i]
        if offsets[i] == 0 and i == 0:
            raise Broken("the first entry has no offset")
        at = offsets[i] - 1 if offsets[i] else after
        after = at + lengths[i]
        out.append((tile, at, lengths[i], runs[i]))
    return out


def entries(data: bytes, deepest: int = 4) -> Iterator[tuple[int, int, int, int]]:
    """All entries of an archive with their offsets in the file, leaf directories followed."""
    head = header(data)

    def walk(start: int, size: int, depth: int) -> Iterator[tuple[int, int, int, int]]:
        if depth > deepest:
            raise Broken("directories are nested too deep")
        for tile, at, length, run in directory(inflated(data[start : start + size], head["internal_compression"])):
            if run:
                yield tile, head["data_offset"] + at, length, run
            else:
                yield from walk(head["leaf_offset"] + at, length, depth + 1)

    yield from walk(head["root_offset"], head["root_length"], 1)


def _value(data: bytes) -> str | None:
    """A tile's typed value as text."""
    for number, _, v in fields(data):
        if number == 1:
            return v.decode()
        if number in (2, 3):
            return repr(struct.unpack("<f" if number == 2 else "<d", v)[0])
        if number in (4, 5):
            return str(v - (1 << 64) if number == 4 and v >= 1 << 63 else v)
        if number == 6:
            return str(unzigzag(v))
        if number == 7:
            return "true" if v else "false"
    return None


def tile_features(data: bytes, wanted: frozenset[str] | None = None) -> Iterator[tuple[str, int, dict[str, str | None], list[int]]]:
    """(layer, geometry type, properties, geometry numbers); layers that aren't wanted are passed over undecoded."""
    for number, _, layer in fields(data):
        if number != 3:
            continue
        parts = list(fields(layer))
        name = next((v.decode() for n, _, v in parts if n == 1), "")
        if wanted is not None and name not in wanted:
            continue
        keys = [v.decode() for n, _, v in parts if n == 3]
        values = [v for n, _, v in parts if n == 4]
        for n, _, feature in parts:
            if n != 2:
                continue
            kind, tags, shape = 0, [], []
            for k, _, v in fields(feature):
                if k == 2:
                    tags = varints(v)
                elif k == 3:
                    kind = v
                elif k == 4:
                    shape = varints(v)
            if len(tags) % 2:
                raise Broken("a feature's tags aren't pairs")
            yield name, kind, {keys[a]: _value(values[b]) for a, b in zip(tags[::2], tags[1::2], strict=True)}, shape


def shape_parts(numbers: list[int]) -> list[list[tuple[int, int]]]:
    """The lines of a geometry: move, line and close commands over running coordinates."""
    out: list[list[tuple[int, int]]] = []
    x = y = at = 0
    while at < len(numbers):
        command, count = numbers[at] & 7, numbers[at] >> 3
        at += 1
        if command == 7:
            if not out:
                raise Broken("a ring closes before it begins")
            out[-1].append(out[-1][0])
            continue
        if command not in (1, 2) or at + 2 * count > len(numbers):
            raise Broken("a geometry's commands don't add up")
        for _ in range(count):
            x, y = x + unzigzag(numbers[at]), y + unzigzag(numbers[at + 1])
            at += 2
            if command == 1:
                out.append([(x, y)])
            elif out:
                out[-1].append((x, y))
            else:
                raise Broken("a line begins without a move")
    return out


def outer_rings(numbers: list[int]) -> int:
    """Rings of positive area, which begin polygons."""
    area = lambda p: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:], strict=False))
    return sum(area(p) > 0 for p in shape_parts(numbers) if len(p) >= 4)


# ---------------------------------------------------------------- polylines, glyphs, pictures, trees


def polyline(text: bytes, precision: int = 6) -> list[tuple[float, float]]:
    """(lon, lat) of an encoded line: five bits a character from 63, running differences, latitude first."""
    out, at, lat, lon = [], 0, 0, 0
    while at < len(text):
        for axis in (0, 1):
            value = shift = 0
            while True:
                if at >= len(text):
                    raise Broken("a polyline is cut short")
                b = text[at] - 63
                at += 1
                value |= (b & 31) << shift
                shift += 5
                if b < 32:
                    break
            if axis:
                lon += unzigzag(value)
            else:
                lat += unzigzag(value)
        out.append((lon / 10**precision, lat / 10**precision))
    return out


def glyphs(data: bytes) -> Iterator[tuple[str, str, dict[str, int], bytes]]:
    """(stack, range, metrics, bitmap) of a glyph file."""
    names = {1: "id", 3: "width", 4: "height", 5: "left", 6: "top", 7: "advance"}
    for n, _, stack in fields(data):
        if n != 1:
            continue
        parts = list(fields(stack))
        name, span = (next((v.decode() for k, _, v in parts if k == i), "") for i in (1, 2))
        for k, _, glyph in parts:
            if k == 3:
                metrics, bitmap = dict.fromkeys(names.values(), 0), b""
                for f, _, v in fields(glyph):
                    if f == 2:
                        bitmap = v
                    elif f in names:
                        metrics[names[f]] = unzigzag(v) if f in (5, 6) else v
                yield name, span, metrics, bitmap


def png(data: bytes) -> tuple[int, int, int, bytes]:
    """(width, height, channels, rows) of a picture of 8-bit samples, its checksums verified."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise Broken("not a PNG")
    at, head, body, palette, alpha = 8, None, b"", b"", b""
    while at + 12 <= len(data):
        size, kind = int.from_bytes(data[at : at + 4]), data[at + 4 : at + 8]
        chunk = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + chunk) != int.from_bytes(data[at + 8 + size : at + 12 + size]):
            raise Broken(f"the checksum of {kind!r} is wrong")
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"IDAT":
            body += chunk
        elif kind == b"PLTE":
            palette = chunk
        elif kind == b"tRNS":
            alpha = chunk
    if head is None or head[2] != 8 or head[6]:
        raise Broken("only plain 8-bit pictures are read")
    width, height, _, colour = head[:4]
    step = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(colour)
    if step is None:
        raise Broken(f"colour type {colour}")
    raw, row = zlib.decompress(body), width * step
    if len(raw) != height * (row + 1):
        raise Broken("rows are missing")
    before, rows = bytearray(row), []
    for y in range(height):
        how, line = raw[y * (row + 1)], bytearray(raw[y * (row + 1) + 1 : (y + 1) * (row + 1)])
        for i in range(row):
            left, up, corner = line[i - step] if i >= step else 0, before[i], before[i - step] if i >= step else 0
            if how == 1:
                guess = left
            elif how == 2:
                guess = up
            elif how == 3:
                guess = (left + up) // 2
            elif how == 4:
                p = left + up - corner
                guess = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            elif how == 0:
                break
            else:
                raise Broken(f"filter {how}")
            line[i] = (line[i] + guess) & 255
        rows.append(bytes(line))
        before = line
    if colour == 3:
        return width, height, 4, b"".join(palette[3 * i : 3 * i + 3] + bytes([alpha[i] if i < len(alpha) else 255]) for r in rows for i in r)
    return width, height, step, b"".join(rows)


def members(data: bytes) -> list[tuple[str, bytes]]:
    """Names and bytes of a zip; a name that leaves the tree, or comes twice, is refused."""
    out: dict[str, bytes] = {}
    with zipfile.ZipFile(BytesIO(data)) as z:
        for info in z.infolist():
            if info.is_dir():
                continue
            path = PurePosixPath(info.filename)
            if path.is_absolute() or ".." in path.parts or "\\" in info.filename or info.filename in out:
                raise Broken(f"{info.filename} is unsafe or comes twice")
            out[info.filename] = z.read(info)
    return sorted(out.items())


def packed(tree: dict[str, bytes]) -> bytes:
    """A zip that depends on names and bytes alone."""
    held = BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(tree):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type, info.external_attr = zipfile.ZIP_DEFLATED, 0o644 << 16
            z.writestr(info, tree[name])
    return held.getvalue()
