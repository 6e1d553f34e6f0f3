"""Pictures without an image library: PNG and PPM in and out, resizing by areas, thumbnails. NumPy arrays of one picture at a time."""

from __future__ import annotations

import base64
import struct
import zlib

import numpy as np

#: The first bytes of a PNG file. Fixed value.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Channels by PNG colour type: grey, RGB, palette, grey with alpha, RGB with alpha. Fixed values.
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png_bytes(rgb: np.ndarray) -> bytes:
    """A PNG of an (height, width, 3) array of bytes; each row is stored as its difference from the row above."""
    height, width, _ = rgb.shape
    above = np.concatenate((np.zeros((1, width, 3), np.uint8), rgb[:-1]))
    rows = np.concatenate((np.full((height, 1), 2, np.uint8), (rgb - above).reshape(height, -1)), 1)
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + _chunk(b"IEND", b"")


def _unfilter(raw: np.ndarray, height: int, stride: int, step: int) -> np.ndarray:
    """Rows without their filters. Filters that look left are undone byte by byte of a pixel, along the row."""
    out, above = np.zeros((height, stride), np.uint8), np.zeros(stride, np.int64)
    for y, row in enumerate(raw.reshape(height, stride + 1)):
        kind, line = int(row[0]), row[1:].astype(np.int64)
        if kind == 1:
            line = line.reshape(-1, step).cumsum(0).reshape(-1)
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            for x in range(stride):
                a, b, c = (line[x - step] if x >= step else 0), above[x], (above[x - step] if x >= step else 0)
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    near = [abs(b - c), abs(a - c), abs(a + b - 2 * c)]
                    guess = (a, b, c)[near.index(min(near))]
                line[x] = (line[x] + guess) & 255
        elif kind:
            raise ValueError(f"PNG row filter {kind}")
        above = line & 255
        out[y] = above
    return out


def read_png(data: bytes) -> np.ndarray:
    """(height, width, 3) bytes of a PNG of 8 bits a channel that isn't interlaced; alpha is laid over black. ValueError for others."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG")
    at, parts, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            parts.append(body)
        at += size + 12
    if head is None or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("a PNG of another kind")
    width, height, _, colour = head[:4]
    n = CHANNELS[colour]
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8)
    except zlib.error as e:
        raise ValueError("broken PNG") from e
    if len(raw) != height * (width * n + 1):
        raise ValueError("a PNG with too few bytes")
    x = _unfilter(raw, height, width * n, n).reshape(height, width, n)
    if colour == 3:
        if palette is None or x.max(initial=0) >= len(palette):
            raise ValueError("a PNG without its palette")
        return palette[x[:, :, 0]]
    if n in (2, 4):
        x = (x[:, :, :-1].astype(np.uint16) * x[:, :, -1:] // 255).astype(np.uint8)
    return np.repeat(x, 3, 2) if x.shape[2] == 1 else x


def read_picture(data: bytes | None) -> np.ndarray | None:
    """A PNG or binary PPM as (height, width, 3) bytes; None for null, broken and other files."""
    try:
        if data is None:
            return None
        if data[:2] == b"P6":
            head = data.split(None, 4)
            width, height, most = map(int, head[1:4])
            body = np.frombuffer(data, np.uint8, width * height * 3, len(data) - width * height * 3)
            return body.reshape(height, width, 3) if most == 255 else None
        return read_png(bytes(data))
    except (ValueError, IndexError, struct.error):
        return None


def _areas(n: int, m: int) -> np.ndarray:
    """(m, n) weights: the share of each of n old places in each of m new ones."""
    lo, hi = np.arange(m)[:, None] * n / m, (np.arange(m)[:, None] + 1) * n / m
    part = np.clip(np.minimum(hi, np.arange(n) + 1) - np.maximum(lo, np.arange(n)), 0, None)
    return part / part.sum(1, keepdims=True)


def resize(rgb: np.ndarray, height: int, width: int) -> np.ndarray:
    """The picture at another size; a new pixel is the mean of the area it covers."""
    x = np.einsum("ay,yxc->axc", _areas(rgb.shape[0], height), rgb.astype(np.float64))
    return np.rint(np.einsum("bx,axc->abc", _areas(rgb.shape[1], width), x)).astype(np.uint8)


def features(rgb: np.ndarray, side: int = 8) -> np.ndarray:
    """The picture at side x side as values from 0 to 1, in one row."""
    return (resize(rgb, side, side).astype(np.float32) / 255).reshape(-1)


def thumbnail(rgb: np.ndarray, size: int = 192) -> np.ndarray:
    """The picture within size x size in its proportions; a smaller one stays as it is."""
    height, width, _ = rgb.shape
    scale = min(1.0, size / max(height, width))
    return rgb if scale == 1 else resize(rgb, max(1, round(height * scale)), max(1, round(width * scale)))


def as_text(rgb: np.ndarray) -> str:
    """A PNG as base64 text."""
    return base64.b64encode(png_bytes(rgb)).decode()
