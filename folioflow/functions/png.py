"""PNG images as arrays and back, as far as page images need it: 8 bits a channel, not interlaced."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_HEAD = b"\x89PNG\r\n\x1a\n"
#: Channels of the colour types grey, RGB, grey and alpha, RGB and alpha.
_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def encode(pixels: np.ndarray) -> bytes:
    """pixels: height x width x channels of bytes."""
    height, width, channels = pixels.shape
    colour = {v: k for k, v in _CHANNELS.items()}[channels]
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)
    chunks = ((b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)), (b"IDAT", zlib.compress(lines.tobytes(), 6)), (b"IEND", b""))
    return _HEAD + b"".join(struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data)) for kind, data in chunks)


def decode(image: bytes) -> np.ndarray:
    """height x width x channels; ValueError for any other image."""
    if image[:8] != _HEAD:
        raise ValueError("no PNG image")
    at, packed, head = 8, b"", None
    while at < len(image):
        n, kind = struct.unpack(">I4s", image[at : at + 8])
        data = image[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            packed += data
        at += 12 + n
    if head is None or head[2] != 8 or head[3] not in _CHANNELS or head[6]:
        raise ValueError("a kind of PNG image that isn't read")
    width, height, channels = head[0], head[1], _CHANNELS[head[3]]
    lines = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width, channels), np.uint8)
    above = np.zeros((width, channels), np.uint8)
    for y in range(height):
        out[y] = above = _unfiltered(lines[y, 0], lines[y, 1:].reshape(width, channels), above)
    return out


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 1:
        return np.cumsum(line, axis=0, dtype=np.uint8)
    if kind == 2:
        return line + above
    out, left, corner = np.zeros_like(line), np.zeros(line.shape[1], np.int16), np.zeros(line.shape[1], np.int16)
    for x in range(len(line)):
        up = above[x].astype(np.int16)
        if kind == 3:
            guess = (left + up) // 2
        else:
            near = left + up - corner
            a, b, c = abs(near - left), abs(near - up), abs(near - corner)
            guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        out[x] = (line[x] + guess).astype(np.uint8)
        left, corner = out[x].astype(np.int16), up
    return out
