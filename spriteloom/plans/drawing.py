"""Image files of several formats, drawn from rows of tables for queries and tests."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from spriteloom.sources.codec import encode_png


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def _png(width: int, height: int, color: int, lines: np.ndarray, *before: bytes) -> bytes:
    header = _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, color, 0, 0, 0))
    return b"\x89PNG\r\n\x1a\n" + header + b"".join(before) + _chunk(b"IDAT", zlib.compress(lines.tobytes())) + _chunk(b"IEND", b"")


def filtered_png(rgba: np.ndarray, kind: int) -> bytes:
    """A PNG all of whose rows have one filter: none, left, above, their mean, or the nearest of three (0 to 4)."""
    h, w = rgba.shape[:2]
    px = np.zeros((h + 1, w + 1, 4), np.int16)
    px[1:, 1:] = rgba
    left, above, corner = px[1:, :-1], px[:-1, 1:], px[:-1, :-1]
    to_left, to_above, to_corner = abs(above - corner), abs(left - corner), abs(left + above - 2 * corner)
    nearest = np.where((to_left <= to_above) & (to_left <= to_corner), left, np.where(to_above <= to_corner, above, corner))
    guess = (np.zeros_like(left), left, above, (left + above) >> 1, nearest)[kind]
    body = ((px[1:, 1:] - guess) & 255).astype(np.uint8).reshape(h, w * 4)
    return _png(w, h, 6, np.concatenate([np.full((h, 1), kind, np.uint8), body], axis=1))


def _numbered(rgba: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Colours, of which there must be 256 at most, and each pixel's number among them."""
    colours, numbers = np.unique(rgba.reshape(-1, 4), axis=0, return_inverse=True)
    if len(colours) > 256:
        raise ValueError("too many colours for a palette")
    return colours, numbers.reshape(rgba.shape[:2]).astype(np.uint8)


def palette_png(rgba: np.ndarray) -> bytes:
    colours, numbers = _numbered(rgba)
    h, w = numbers.shape
    tables = _chunk(b"PLTE", colours[:, :3].tobytes()), _chunk(b"tRNS", colours[:, 3].tobytes())
    return _png(w, h, 3, np.concatenate([np.zeros((h, 1), np.uint8), numbers], axis=1), *tables)


def gif(rgba: np.ndarray) -> bytes:
    """A GIF whose codes all have nine bits: the table of words is cleared before it outgrows them.  Alpha is 0 or 255."""
    colours, numbers = _numbered(rgba)
    h, w = numbers.shape
    codes = [np.concatenate([[256], part]) for part in np.split(numbers.ravel().astype(np.int64), range(250, w * h, 250))]
    codes = np.concatenate([*codes, [257]])
    body = np.packbits((codes[:, None] >> np.arange(9) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes()
    blocks = b"".join(bytes([len(b)]) + b for b in (body[i : i + 255] for i in range(0, len(body), 255)))
    table = np.zeros((256, 3), np.uint8)
    table[: len(colours)] = colours[:, :3]
    clear = np.flatnonzero(colours[:, 3] == 0)
    control = b"\x21\xf9\x04" + bytes([1, 0, 0, int(clear[0])]) + b"\0" if len(clear) else b""
    return b"GIF89a" + struct.pack("<HHBBB", w, h, 0xF7, 0, 0) + table.tobytes() + control + b"," + struct.pack("<HHHHB", 0, 0, w, h, 0) + b"\x08" + blocks + b"\0;"


#: Code lengths (1 to 16 bits) and symbols of the table for mean values; of the other table only the end of a block is needed.
_MEANS, _ENDS = (bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]), bytes(range(12))), (bytes([1] + [0] * 15), b"\0")


def _codes(lengths: bytes) -> list[tuple[int, int]]:
    """(code, bits) of the symbols in order."""
    out, code = [], 0
    for bits, n in enumerate(lengths, 1):
        for _ in range(n):
            out.append((code, bits))
            code += 1
        code <<= 1
    return out


def grey_jpeg(cells: np.ndarray) -> bytes:
    """A JPEG of 8 x 8 pixels of one grey for each cell, which decodes to just these greys."""
    part = lambda mark, data: bytes([0xFF, mark]) + struct.pack(">H", len(data) + 2) + data
    h, w = cells.shape
    codes, bits, last = _codes(_MEANS[0]), [], 0
    for value in (8 * (cells.astype(int) - 128)).ravel().tolist():
        step, last = value - last, value
        size = abs(step).bit_length()
        code, n = codes[size]
        bits.append(f"{code:0{n}b}" + (f"{step if step > 0 else step + (1 << size) - 1:0{size}b}" if size else "") + "0")
    body = "".join(bits)
    body += "1" * (-len(body) % 8)
    data = int(body, 2).to_bytes(len(body) // 8, "big").replace(b"\xff", b"\xff\0")
    frame = struct.pack(">BHHB", 8, 8 * h, 8 * w, 1) + bytes([1, 0x11, 0])
    tables = part(0xDB, b"\0" + b"\1" * 64) + part(0xC0, frame) + part(0xC4, b"\0" + b"".join(_MEANS)) + part(0xC4, b"\x10" + b"".join(_ENDS))
    return b"\xff\xd8" + part(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0") + tables + part(0xDA, bytes([1, 1, 0, 0, 63, 0])) + data + b"\xff\xd9"


def in_format(rgba: np.ndarray, form: int) -> bytes:
    """The image as one of eight files: PNG by filters 0 to 4, PNG by palette, GIF, and a PNG cut short."""
    if form < 5:
        return filtered_png(rgba, form)
    return (palette_png, gif, lambda px: encode_png(px)[:-30])[form - 5](rgba)
