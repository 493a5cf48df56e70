"""PNG and GIF to RGBA arrays and PNG back with the standard library, and zip archives as rows."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from spriteloom.sources.archives import flat_names, wanted_entry

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def encode_png(rgba: np.ndarray) -> bytes:
    """8-bit RGBA PNG of an array (height, width, 4)."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w = rgba.shape[:2]
    rows = np.concatenate([np.zeros((h, 1), np.uint8), rgba.reshape(h, w * 4)], axis=1).tobytes()
    return _SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def _unfilter(data: bytes, height: int, stride: int, step: int) -> np.ndarray:
    lines = np.frombuffer(data, np.uint8, height * (stride + 1)).reshape(height, stride + 1)
    kinds, lines = lines[:, 0], lines[:, 1:]
    if kinds.size and kinds.max() > 4:
        raise ValueError("unknown filter")
    if (kinds > 2).any():
        return _unfilter_diagonals(lines, kinds, step)
    out = lines.copy()
    for y in np.flatnonzero(kinds):
        if kinds[y] == 1:
            whole = out[y, : stride // step * step]
            whole[:] = np.cumsum(whole.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        elif y:
            out[y] += out[y - 1]
    return out


def _unfilter_diagonals(lines: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    """All filters at once, a diagonal at a time: a pixel needs those to its left, above, and above to the left, which lie on the two diagonals before."""
    (h, stride), width = lines.shape, -(-lines.shape[1] // step)
    padded = np.zeros((h, width * step), np.int16)
    padded[:, :stride] = lines
    # pixel x of row y is slanted[x + y, y + 1]; row 0 and what lies left of the image stay zero
    slanted = np.zeros((h + width, h + 1, step), np.int16)
    rows = np.arange(h)
    for y in rows:
        slanted[y : y + width, y + 1] = padded[y].reshape(width, step)
    sub, up, average, paeth = (np.where(kinds == k, 1, 0).astype(np.int16)[:, None] for k in (1, 2, 3, 4))
    nothing = np.zeros((h + 1, step), np.int16)
    for d in range(h + width - 1):
        low, high = max(0, d - width + 1), min(h, d + 1)
        before, earlier = slanted[d - 1] if d else nothing, slanted[d - 2] if d > 1 else nothing
        here = slice(low, high)
        left, above, corner = before[low + 1 : high + 1], before[here], earlier[here]
        to_left, to_above = np.abs(above - corner), np.abs(left - corner)
        to_corner = np.abs(left + above - 2 * corner)
        nearest = np.where((to_left <= to_above) & (to_left <= to_corner), left, np.where(to_above <= to_corner, above, corner))
        guess = sub[here] * left + up[here] * above + average[here] * ((left + above) >> 1) + paeth[here] * nearest
        slanted[d, low + 1 : high + 1] = (slanted[d, low + 1 : high + 1] + guess) & 255
    out = np.empty((h, width, step), np.uint8)
    for y in rows:
        out[y] = slanted[y : y + width, y + 1]
    return out.reshape(h, -1)[:, :stride]


#: First column, first row, column step and row step of each pass of an interlaced image.
_ADAM7 = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)]


def _samples(data: bytes, w: int, h: int, depth: int, channels: int) -> np.ndarray:
    """Samples (h, w, channels) of one pass, as they are stored: not scaled to 8 bits."""
    stride = (w * channels * depth + 7) // 8
    lines = _unfilter(data, h, stride, max(1, channels * depth // 8))
    if depth == 16:
        return lines.view(">u2").astype(np.uint16).reshape(h, w, channels)
    if depth < 8:
        bits = np.unpackbits(lines, axis=1)[:, : w * channels * depth].reshape(h, w * channels, depth)
        lines = bits @ (1 << np.arange(depth - 1, -1, -1)).astype(np.uint8)
    return lines.reshape(h, w, channels)


def _interlaced(data: bytes, w: int, h: int, depth: int, channels: int) -> np.ndarray:
    px, at = np.zeros((h, w, channels), np.uint16 if depth == 16 else np.uint8), 0
    for x, y, dx, dy in _ADAM7:
        own_w, own_h = (w - x + dx - 1) // dx, (h - y + dy - 1) // dy
        if own_w > 0 and own_h > 0:  # an empty pass has no bytes
            px[y::dy, x::dx] = _samples(data[at:], own_w, own_h, depth, channels)
            at += own_h * ((own_w * channels * depth + 7) // 8 + 1)
    return px


def decode_png(data: bytes) -> np.ndarray | None:
    """RGBA array of a PNG (any depth, colour type, transparent colour and interlacing of the format); None if it can't be read."""
    try:
        if data[:8] != _SIGNATURE:
            return None
        at, body, palette, clear = 8, b"", None, b""
        while at < len(data):
            n, kind = struct.unpack(">I4s", data[at : at + 8])
            part = data[at + 8 : at + 8 + n]
            if kind == b"IHDR":
                w, h, depth, color, _, _, interlaced = struct.unpack(">IIBBBBB", part)
            elif kind == b"PLTE":
                palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
            elif kind == b"tRNS":
                clear = part
            elif kind == b"IDAT":
                body += part
            at += 12 + n
        if depth not in (1, 2, 4, 8, 16) or interlaced > 1:
            return None
        px = (_interlaced if interlaced else _samples)(zlib.decompress(body), w, h, depth, _CHANNELS[color])
        if color == 3:
            table = np.concatenate([palette, np.full((len(palette), 1), 255, np.uint8)], axis=1)
            table[: len(clear), 3] = np.frombuffer(clear, np.uint8)[: len(table)]
            return table[px[..., 0]]
        alpha = np.full((h, w, 1), 255, np.uint8)
        if color in (0, 2) and len(clear) >= 2 * px.shape[2]:  # compared at full depth
            alpha[(px == np.frombuffer(clear, ">u2", px.shape[2])).all(axis=2)] = 0
        px = (px >> 8).astype(np.uint8) if depth == 16 else px * (255 // ((1 << depth) - 1)) if color == 0 else px
        grey = color in (0, 4)
        rgb = np.repeat(px[..., :1], 3, axis=2) if grey else px[..., :3]
        return np.concatenate([rgb, px[..., -1:] if color in (4, 6) else alpha], axis=2).astype(np.uint8)
    except (struct.error, zlib.error, ValueError, IndexError, KeyError, UnboundLocalError, TypeError, OverflowError):
        return None


def _unpack_codes(data: bytes, least: int, size: int) -> np.ndarray:
    """The first ``size`` colour numbers of a GIF's variable-width codes."""
    clear, out = 1 << least, bytearray()
    words: list[bytes] = []
    last, held, bits, width = b"", 0, 0, least + 1
    for byte in data:
        held |= byte << bits
        bits += 8
        while bits >= width:
            code = held & ((1 << width) - 1)
            held >>= width
            bits -= width
            if code == clear:
                words, last, width = [bytes([i]) for i in range(clear)] + [b"", b""], b"", least + 1
                continue
            if code == clear + 1 or not words:  # the end, or no table yet
                return np.frombuffer(bytes(out[:size]), np.uint8)
            word = words[code] if code < len(words) else last + last[:1]
            out += word
            if last and len(words) < 4096:
                words.append(last + word[:1])
            if len(words) == 1 << width and width < 12:
                width += 1
            last = word
            if len(out) >= size:
                return np.frombuffer(bytes(out[:size]), np.uint8)
    return np.frombuffer(bytes(out[:size]), np.uint8)


def decode_gif(data: bytes) -> np.ndarray | None:
    """RGBA array of a GIF's first frame on its canvas, transparent where the frame is not; None if it can't be read."""
    try:
        if data[:6] not in (b"GIF87a", b"GIF89a"):
            return None

        def table(at: int, flags: int) -> tuple[np.ndarray | None, int]:
            n = 3 << ((flags & 7) + 1) if flags & 0x80 else 0
            return (np.frombuffer(data, np.uint8, n, at).reshape(-1, 3) if n else None), at + n

        def blocks(at: int) -> tuple[bytes, int]:
            body = b""
            while data[at]:
                body += data[at + 1 : at + 1 + data[at]]
                at += data[at] + 1
            return body, at + 1

        width, height, flags = struct.unpack_from("<HHB", data, 6)
        colours, at = table(13, flags)
        clear = None
        while data[at] == 0x21:  # extensions; one may name a transparent colour
            body, end = blocks(at + 2)
            if data[at + 1] == 0xF9 and body[0] & 1:
                clear = body[3]
            at = end
        if data[at] != 0x2C:
            return None
        x, y, w, h, flags = struct.unpack_from("<HHHHB", data, at + 1)
        own, at = table(at + 10, flags)
        colours = colours if own is None else own
        numbers = _unpack_codes(blocks(at + 1)[0], data[at], w * h).reshape(h, w)
        if flags & 0x40:  # rows come in four passes
            order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
            numbers = numbers[np.argsort(order)]
        rgba = np.concatenate([colours[numbers], np.full((h, w, 1), 255, np.uint8)], axis=2)
        if clear is not None:
            rgba[numbers == clear] = 0
        canvas = np.zeros((max(height, y + h), max(width, x + w), 4), np.uint8)
        canvas[y : y + h, x : x + w] = rgba
        return canvas
    except (struct.error, ValueError, IndexError, TypeError):
        return None


def decode_image(data: bytes | None) -> np.ndarray | None:
    """RGBA array of a PNG or GIF file; None for other files and those that can't be read."""
    return decode_gif(data) if data and data[:3] == b"GIF" else decode_png(data)


def expand_zips(archives: DataFrame) -> DataFrame:
    """(archive, entry, name, content) for the images in small zip files given as rows (name, content); ``archives`` reads those that lie in a folder.

    ``name`` is the archive's stem and the entry's last path segment; entries
    whose names meet get a number.  Archives that can't be read give no rows.
    """

    def expand(frames):
        for frame in frames:
            rows = []
            for archive, content in zip(frame["name"], frame["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        entries = [i for i in z.infolist() if wanted_entry(i.filename)]
                        rows += [(archive, i.filename, name, z.read(i)) for i, name in zip(entries, flat_names(archive, [i.filename for i in entries]))]
                except (zipfile.BadZipFile, TypeError):
                    continue
            yield pd.DataFrame(rows, columns=["archive", "entry", "name", "content"])

    return archives.select("name", "content").mapInPandas(expand, "archive string, entry string, name string, content binary")
