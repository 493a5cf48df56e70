"""The sprite cleaner over encoded images: one Arrow pass, no shuffle."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spriteloom.sources.codec import decode_image, encode_png

SMALLEST, MAX_COLORS = 4, 256
#: All that the cleaner may say of a file; WebP has no decoder here and is named apart from broken files.
VERDICTS = ("accepted", "unreadable", "unsupported_webp", "too_small_native", "too_small_reduced", "too_many_colors")
OPEN_LICENSES = ("public_domain", "cc-by")
METADATA = (
    "license_type string, dataset_bucket string, description string, width int, height int, has_background boolean, "
    "palette_size int, is_animation boolean, frames int, fps double, source_url string"
)


def packed(rgba: np.ndarray) -> np.ndarray:
    """Each pixel as one number, which differs where a channel does."""
    return np.ascontiguousarray(rgba, np.uint8).view(np.uint32)[..., 0]


def colour_changes(rgba: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(line, place) of the last pixel before each change of colour, along rows and along columns, in order."""
    px = packed(rgba)
    return [np.nonzero(lines[:, 1:] != lines[:, :-1]) for lines in (px, px.T)]


def pixel_runs(rgba: np.ndarray) -> list[np.ndarray]:
    """Distances between colour changes that follow each other in a row, and in a column."""
    return [np.diff(place)[np.diff(line) == 0] for line, place in colour_changes(rgba)]


def pixel_scale(rgba: np.ndarray) -> int:
    """Greatest common divisor of the distances between colour changes along rows and columns; 1 if there are none."""
    return int(np.gcd.reduce(np.concatenate(pixel_runs(rgba)))) or 1


def resized(rgba: np.ndarray, height: int, width: int) -> np.ndarray:
    """The nearest pixel for each of height x width places."""
    h, w = rgba.shape[:2]
    return rgba[((np.arange(height) + 0.5) * h / height).astype(int)][:, ((np.arange(width) + 0.5) * w / width).astype(int)]


def reduced(rgba: np.ndarray, scale: int | None = None) -> np.ndarray:
    """The image at one pixel for each block of its scale, which may be known already."""
    scale = scale or pixel_scale(rgba)
    return resized(rgba, max(1, rgba.shape[0] // scale), max(1, rgba.shape[1] // scale)) if scale > 1 else rgba


def palette_size(rgba: np.ndarray) -> int:
    return len(np.unique(packed(rgba)))


def has_plain_corners(rgba: np.ndarray) -> bool:
    """Whether the four corners have one colour that isn't transparent: the background."""
    corners = rgba[[0, 0, -1, -1], [0, -1, 0, -1]]
    return bool((corners == corners[0]).all() and corners[0, 3] > 0)


def without_background(rgba: np.ndarray) -> np.ndarray:
    """Transparent black wherever the corners' colour stands, if they have one."""
    return np.where(((px := packed(rgba)) == px[0, 0])[..., None], 0, rgba).astype(np.uint8) if has_plain_corners(rgba) else rgba


def clean_image(rgba: np.ndarray | None, max_colors: int = MAX_COLORS) -> tuple[str, dict]:
    """A verdict, and what is known by then: scale, size, palette and the cleaned pixels."""
    if rgba is None:
        return "unreadable", {}
    if min(rgba.shape[:2]) < SMALLEST:
        return "too_small_native", {"width": rgba.shape[1], "height": rgba.shape[0]}
    small = reduced(rgba, scale := pixel_scale(rgba))
    known = {"scale": scale, "width": small.shape[1], "height": small.shape[0]}
    if min(small.shape[:2]) < SMALLEST:
        return "too_small_reduced", known
    known["palette_size"] = palette_size(small)
    if known["palette_size"] > max_colors:
        return "too_many_colors", known
    return "accepted", known | {"bg_removed": has_plain_corners(small), "pixels": without_background(small)}


#: Rows and bytes, about, that are given out at a time, and rows that the cleaner gives.
BATCH_ROWS, BATCH_BYTES, CLEANED_ROWS = 100_000, 4 << 20, 1_000
_ARROW = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "array<float>": pa.list_(pa.float32())}


def _column(parts: list, kind: pa.DataType) -> pa.Array:
    values = np.concatenate(parts)
    if values.ndim == 1:
        return pa.array(values, kind)
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind.value_type))


def _each(images: DataFrame, measure: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    """What ``measure`` says of each readable image of rows (name, content): columns of some rows, beside the name.

    A column is one value a row, or an array with one line a row.  Batches are
    bounded in rows and in bytes, whatever a row holds.
    """
    kinds = {c: _ARROW[kind] for c, kind in (part.split() for part in schema.split(", "))}

    def given(held) -> Iterator[pa.RecordBatch]:
        names = pa.array([name for name, *_ in held], pa.string()).take(pa.array(np.repeat(np.arange(len(held)), [n for *_, n in held])))
        columns = [names, *(_column([got[c] for _, got, _ in held], kind) for c, kind in list(kinds.items())[1:])]
        whole = pa.RecordBatch.from_arrays(columns, names=list(kinds))
        for at in range(0, len(whole), BATCH_ROWS):  # an image may have more rows
            yield whole.slice(at, BATCH_ROWS)

    def run(batches):
        for batch in batches:
            held, rows, size = [], 0, 0
            for name, content in zip(batch.column("name"), batch.column("content")):
                if (rgba := decode_image(content.as_py())) is None:
                    continue
                got = measure(rgba)
                held.append((name.as_py(), got, len(next(iter(got.values())))))
                rows += held[-1][2]
                size += sum(v.nbytes for v in got.values() if isinstance(v, np.ndarray))
                if rows > BATCH_ROWS or size > BATCH_BYTES:
                    yield from given(held)
                    held, rows, size = [], 0, 0
            if held:
                yield from given(held)

    return images.select("name", "content").mapInArrow(run, schema)


def image_facts(images: DataFrame) -> DataFrame:
    """(name, width, height, scale, native_width, native_height, palette_size, plain_corners) of every readable image."""

    def measure(rgba):
        small = reduced(rgba, scale := pixel_scale(rgba))
        sizes = {"width": rgba.shape[1], "height": rgba.shape[0], "scale": scale, "native_width": small.shape[1], "native_height": small.shape[0]}
        return {c: [v] for c, v in (sizes | {"palette_size": palette_size(small), "plain_corners": has_plain_corners(small)}).items()}

    return _each(images, measure, "name string, width int, height int, scale int, native_width int, native_height int, palette_size int, plain_corners boolean")


def _by_axis(rows: list[np.ndarray]) -> np.ndarray:
    return np.repeat(["h", "v"], [len(r) for r in rows]).astype(object)


def image_changes(images: DataFrame) -> DataFrame:
    """(name, axis, line, spot): every colour change, along rows (h) and columns (v)."""

    def measure(rgba):
        lines, spots = zip(*colour_changes(rgba))
        return {"axis": _by_axis(lines), "line": np.concatenate(lines), "spot": np.concatenate(spots)}

    return _each(images, measure, "name string, axis string, line int, spot int")


def image_runs(images: DataFrame) -> DataFrame:
    """(name, axis, run): distances between colour changes that follow each other."""
    return _each(images, lambda rgba: {"axis": _by_axis(runs := pixel_runs(rgba)), "run": np.concatenate(runs)}, "name string, axis string, run int")


def image_pixels(images: DataFrame, change: Callable[[np.ndarray], np.ndarray] = lambda rgba: rgba) -> DataFrame:
    """(name, x, y, r, g, b, a): one row for each pixel of the changed image."""

    def measure(rgba):
        rgba = change(rgba)
        return _places(rgba) | dict(zip("rgba", rgba.reshape(-1, 4).T.astype(np.int32)))

    return _each(images, measure, "name string, x int, y int, r int, g int, b int, a int")


def _places(rgba: np.ndarray) -> dict[str, np.ndarray]:
    y, x = np.divmod(np.arange(rgba.shape[0] * rgba.shape[1], dtype=np.int32), np.int32(rgba.shape[1]))
    return {"x": x, "y": y}


#: What each byte is from -1 to 1, to six places.
_SCALED = np.round(np.arange(256) / 255 * 2 - 1, 6)


def scaled_pixels(images: DataFrame) -> DataFrame:
    """(name, x, y, r, g, b, a): ``image_pixels`` with channels from -1 to 1, to six places."""
    return _each(images, lambda rgba: _places(rgba) | dict(zip("rgba", _SCALED[rgba.reshape(-1, 4).T])), "name string, x int, y int, r double, g double, b double, a double")


def line_digest(line: np.ndarray) -> str:
    """MD5 of a row's pixels as text: channels joined by commas, pixels by semicolons."""
    text = str(line.tolist())[2:-2].replace("], [", ";").replace(", ", ",")
    return hashlib.md5(text.encode()).hexdigest()


def line_digests(images: DataFrame, change: Callable[[np.ndarray], np.ndarray] = lambda rgba: rgba) -> DataFrame:
    """(name, y, pixels): a digest of each row of pixels of the changed image.

    Rows are digested where the image is read, so no pixel is shuffled; rows
    that repeat within an image, as they do when it is enlarged, are digested once.
    """

    def measure(rgba):
        rgba, known = change(rgba), {}
        keys = [line.tobytes() for line in rgba]
        for key, line in zip(keys, rgba):
            if key not in known:
                known[key] = line_digest(line)
        return {"y": np.arange(len(keys), dtype=np.int32), "pixels": np.array([known[k] for k in keys], object)}

    return _each(images, measure, "name string, y int, pixels string")


#: What each byte is in a training tensor.
_SIGNED = (np.arange(256) / 255 * 2 - 1).astype(np.float32)


def training_tensors(images: DataFrame, side: int = 64) -> DataFrame:
    """(name, tensor): channels first, side x side, each value from -1 to 1."""

    def measure(rgba):
        return {"tensor": _SIGNED[resized(rgba, side, side).transpose(2, 0, 1)].reshape(1, -1)}

    return _each(images, measure, "name string, tensor array<float>")


def judged_images(images: DataFrame) -> DataFrame:
    """(name, scale, verdict) of every readable image, from one look at it and without the cleaned pixels."""

    def measure(rgba):
        verdict, got = clean_image(rgba)
        return {"scale": [got.get("scale") or pixel_scale(rgba)], "verdict": [verdict]}

    return _each(images, measure, "name string, scale int, verdict string")


_METADATA = pa.struct([(name, {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}[kind]) for name, kind in (part.split() for part in METADATA.split(", "))])
_CLEANED = pa.schema({"name": pa.string(), "verdict": pa.string(), "bg_removed": pa.bool_(), "png": pa.binary(), "metadata": _METADATA})


def clean_images(images: DataFrame, max_colors: int = MAX_COLORS) -> DataFrame:
    """(name, verdict, bg_removed, png, metadata) for rows (name, content, license_type, source_url)."""
    schema = f"name string, verdict string, bg_removed boolean, png binary, metadata struct<{METADATA.replace(' ', ':').replace(',:', ',')}>"

    def given(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), _CLEANED.types)], schema=_CLEANED)

    def clean(batches):
        for batch in batches:
            rows, size = [], 0
            for name, content, license_type, url in zip(*batch.columns):
                name, content, license_type, url = name.as_py(), content.as_py(), license_type.as_py(), url.as_py()
                verdict, got = clean_image(decode_image(content), max_colors)
                if verdict == "unreadable" and content and content[:4] == b"RIFF" and content[8:12] == b"WEBP":
                    verdict = "unsupported_webp"
                meta = None
                if verdict == "accepted":
                    license_type = license_type or "private_train"
                    bucket = "safe_hf" if license_type in OPEN_LICENSES else "private_train"
                    meta = {"license_type": license_type, "dataset_bucket": bucket, "description": "", "width": got["width"], "height": got["height"]}
                    meta |= {"has_background": not got["bg_removed"], "palette_size": got["palette_size"], "is_animation": False, "frames": 1, "fps": None, "source_url": url or ""}
                png = encode_png(got["pixels"]) if meta else None
                rows.append((name, verdict, got.get("bg_removed"), png, meta))
                size += len(png or b"")
                if len(rows) >= CLEANED_ROWS or size > BATCH_BYTES:
                    yield given(rows)
                    rows, size = [], 0
            if rows:
                yield given(rows)

    return images.select("name", "content", "license_type", "source_url").mapInArrow(clean, schema)
