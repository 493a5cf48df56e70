"""Zip archives of any size, spread over tasks by their entries.

The central directory of an archive is read first, by a few reads from its end.
Entries then are rows of their own, dealt out by ranges of bytes, and each task
reads and unpacks the entries of its ranges: an archive of ten gigabytes is many
tasks, and nothing holds more than one entry and a batch of rows.
"""

from __future__ import annotations

import math
import struct
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spriteloom.sources import storage

#: Packed bytes of a task, and unpacked bytes of a batch of rows.
TASK_BYTES, BATCH_BYTES = 64 << 20, 16 << 20
_ENTRIES = "archive string, path string, entry string, name string, at long, packed long, size long, method int, crc long"
_FILES = "archive string, entry string, name string, content binary"


def wanted_entry(name: str) -> bool:
    return name.lower().endswith((".png", ".gif")) and not name.startswith("__MACOSX")


def flat_names(archive: str, entries: list[str]) -> list[str]:
    """The archive's stem and each entry's last path segment; names that meet get a number."""
    seen: dict[str, int] = {}
    out = []
    for entry in entries:
        name = f"{archive.split('.')[0]}_{entry.split('/')[-1]}"
        k = seen[name] = seen.get(name, 0) + 1
        stem, dot, kind = name.rpartition(".")
        out.append(name if k == 1 else f"{stem}-{k}{dot}{kind}")
    return out


def archive_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, path, entry, name, at, packed, size, method, crc): the images in the zip files under ``folder``, unread.

    Archives whose directory can't be read, and encrypted entries, give no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(folder).select("path")

    def directory(frames):
        for frame in frames:
            for path in frame["path"]:
                archive = path.split("/")[-1]
                system, name = storage.place(path)
                try:
                    with system.open_input_file(name) as file, zipfile.ZipFile(file) as z:
                        infos = [i for i in z.infolist() if wanted_entry(i.filename) and not i.flag_bits & 1]
                except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError):
                    continue
                own = flat_names(archive, [i.filename for i in infos])
                rows = [(archive, path, i.filename, n, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC) for i, n in zip(infos, own)]
                yield pd.DataFrame(rows, columns=["archive", "path", "entry", "name", "at", "packed", "size", "method", "crc"])

    return files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(directory, _ENTRIES)


def unpack_entry(file, at: int, packed: int, method: int, crc: int) -> bytes | None:
    """The content of the entry whose local header is at ``at``; None if it is damaged or packed in a way that isn't known."""
    header = storage.read_range(file, at, 30)
    if len(header) < 30 or header[:4] != b"PK\x03\x04":
        return None
    name, extra = struct.unpack("<HH", header[26:30])
    data = storage.read_range(file, at + 30 + name + extra, packed)
    try:
        data = {zipfile.ZIP_STORED: bytes, zipfile.ZIP_DEFLATED: lambda d: zlib.decompress(d, -15)}[method](data)
    except (KeyError, zlib.error):
        return None
    return data if zlib.crc32(data) == crc else None


def expand_archives(entries: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(archive, entry, name, content) of ``archive_entries``; damaged entries give no rows."""
    total = entries.agg(F.coalesce(F.sum(F.col("packed") + 100), F.lit(0))).first()[0]

    def unpack(frames):
        opened, file = None, None
        for frame in frames:
            rows, held = [], 0
            for archive, path, entry, name, at, packed, method, crc in frame[["archive", "path", "entry", "name", "at", "packed", "method", "crc"]].itertuples(index=False):
                if path != opened:
                    system, local = storage.place(path)
                    opened, file = path, system.open_input_file(local)
                content = unpack_entry(file, at, packed, method, crc)
                if content is None:
                    continue
                rows.append((archive, entry, name, content))
                held += len(content)
                if held > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=["archive", "entry", "name", "content"])
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=["archive", "entry", "name", "content"])

    return entries.repartitionByRange(max(1, math.ceil(total / task_bytes)), "path", "at").mapInPandas(unpack, _FILES)
