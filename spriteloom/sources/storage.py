"""Files by path or uri, through Arrow: a local folder, HDFS or an object store."""

from __future__ import annotations

import os
import re
import uuid

from pyarrow import fs


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a path or uri, and the path in it."""
    path = re.sub(r"^file:/(?!/)", "file:///", path)
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def read_range(file, start: int, size: int) -> bytes:
    """``size`` bytes from ``start`` on, of a file opened for random access."""
    file.seek(start)
    return file.read(size)


def put(path: str, data: bytes) -> None:
    """Writes a file as a whole: it appears under its name when it is complete, so a task that runs again does no harm."""
    system, name = place(path)
    system.create_dir(os.path.dirname(name))
    part = f"{name}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, name)


def names(path: str, ending: str) -> list[str]:
    """The files under a folder whose names end so, in order; none if there is no such folder."""
    system, folder = place(path)
    found = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(ending))


def sizes(path: str) -> dict[str, int]:
    """Bytes of each file under a folder, by its path from there."""
    system, folder = place(path)
    found = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    return {f.path.removeprefix(folder).lstrip("/"): f.size for f in found if f.type == fs.FileType.File}


def remove(path: str) -> None:
    """Deletes a folder with all that it holds, if it is there."""
    system, folder = place(path)
    if system.get_file_info(folder).type == fs.FileType.Directory:
        system.delete_dir(folder)
