"""Tar shards as a Python data source: ``df.write.format("webdataset")``.

A job is committed in two phases, on any filesystem that Arrow reaches (see
``storage``).  Each task writes its tars under ``_jobs/<job>/<attempt>``.  The
driver then moves the files of the attempts that count to ``<bucket>/`` and
names them in ``_committed/<job>.json``, which is written last.  Readers only
see files that are named there: not those of a job that failed, was aborted, or
has not come to its end.  A job that would write over a shard of an earlier one
fails before it moves anything, unless it is to overwrite; then the earlier
jobs' shards go once the new ones are there.
"""

from __future__ import annotations

import io
import json
import os
import tarfile
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from spriteloom.sources import storage


#: Tars that a task keeps open, bytes of tars that it reads, about, and files that are moved side by side.
OPEN, READ_BYTES, MOVES = 64, 16 << 20, 16


@dataclass
class Written(WriterCommitMessage):
    """The files (bucket, name) of a task's attempt."""

    attempt: str
    files: list[tuple[str, str]]


class _Tar:
    """A tar that is written as a stream; names that meet get a number."""

    def __init__(self, system, path: str):
        system.create_dir(os.path.dirname(path))
        self.stream, self.names = system.open_output_stream(path), Counter()
        self.tar = tarfile.open(fileobj=self.stream, mode="w|")

    def add(self, name: str, **members: bytes) -> None:
        self.names[name] += 1
        name = name if self.names[name] == 1 else f"{name}-{self.names[name]}"
        for kind, data in members.items():
            info = tarfile.TarInfo(f"{name}.{kind}")
            info.size = len(data)
            self.tar.addfile(info, io.BytesIO(data))

    def close(self) -> None:
        self.tar.close()
        self.stream.close()


class TarWriter(DataSourceWriter):
    """Rows (bucket, shard, name, png, json), clustered by bucket and shard; a shard is one tar file.  A null bucket is called ``none``.

    Some tars are open at a time: rows of more shards than ``OPEN`` must be sorted by bucket and shard within their partition.
    """

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, rows):
        from pyspark import TaskContext

        attempt = f"{self.path}/_jobs/{self.job}/{TaskContext.get().taskAttemptId()}"
        system, folder = storage.place(attempt)
        tars: dict[tuple[str, str], _Tar] = {}
        files: dict[tuple[str, str], None] = {}
        try:
            for row in rows:
                bucket = row["bucket"] or "none"
                key = (bucket, f"{bucket}_shard_{row['shard']:06d}.tar")
                if key not in tars:
                    if key in files:
                        raise ValueError("rows of one shard are far apart: sort them by bucket and shard within partitions")
                    if len(tars) == OPEN:
                        tars.pop(next(iter(tars))).close()
                    tars[key], files[key] = _Tar(system, f"{folder}/{'/'.join(key)}"), None
                tars[key].add(row["name"], png=row["png"] or b"", json=(row["json"] or "").encode())
        finally:
            for tar in tars.values():
                tar.close()
        return Written(attempt, list(files))

    def commit(self, messages):
        system, root = storage.place(self.path)
        wanted = [(m.attempt, bucket, name) for m in messages if m for bucket, name in m.files]
        earlier = committed(self.path)
        new = {f"{bucket}/{name}" for _, bucket, name in wanted}
        if len(new) < len(wanted):
            self.abort(messages)
            raise ValueError("rows of one shard were in two tasks: cluster them by bucket and shard")
        if not self.overwrite and (there := sorted(new & {f for files in earlier.values() for f in files})):
            self.abort(messages)
            raise FileExistsError(f"{there[0]} is there already, of an earlier job")
        for bucket in {bucket for _, bucket, _ in wanted}:
            system.create_dir(f"{root}/{bucket}")

        def move(file):
            attempt, bucket, name = file
            system.move(f"{storage.place(attempt)[1]}/{bucket}/{name}", f"{root}/{bucket}/{name}")

        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(move, wanted))
        storage.put(f"{self.path}/_committed/{self.job}.json", json.dumps(sorted(new)).encode())
        if self.overwrite:
            for job, files in earlier.items():
                system.delete_file(f"{root}/_committed/{job}.json")
                for file in set(files) - new:
                    system.delete_file(f"{root}/{file}")
        storage.remove(f"{self.path}/_jobs/{self.job}")

    def abort(self, messages):
        storage.remove(f"{self.path}/_jobs/{self.job}")


def committed(path: str) -> dict[str, list[str]]:
    """The files, as bucket/name, of each committed job."""
    jobs = {}
    for file in storage.names(f"{path}/_committed", ".json"):
        with storage.place(path)[0].open_input_stream(file) as stream:
            jobs[os.path.basename(file).removesuffix(".json")] = json.loads(stream.read())
    return jobs


class TarPartition(InputPartition):
    def __init__(self, *paths: str):
        self.paths = paths


class TarReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        """Small tars share a task."""
        sizes, parts, held = storage.sizes(self.path), [[]], 0
        for file in (file for files in committed(self.path).values() for file in files):
            if held >= READ_BYTES:
                parts.append([])
                held = 0
            parts[-1].append(f"{self.path}/{file}")
            held += sizes.get(file, READ_BYTES)
        return [TarPartition(*paths) for paths in parts]

    def read(self, partition):
        for path in partition.paths:
            yield from self._samples(path)

    def _samples(self, path: str):
        """A member at a time: a sample is given out when it is complete, and only samples that aren't are held."""
        bucket, name = path.split("/")[-2:]
        shard, held = int(name.rpartition("_")[2].removesuffix(".tar")), {}
        system, path = storage.place(path)
        with system.open_input_stream(path) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
            for info in tar:
                key, _, kind = info.name.rpartition(".")
                got = held.setdefault(key, {})
                got[kind] = tar.extractfile(info).read()
                if len(got) == 2:
                    held.pop(key)
                    yield bucket, shard, key, got.get("png"), got.get("json", b"").decode()
        for key, got in held.items():
            yield bucket, shard, key, got.get("png"), got.get("json", b"").decode()


class WebDataset(DataSource):
    @classmethod
    def name(cls):
        return "webdataset"

    def schema(self):
        return "bucket string, shard long, name string, png binary, json string"

    def writer(self, schema, overwrite):
        return TarWriter(self.options["path"], overwrite)

    def reader(self, schema):
        return TarReader(self.options["path"])
