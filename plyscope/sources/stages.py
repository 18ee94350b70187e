"""Stage cache: results that are stored once and known by what they were made from.

An entry is named by a stage and a fingerprint of its input files (path, length, time of change), their schemas and the
parameters given. Whoever misses writes into a fresh folder and publishes it by moving a finished manifest into place,
so an unfinished or failed write is never read, and sessions that share the folder share the entries. Nothing is
overwritten: a changed input, schema or parameter names another entry, and ``force`` publishes a new folder for the same
one. Of two writers at once one is published; both may be read, as they made the same.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
MANIFEST = "manifest-"


class StageCache:
    """Stages below ``root``, a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, text: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)

    def _system(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def files_of(self, data: DataFrame | str) -> list[tuple[str, int, int]]:
        """Path, length and time of change of every file behind a table or path; folders are listed once."""
        names = data.inputFiles() if isinstance(data, DataFrame) else [data]
        if not names:
            raise ValueError("an input that reads no files cannot be told from another; give what it depends on as a parameter")
        folders = {self._path(n).getParent().toString(): self._path(n).getParent() for n in names}
        found = {}
        for folder in folders.values():
            for status in self._system(folder).listStatus(folder):
                found[status.getPath().toUri().getPath()] = (status.getLen(), status.getModificationTime())
        plain = sorted(self._path(n).toUri().getPath() for n in names)
        missing = [p for p in plain if p not in found]
        if missing:
            raise FileNotFoundError(missing[0])
        return [(p, *found[p]) for p in plain]

    def fingerprint(self, inputs: Iterable[DataFrame | str], params: dict | None) -> str:
        said = {
            "inputs": [[self.files_of(d), d.schema.jsonValue() if isinstance(d, DataFrame) else None] for d in inputs],
            "params": params or {},
        }
        return hashlib.sha256(json.dumps(said, sort_keys=True, default=repr).encode()).hexdigest()[:32]

    def _published(self, entry: str) -> str | None:
        """Folder of the latest manifest of an entry."""
        folder = self._path(entry)
        system = self._system(folder)
        if not system.exists(folder):
            return None
        names = [s.getPath().getName() for s in system.listStatus(folder) if s.getPath().getName().startswith(MANIFEST)]
        if not names:
            return None
        stream = system.open(self._path(f"{entry}/{max(names)}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return f"{entry}/{json.loads(text)['data']}"

    def _publish(self, entry: str, data: str, about: dict) -> None:
        temporary = self._path(f"{entry}/.{uuid.uuid4().hex}")
        system = self._system(temporary)
        stream = system.create(temporary)
        stream.write(bytearray(json.dumps({"data": data, **about}, default=repr).encode()))
        stream.close()
        count = sum(s.getPath().getName().startswith(MANIFEST) for s in system.listStatus(self._path(entry)))
        # numbered in order; the name of the data keeps two writers apart
        target = self._path(f"{entry}/{MANIFEST}{count:06d}-{data}")
        if not system.rename(temporary, target):
            raise OSError(f"could not publish {target.toString()}")

    def stored(
        self,
        stage: str,
        write: Callable[[str], object],
        read: Callable[[str], T],
        inputs: Iterable[DataFrame | str] = (),
        params: dict | None = None,
        force: bool = False,
    ) -> T:
        """What ``read`` finds at the path of the entry, which ``write`` fills on a miss; tables and models alike."""
        entry = f"{self.root}/{stage}/{self.fingerprint(inputs, params)}"
        found = None if force else self._published(entry)
        if found is None:
            data = f"data-{uuid.uuid4().hex}"
            write(f"{entry}/{data}")
            self._publish(entry, data, {"stage": stage, "params": params or {}})
            found = f"{entry}/{data}"
        return read(found)

    def table(
        self,
        stage: str,
        build: Callable[[], DataFrame],
        inputs: Iterable[DataFrame | str] = (),
        params: dict | None = None,
        force: bool = False,
    ) -> DataFrame:
        """A stored table; ``build`` is not called on a hit."""
        return self.stored(stage, lambda path: build().write.parquet(path), self.spark.read.parquet, inputs, params, force)
