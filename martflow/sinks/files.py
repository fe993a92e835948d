"""Small text files in whatever store Spark reaches, read and put from the driver."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


_KEPT: dict[tuple, str] = {}
_MOST_KEPT = 1000


@dataclass(frozen=True)
class Found:
    """A file or folder: name, bytes, and when it was written (epoch ms)."""

    name: str
    size: int
    modified: int
    is_folder: bool


class Files:
    """A folder's files; a file is there as a whole or not at all."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark._jvm
        self.folder = folder
        conf = spark._jsc.hadoopConfiguration()
        self.store = self._path("").getFileSystem(conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def listed(self, name: str = "") -> list[Found]:
        """What a folder holds, by name; hidden files left out."""
        if not self.exists(name):
            return []
        found = [
            Found(s.getPath().getName(), s.getLen(), s.getModificationTime(), s.isDirectory())
            for s in self.store.listStatus(self._path(name))
        ]
        shown = [f for f in found if not f.name.startswith((".", "_"))]
        return sorted(shown, key=lambda f: f.name)

    def exists(self, name: str) -> bool:
        return self.store.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self.store.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read_once(self, found: Found, folder: str) -> str:
        """A file that is never written again, kept for the next who asks for it."""
        name = f"{folder}/{found.name}"
        key = (f"{self.folder}/{name}", found.modified, found.size)
        if key not in _KEPT:
            if len(_KEPT) >= _MOST_KEPT:
                _KEPT.clear()
            _KEPT[key] = self.read(name)
        return _KEPT[key]

    def put(self, name: str, text: str) -> None:
        """Write a file under a hidden name, then give it its own."""
        parent, _, last = name.rpartition("/")
        hidden = f"{parent}/.{last}.{uuid.uuid4().hex}"
        stream = self.store.create(self._path(hidden), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.store.rename(self._path(hidden), self._path(name)):
            raise FileExistsError(f"{self.folder}/{name}")

    def make(self, name: str = "") -> None:
        self.store.mkdirs(self._path(name))

    def copy(self, name: str, to: str) -> None:
        util, conf = self.jvm.org.apache.hadoop.fs.FileUtil, self.store.getConf()
        util.copy(self.store, self._path(name), self.store, self._path(to), False, conf)

    def date(self, name: str, modified: int) -> None:
        """Date a file by epoch ms."""
        self.store.setTimes(self._path(name), modified, -1)

    def delete(self, name: str) -> None:
        self.store.delete(self._path(name), True)
