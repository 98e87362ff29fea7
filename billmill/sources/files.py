"""Folders and files through Hadoop's file systems, so that every URI that Spark reads works here too."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


class Files:
    """The file systems of a session."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark.sparkContext._jvm
        self._configuration = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, place: str) -> tuple[JavaObject, JavaObject]:
        path = self._jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(self._configuration), path

    def exists(self, place: str) -> bool:
        store, path = self._at(place)
        return store.exists(path)

    def names(self, folder: str) -> list[str]:
        """The names of all entries of a folder, sorted; none if there is no such folder."""
        store, path = self._at(folder)
        return sorted(s.getPath().getName() for s in store.listStatus(path)) if store.exists(path) else []

    def rename(self, place: str, to: str) -> None:
        """Move a file or folder to a place that is free; fails if it is not."""
        store, path = self._at(place)
        target = self._jvm.org.apache.hadoop.fs.Path(to)
        if store.exists(target):
            raise FileExistsError(to)
        store.mkdirs(target.getParent())
        if not store.rename(path, target):
            raise OSError(f"cannot rename {place} to {to}")

    def delete(self, place: str) -> None:
        store, path = self._at(place)
        store.delete(path, True)

    def read(self, place: str) -> str:
        store, path = self._at(place)
        stream = store.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, place: str, text: str) -> None:
        """A new file that appears under its name only when it is complete."""
        store, path = self._at(place + ".part")
        stream = store.create(path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.rename(place + ".part", place)

    def inputs(self, pattern: str) -> list[tuple[str, int]]:
        """The files that a read of ``pattern`` (file, folder or glob) finds, with their sizes."""
        store, path = self._at(pattern)
        found: list[tuple[str, int]] = []
        open_ = list(store.globStatus(path) or [])
        while open_:
            status = open_.pop()
            if status.isDirectory():
                open_ += [s for s in store.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._"]
            else:
                found.append((status.getPath().toString(), status.getLen()))
        return sorted(found)

    def size(self, place: str) -> int:
        """Bytes of all files below a place."""
        store, path = self._at(place)
        return store.getContentSummary(path).getLength()
