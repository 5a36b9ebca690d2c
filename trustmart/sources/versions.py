"""Numbered files of which each is written by one writer only."""

from __future__ import annotations

import os
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class StaleCommit(RuntimeError):
    """Another commit has come first; read the state anew and try again."""


class VersionFiles:
    """Small text files ``v000000001.txt`` ... in one folder, the newest of which counts.

    A version is created only if nobody has created it before, so of two writers that have read the
    same state one raises ``StaleCommit``. The last line of a file is ``end``: a file without it is a
    write that is still going on or was lost half-way. Readers pass it over. Writers wait for it, since
    they must not go on from the state before it, until it is ``grace`` seconds old: then its writer is
    taken for lost, and the number after it is next. Beside local files this needs a file system that
    creates atomically: HDFS, or an object store with conditional writes.
    """

    END = "end"

    def __init__(self, spark: SparkSession, folder: str, grace: float = 120):
        self.spark, self.folder, self.grace = spark, folder.rstrip("/"), grace

    def path(self, version: int):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/v{version:09d}.txt")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def numbers(self) -> list[int]:
        """All versions taken, newest first."""
        fs, some = self.path(0)
        folder = some.getParent()
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted((int(n[1:10]) for n in names if n.startswith("v") and n.endswith(".txt")), reverse=True)

    def _text(self, version: int) -> str | None:
        fs, path = self.path(version)
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        body, _, last = text.rpartition("\n")
        return body if last == self.END else None

    def _going_on(self, version: int) -> bool:
        fs, path = self.path(version)
        age = time.time() - fs.getFileStatus(path).getModificationTime() / 1000
        return age < self.grace and self._text(version) is None

    def newest(self, to_write: bool = False) -> tuple[int, str | None]:
        """The newest number taken, 0 if there is none, and the text of the newest whole file. With
        ``to_write``, a file that is being written is waited for."""
        numbers = self.numbers()
        while to_write and numbers and self._going_on(numbers[0]):
            time.sleep(0.2)
            numbers = self.numbers()
        text = next((t for t in map(self._text, numbers) if t is not None), None)
        return (numbers[0] if numbers else 0), text

    def create(self, version: int, text: str) -> None:
        fs, path = self.path(version)
        whole = f"{text}\n{self.END}".encode()
        try:
            if fs.getScheme() == "file":
                self._link(path.toUri().getPath(), whole)
            else:
                stream = fs.create(path, False)
                stream.write(bytearray(whole))
                stream.close()
        except (Py4JJavaError, FileExistsError) as error:
            if fs.exists(path):
                raise StaleCommit(f"version {version} has been committed by somebody else") from error
            raise

    @staticmethod
    def _link(path: str, whole: bytes) -> None:
        """Spark's local file system looks whether a file is there and then creates it, between which
        another writer may come; a link to a whole file cannot be made twice."""
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        with open(part, "wb") as out:
            out.write(whole)
        try:
            os.link(part, path)
        finally:
            os.remove(part)
