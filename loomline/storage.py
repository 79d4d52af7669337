"""Files beside the tables: listings, moves and small texts on the file system that a path names.

Paths of other schemes than file: go through Hadoop's file systems, so that a base on HDFS or
an object store works as a local one does. Local paths need no session.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def local(path: str) -> str:
    return path.removeprefix("file://")


def is_local(path: str) -> bool:
    return path.startswith("file:/") or "://" not in path


class LocalStore:
    """Files of this machine."""

    def exists(self, path: str) -> bool:
        return os.path.exists(local(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, in order; none if it does not exist."""
        return sorted(os.listdir(local(path))) if os.path.isdir(local(path)) else []

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files below a folder."""
        at = local(path)
        return os.path.getsize(at) if os.path.isfile(at) else sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(at) for n in names)

    def modified(self, path: str) -> float:
        return os.path.getmtime(local(path))

    def make(self, path: str) -> None:
        os.makedirs(local(path), exist_ok=True)

    def delete(self, path: str) -> None:
        at = local(path)
        if os.path.isdir(at):
            shutil.rmtree(at)
        elif os.path.exists(at):
            os.remove(at)

    def prune(self, path: str) -> None:
        """Delete a folder if it is empty."""
        with contextlib.suppress(OSError):
            os.rmdir(local(path))

    def move(self, source: str, target: str) -> None:
        """Rename; the target must not exist, its folder is made."""
        if self.exists(target):
            raise FileExistsError(target)
        self.make(os.path.dirname(local(target)))
        os.rename(local(source), local(target))

    def replace(self, source: str, target: str) -> None:
        """Rename a file over another."""
        self.make(os.path.dirname(local(target)))
        os.replace(local(source), local(target))

    def read(self, path: str) -> str:
        with open(local(path), encoding="utf-8") as f:
            return f.read()

    def write(self, path: str, text: str) -> None:
        self.make(os.path.dirname(local(path)))
        with open(local(path), "w", encoding="utf-8") as f:
            f.write(text)

    def join(self, first: bytes, parts: list[str], target: str) -> None:
        """A file of some bytes and then of whole files, in place only when complete."""
        self.make(os.path.dirname(local(target)))
        with open(f"{local(target)}.part", "wb") as out:
            out.write(first)
            for part in parts:
                with open(local(part), "rb") as f:
                    shutil.copyfileobj(f, out, 1 << 20)
        self.replace(f"{target}.part", target)

    def fetch(self, path: str) -> str:
        """A path of this machine with the same content."""
        return local(path)


class HadoopStore:
    """Files of whatever Hadoop file system a path names; see LocalStore for what each call does."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def at(self, path: str):
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.conf), place

    def exists(self, path: str) -> bool:
        files, place = self.at(path)
        return files.exists(place)

    def names(self, path: str) -> list[str]:
        files, place = self.at(path)
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) and files.getFileStatus(place).isDirectory() else []

    def size(self, path: str) -> int:
        files, place = self.at(path)
        return files.getContentSummary(place).getLength()

    def modified(self, path: str) -> float:
        files, place = self.at(path)
        return files.getFileStatus(place).getModificationTime() / 1000

    def make(self, path: str) -> None:
        files, place = self.at(path)
        files.mkdirs(place)

    def delete(self, path: str) -> None:
        files, place = self.at(path)
        files.delete(place, True)

    def prune(self, path: str) -> None:
        files, place = self.at(path)
        with contextlib.suppress(Py4JJavaError):  # as it is not empty
            files.delete(place, False)

    def move(self, source: str, target: str) -> None:
        if self.exists(target):
            raise FileExistsError(target)
        files, place = self.at(source)
        self.make(os.path.dirname(target))
        if not files.rename(place, self.at(target)[1]):
            raise OSError(f"cannot move {source} to {target}")

    def replace(self, source: str, target: str) -> None:
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self.make(os.path.dirname(target))
        files, place = self.at(source)
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.conf).rename(place, self.at(target)[1], how)

    def read(self, path: str) -> str:
        files, place = self.at(path)
        stream = files.open(place)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        self._put(path, text.encode("utf-8"), [])

    def _put(self, path: str, first: bytes, parts: list[str]) -> None:
        files, place = self.at(path)
        out = files.create(place, True)
        try:
            out.write(bytearray(first))
            for part in parts:
                own, at = self.at(part)
                stream = own.open(at)
                try:
                    self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                finally:
                    stream.close()
        finally:
            out.close()

    def join(self, first: bytes, parts: list[str], target: str) -> None:
        self._put(f"{target}.part", first, parts)
        self.replace(f"{target}.part", target)

    def fetch(self, path: str) -> str:
        folder = tempfile.mkdtemp(prefix="loomline-fetched-")
        files, place = self.at(path)
        files.copyToLocalFile(False, place, self.jvm.org.apache.hadoop.fs.Path(f"file://{folder}/{place.getName()}"), True)
        return f"{folder}/{place.getName()}"


def store_for(path: str, spark: SparkSession | None = None) -> LocalStore | HadoopStore:
    """The store that a path needs."""
    if is_local(path):
        return LocalStore()
    from loomline.session import build_session

    return HadoopStore(spark or build_session())
