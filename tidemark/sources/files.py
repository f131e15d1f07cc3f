"""Immutable files on any file system Spark knows, and files that only one writer can create.

A file is written as a draft and then published under its name, so no reader sees a part of it and a writer that
dies leaves a draft that nobody reads. Local paths are published by a hard link, which fails where the name exists.
Elsewhere Hadoop's rename without overwrite does the same on file systems where it is exclusive; others, such as plain
object stores, where two writers could both believe they were first, are refused. A root is absolute, as a path or as a
URI with any number of slashes, so every process that names it means one folder.
"""

from __future__ import annotations

import os
import re
import uuid
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from tidemark.errors import StoreError


#: Schemes whose rename without overwrite is exclusive.
EXCLUSIVE = ("hdfs", "viewfs", "abfs", "abfss", "ofs")
_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*):(.*)", re.DOTALL)
_DRAFT = ".tmp"


def place_of(root: str) -> tuple[str, str | None]:
    """(root as Spark is given it, local path or None). ``file:/x``, ``file://host-less/`` forms and plain paths
    of one folder are one root."""
    scheme, rest = m.groups() if (m := _URI.fullmatch(root)) else ("file", root)
    if scheme.lower() == "file":
        path = re.sub(r"^/+", "/", rest)
        if not path.startswith("/"):
            raise StoreError(f"the root must be absolute, not {root!r}")
        local = os.path.normpath(path)
        return f"file://{local}", local
    if scheme.lower() not in EXCLUSIVE:
        raise StoreError(f"{scheme} can't create a file exclusively; keep the log on one of file, {', '.join(EXCLUSIVE)}")
    return root.rstrip("/"), None


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root, self.local = place_of(root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _hadoop(self, name: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def create(self, name: str, text: str) -> bool:
        """Writes a new file as a whole; False if there is one of this name."""
        if self.local is not None:
            place = f"{self.local}/{name}"
            os.makedirs(os.path.dirname(place), exist_ok=True)
            with open(draft := f"{place}.{uuid.uuid4().hex}{_DRAFT}", "w", encoding="utf-8") as file:
                file.write(text)
            try:
                os.link(draft, place)
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
            return True
        fs, path = self._hadoop(name)
        if fs.exists(path):
            return False
        draft = path.suffix(f".{uuid.uuid4().hex}{_DRAFT}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self._publish(fs, draft, path)
        except Exception:  # the race was lost, or the store failed: a look at the file tells
            if fs.exists(path):
                return False
            raise
        finally:
            fs.delete(draft, False)
        return True

    def _publish(self, fs, draft, path) -> None:
        """Renames, and fails where the name is taken."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        hadoop.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, path, options)

    def read(self, name: str) -> str | None:
        if self.local is not None:
            try:
                with open(f"{self.local}/{name}", encoding="utf-8") as file:
                    return file.read()
            except FileNotFoundError:
                return None
        fs, path = self._hadoop(name)
        if not fs.exists(path):
            return None
        source = fs.open(path)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        source.close()
        return text

    def names(self, folder: str) -> list[str]:
        if self.local is not None:
            place = f"{self.local}/{folder}"
            return sorted(n for n in os.listdir(place) if not n.endswith(_DRAFT)) if os.path.isdir(place) else []
        fs, path = self._hadoop(folder)
        return sorted(n for s in fs.listStatus(path) if not (n := s.getPath().getName()).endswith(_DRAFT)) if fs.exists(path) else []

    def modified(self, name: str) -> datetime:
        """When the file was written, in UTC without zone."""
        if self.local is not None:
            seconds = os.stat(f"{self.local}/{name}").st_mtime
        else:
            fs, path = self._hadoop(name)
            seconds = fs.getFileStatus(path).getModificationTime() / 1000
        return datetime.fromtimestamp(seconds, UTC).replace(tzinfo=None)
