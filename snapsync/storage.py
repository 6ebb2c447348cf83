"""File-system calls on the driver, through Hadoop so that any store works."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


class Storage:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = self._jvm.org.apache.hadoop.fs.Path(root)
        self._fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        path = self.root
        for part in parts:
            path = self._jvm.org.apache.hadoop.fs.Path(path, part)
        return path

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self.path(*parts))

    def children(self, *parts: str):
        """Status of each visible child; empty when there is no such directory."""
        path = self.path(*parts)
        if not self._fs.exists(path):
            return []
        found = self._fs.listStatus(path)
        return [s for s in found if not s.getPath().getName().startswith(("_", "."))]

    def child_names(self, *parts: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.children(*parts))

    def size(self, *parts: str) -> int:
        return self._fs.getContentSummary(self.path(*parts)).getLength()

    def modified(self, *parts: str) -> float:
        """When a path was last changed, in seconds since the epoch."""
        return self._fs.getFileStatus(self.path(*parts)).getModificationTime() / 1000

    def delete(self, *parts: str) -> None:
        if not parts:
            raise ValueError("refusing to delete the root")
        self._fs.delete(self.path(*parts), True)

    def make_folder(self, *parts: str) -> None:
        self._fs.mkdirs(self.path(*parts))

    def write_text(self, text: str, *parts: str) -> None:
        """Create a file that appears with all of its text or not at all."""
        *folder, name = parts
        draft, final = self.path(*folder, f"_{name}.draft"), self.path(*parts)
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if not self._fs.rename(draft, final):
            raise OSError(f"could not create {final}")

    def read_text(self, *parts: str) -> str | None:
        if not self.exists(*parts):
            return None
        stream = self._fs.open(self.path(*parts))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder for one run, where every executor can see it."""
    shared = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="snapsync-")
    return f"{shared.rstrip('/')}/snapsync/{label}-{uuid.uuid4().hex[:12]}"
