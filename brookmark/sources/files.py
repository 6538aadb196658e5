"""File listings and explicit deletion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Files under a folder as ``(path, modified_at, bytes)``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(
            F.col("path"), F.col("modificationTime").alias("modified_at"), F.col("length").alias("bytes")
        )
    )


def delete_listed(spark: SparkSession, stale: DataFrame, column: str = "path") -> int:
    """Delete the listed files or folders through Spark's file system layer; returns how many.

    Selection never deletes by itself: callers pass a listing they have looked at. Rows come to
    the driver one partition at a time.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for row in stale.select(column).distinct().toLocalIterator():
        target = jvm.org.apache.hadoop.fs.Path(row[0])
        gone += bool(target.getFileSystem(conf).delete(target, True))
    return gone


class Folders:
    """Folder operations of the driver through Spark's file system layer."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path, self.root = jvm.org.apache.hadoop.fs.Path, root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._io = jvm.org.apache.commons.io.IOUtils

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def listed(self, name: str = "", depth: int = 1) -> list[str]:
        """Folders so many levels below one, as names relative to it; hidden ones are left out."""
        found = [""] if self.exists(name) else []
        for _ in range(depth):
            found = [
                f"{above}/{child.getPath().getName()}".lstrip("/")
                for above in found
                for child in self._fs.listStatus(self._at(f"{name}/{above}".strip("/")))
                if child.isDirectory() and not child.getPath().getName().startswith(("_", "."))
            ]
        return sorted(found)

    def files(self, name: str) -> list[str]:
        """Names of the files in a folder, in order; none where there is no folder."""
        if not self.exists(name):
            return []
        found = self._fs.listStatus(self._at(name))
        names = [f.getPath().getName() for f in found if f.isFile()]
        return sorted(n for n in names if not n.startswith(("_", ".")))

    def delete(self, name: str) -> bool:
        return self._fs.delete(self._at(name), True)

    def move(self, name: str, to: str) -> None:
        """Put a folder in the place of another one."""
        self.delete(to)
        self._fs.mkdirs(self._at(to).getParent())
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"could not move {name} to {to} under {self.root}")

    def write_text(self, name: str, text: str) -> None:
        out = self._fs.create(self._at(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, name: str) -> str:
        source = self._fs.open(self._at(name))
        try:
            return bytes(self._io.toByteArray(source)).decode()
        finally:
            source.close()
