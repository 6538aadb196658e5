"""Bucketed tables, merged without moving what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brookmark.operators.merge import merge_upsert
from brookmark.sources.files import Folders
from brookmark.sources.tables import ensure_namespace


class BucketTable:
    """Versions of a table in buckets of its key, under ``path/v<n>``; ``layer.name`` is a view of the newest.

    A merge joins bucket with bucket: only the batch is shuffled, the stored side is read where it lies and the
    result is written from the same tasks. The new version is whole before the view is pointed to it. The
    one before is kept for queries that still read it.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, key: str, buckets: int):
        self.spark, self.name, self.path, self.key, self.buckets = spark, name, path.rstrip("/"), key, buckets

    def _table(self, version: int) -> str:
        return f"{self.name}_v{version}"

    def version(self) -> int | None:
        """Number of the newest version that is whole."""
        folders = Folders(self.spark, self.path)
        done = [int(f[1:]) for f in folders.listed() if folders.exists(f"{f}/_SUCCESS")]
        return max(done, default=None)

    def read(self) -> DataFrame:
        return self.spark.table(self._table(self.version()))

    def write(self, df: DataFrame) -> int:
        last = self.version()
        new = 0 if last is None else last + 1
        ensure_namespace(self.spark, self.name.rsplit(".", 1)[0])
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(new)}")
        (
            df.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
            .option("path", f"{self.path}/v{new}").mode("overwrite").saveAsTable(self._table(new))
        )
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {self._table(new)}")
        if new > 1:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(new - 2)}")
            Folders(self.spark, self.path).delete(f"v{new - 2}")
        return new

    def merged(self, updates: DataFrame, update_columns: tuple[str, ...], version: str | None = "updated_at") -> DataFrame:
        """The rows after a keyed upsert of a batch that holds each key once; nothing is written."""
        return merge_upsert(self.read(), updates, self.key, update_columns, version=version)

    def merge(self, updates: DataFrame, update_columns: tuple[str, ...], version: str | None = "updated_at") -> int:
        if self.version() is None:
            return self.write(updates)
        return self.write(self.merged(updates, update_columns, version))
