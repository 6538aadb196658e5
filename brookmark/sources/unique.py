"""Index of a unique secondary key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmark.operators.merge import UniqueViolation, unique_violations
from brookmark.sources.tables import SlotTable


class UniqueIndex:
    """(value, key) pairs of a stored table in slots of the value, so that a batch is checked against the slots
    its values fall into and not against the whole table.

    Pairs are added before the table is merged and stay when a key takes another value, so the index holds all
    pairs of the table and maybe some that no longer hold. A pair that would be in the way is therefore
    looked up in the table, in the slots of the few keys concerned. Nothing has to be undone after a
    failed merge. NULL values are not unique and not held.
    """

    def __init__(self, table: SlotTable, column: str, path: str | None = None, slots: int = 4096):
        self.table, self.column, self.key = table, column, table.key
        self.pairs = SlotTable(table.spark, path or f"{table.path}.unique/{column}", column, None, slots)

    @property
    def spark(self) -> SparkSession:
        return self.table.spark

    def _pairs_of(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.column, self.key).where(F.col(self.column).isNotNull()).distinct()

    def build(self) -> None:
        """Index a table that was stored without one; a single pass."""
        stored = self.table.read_or_none()
        if stored is not None and self.pairs.read_or_none() is None:
            self.pairs.write(self._pairs_of(stored))

    def add(self, batch: DataFrame) -> None:
        """Take up a batch's pairs; only slots of its values are rewritten."""
        arriving = self._pairs_of(batch)
        held = self.pairs.touched(arriving)
        self.pairs.write(arriving if held is None else held.select(*arriving.columns).unionByName(arriving).distinct())

    def holders(self, batch: DataFrame) -> DataFrame:
        """(value, key) of stored rows outside the batch that hold a value of the batch."""
        arriving = self._pairs_of(batch)
        held = self.pairs.touched(arriving)
        if held is None:
            return arriving.limit(0)
        suspects = (
            held.join(arriving.select(self.column).distinct(), self.column, "left_semi")
            .join(batch.select(self.key), self.key, "left_anti")
            .select(self.column, self.key)
        )
        stored = self.table.touched(suspects)
        if stored is None:
            return arriving.limit(0)
        return stored.select(self.column, self.key).join(suspects, [self.column, self.key], "left_semi")

    def conflicts(self, batch: DataFrame) -> DataFrame:
        """Values that would belong to several keys if the batch were merged, with the number of keys."""
        both = self.holders(batch).unionByName(self._pairs_of(batch))
        return unique_violations(both, self.column, self.key)

    def check(self, batch: DataFrame) -> None:
        if not self.conflicts(batch).isEmpty():
            raise UniqueViolation(f"{self.column} would belong to more than one {self.key}")
