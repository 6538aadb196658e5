"""Ledger of loads: what each run brought and how far it got."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from brookmark.sources.files import Folders
from brookmark.specs import TableSpec


class LoadLedger:
    """One small file per run and table under ``loads/<table>``, written when all else of the run is done.

    Each holds the high-water mark of all runs up to it, so only the newest is read, and the target is never
    scanned for its mark. A run that stops before its file is written is simply read again by the
    next one, which keyed merges make harmless. A file that was cut short does not count.
    """

    SCHEMA = "table_name string, run long, logical_time string, rows_synced long, mark long"

    def __init__(self, spark: SparkSession, root: str, keep: int = 1000):
        self.spark, self.root, self.keep = spark, f"{root.rstrip('/')}/loads", keep
        self.folders = Folders(spark, self.root)

    def _last(self, spec: TableSpec) -> dict | None:
        for name in reversed(self.folders.files(spec.name)):
            try:
                return json.loads(self.folders.read_text(f"{spec.name}/{name}"))
            except ValueError:
                continue
        return None

    def mark(self, spec: TableSpec) -> int | None:
        """Highest cursor loaded, in microseconds."""
        last = self._last(spec)
        return None if last is None else last["mark"]

    def record(self, spec: TableSpec, logical_time: datetime, rows: int, mark: int | None) -> None:
        last = self._last(spec) or {"run": 0, "mark": None}
        marks = [m for m in (mark, last["mark"]) if m is not None]
        entry = {
            "table_name": spec.name, "run": last["run"] + 1, "logical_time": logical_time.isoformat(),
            "rows_synced": rows, "mark": max(marks) if marks else None,
        }
        self.folders.write_text(f"{spec.name}/{entry['run']:012d}.json", json.dumps(entry))
        for name in self.folders.files(spec.name)[: -self.keep]:
            self.folders.delete(f"{spec.name}/{name}")

    def runs(self) -> DataFrame:
        """The kept runs of all tables."""
        if not self.folders.exists():
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", "true").json(self.root)
