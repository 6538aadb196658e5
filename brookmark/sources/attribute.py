"""Keyed tables in folders of an attribute that may change."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmark.operators.merge import merge_upsert
from brookmark.sources.files import Folders

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: (stored rows or None before the first merge, batch) -> new rows
Combine = Callable[[DataFrame | None, DataFrame], DataFrame]
#: Folders that the driver moves at a time.
_MOVES = 16


def _any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


class AttributeTable:
    """Parquet table in folders ``<attribute>=<value>/slot=<n>``, so that a filter on the attribute opens only
    its folders.

    Slots are a function of the key, as in SlotTable. A map of each key's value lies beside the rows
    (``_keys/slot=<n>``, hidden from readers of the folder). A merge looks its keys up there, reads
    the folders they lie in and those they go to, and rewrites just these; a row whose attribute changed
    leaves its old folder. Of the map it rewrites the slots in which a key is new or moves.

    A merge is written aside (``_next``) first. Its last file, the plan, makes it valid; then the driver moves the
    folders in place and deletes those that became empty. A merge without a plan is thrown away by
    the next one, a merge with a plan is finished by it, so nothing is lost or kept twice wherever
    a job stops. There is one writer at a time; a reader that lists files while folders are
    moved may have to read again.

    An empty value lies in the folder ``=``; one that starts with ``=`` gets a second one in front. NULL has Spark's own folder.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, attribute: str, schema: T.StructType,
                 width: int | None = 1_000_000, slots: int = 4096, order_by: str | None = None):
        self.spark, self.path, self.key, self.attribute = spark, path.rstrip("/"), key, attribute
        self.schema, self.width, self.slots, self.order_by = schema, width, slots, order_by or key
        self.folders = Folders(spark, self.path)

    # places

    def slot_of(self) -> Column:
        key = F.col(self.key)
        if self.width and isinstance(self.schema[self.key].dataType, T.IntegralType):
            return F.floor(key / F.lit(self.width)).cast("long")
        return F.pmod(F.xxhash64(key), F.lit(self.slots)).cast("long")

    def _encoded(self) -> Column:
        value = F.col(self.attribute)
        return F.when((value == "") | value.startswith("="), F.concat(F.lit("="), value)).otherwise(value)

    def _decoded(self) -> Column:
        value = F.col(self.attribute)
        return F.when(value.startswith("="), F.substring(value, 2, 1 << 30)).otherwise(value)

    def _in(self, places: set[tuple[str | None, int]]) -> Column:
        by_value: dict[str | None, list[int]] = defaultdict(list)
        for value, slot in places:
            by_value[value].append(slot)
        own = F.col(self.attribute)
        return _any_of([
            (own.isNull() if value is None else own == F.lit(value)) & F.col("slot").isin(slots)
            for value, slots in by_value.items()
        ])

    # reading

    def _read(self, folder: str, names: list[str]) -> DataFrame:
        """Stored rows with their folder columns; none before the first write."""
        schema = T.StructType([T.StructField(n, self.schema[n].dataType, True) for n in names]).add("slot", T.LongType())
        if not self.folders.exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}".rstrip("/"))

    def _rows(self, folder: str = "") -> DataFrame:
        return self._read(folder, self.schema.fieldNames())

    def _keys(self) -> DataFrame:
        return self._read("_keys", [self.key, self.attribute])

    def read(self) -> DataFrame:
        """The rows; filters on the attribute prune folders."""
        self.recover()
        return self._rows().withColumn(self.attribute, self._decoded()).select(*self.schema.fieldNames())

    def read_or_none(self) -> DataFrame | None:
        self.recover()
        return self.read() if self.folders.exists("_keys") else None

    def places_of(self, keys: DataFrame) -> DataFrame:
        """(key, value) of the stored ones of some keys; only their slots of the map are opened."""
        self.recover()
        wanted = keys.select(self.key).distinct()
        slots = [r[0] for r in wanted.select(self.slot_of()).distinct().collect()]  # folder names
        known = self._keys().where(F.col("slot").isin(slots)).withColumn(self.attribute, self._decoded())
        return known.join(wanted, self.key, "left_semi").select(self.key, F.col(self.attribute).alias("value"))

    # writing

    def merge(self, updates: DataFrame, update_columns: tuple[str, ...] = (), version: str | None = "updated_at",
              combine: Combine | None = None, stays: Column | None = None) -> None:
        """Keyed upsert of a batch that holds each key once (see merge_upsert), or another ``combine``.

        The batch is stored before it is used, so it is worked out once. A ``combine`` takes it as it is: it is a stored
        one then, may hold a key several times, and its rows with ``stays`` leave a stored key where it is. It gives a
        row for each key of both sides, in the folder the key was in or in one the batch names.
        """
        self.recover()
        names = self.schema.fieldNames()
        batch, stays = updates.select(*names), F.lit(False) if stays is None else stays
        if combine is None:
            batch.write.mode("overwrite").parquet(f"{self.path}/_next/batch")
            batch = self.spark.read.schema(self._nullable()).parquet(f"{self.path}/_next/batch")
        at = batch.select(self.key, self._encoded().alias("new"), self.slot_of().alias("slot"), stays.alias("stays"))
        known = None
        if self.folders.exists("_keys"):
            slots = [r[0] for r in at.select("slot").distinct().collect()]  # folder names
            known = self._keys().where(F.col("slot").isin(slots))
            at = at.join(known.select(self.key, F.col(self.attribute).alias("old"), F.lit(True).alias("there")), self.key, "left")
            at = at.withColumn("new", F.when(F.col("there") & F.col("stays"), F.col("old")).otherwise(F.col("new")))
            moves = F.col("there").isNull() | ~F.col("new").eqNullSafe(F.col("old"))
            old = F.when(F.col("there"), F.col("old")).otherwise(F.col("new"))
        else:
            moves, old = F.lit(True), F.col("new")
        ends = at.select("new", old.alias("old"), "slot", moves.alias("moves")).distinct().collect()  # folder names
        places = {(r[end], r["slot"]) for r in ends for end in ("new", "old")}
        moved = sorted({r["slot"] for r in ends if r["moves"]})  # slots whose map of keys changes
        stored = self._rows().where(self._in(places)).withColumn(self.attribute, self._decoded()).select(*names)
        if combine is None:
            merged = merge_upsert(stored, batch, self.key, update_columns, version=version)
        else:
            merged = combine(None if known is None else stored, batch)
        (
            merged.select(*names).withColumn("slot", self.slot_of()).withColumn(self.attribute, self._encoded())
            .hint("rebalance", self.attribute, "slot")
            .sortWithinPartitions(self.attribute, "slot", self.order_by)
            .write.partitionBy(self.attribute, "slot").parquet(f"{self.path}/_next/rows")
        )
        if moved:
            keys = self._rows("_next/rows").where(F.col("slot").isin(moved)).select(self.key, self.attribute, "slot")
            if known is not None:
                # whatever lay in a folder that was read has been written again, so the map's other rows stay as they are
                folder = F.concat_ws("/", F.coalesce(self.attribute, F.lit(_NULL_FOLDER)), "slot")
                read = [f"{_NULL_FOLDER if value is None else value}/{slot}" for value, slot in places if slot in set(moved)]
                rest = known.where(F.col("slot").isin(moved) & ~folder.isin(read))
                keys = rest.select(*keys.columns).unionByName(keys)
            (
                keys.hint("rebalance", "slot").sortWithinPartitions("slot")
                .write.partitionBy("slot").parquet(f"{self.path}/_next/keys")
            )
        full = set(self.folders.listed("_next/rows", 2))
        held = {f for f in self.folders.listed("", 2) if self._place(f) in places}
        self.folders.write_text("_next/plan", json.dumps(sorted(held - full)))
        self.recover()

    def _nullable(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in self.schema.fields])

    def _place(self, folder: str) -> tuple[str | None, int]:
        value, slot = (unquote(part.split("=", 1)[1]) for part in folder.split("/"))
        return None if value == _NULL_FOLDER else value, int(slot)

    def recover(self) -> None:
        """Finish a merge that has its plan, throw one away that has none."""
        if not self.folders.exists("_next"):
            return
        if self.folders.exists("_next/plan"):
            emptied = json.loads(self.folders.read_text("_next/plan"))
            with ThreadPoolExecutor(_MOVES) as pool:
                list(pool.map(lambda f: self.folders.move(f"_next/rows/{f}", f), self.folders.listed("_next/rows", 2)))
                list(pool.map(self.folders.delete, emptied))
                list(pool.map(lambda f: self.folders.move(f"_next/keys/{f}", f"_keys/{f}"), self.folders.listed("_next/keys")))
        self.folders.delete("_next")
