"""The mirror table: an append-only version log, collapsed when read and compacted on request."""

from __future__ import annotations

from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from brookmark.sources.attribute import AttributeTable
from brookmark.sources.files import Folders
from brookmark.sources.tables import SlotTable
from brookmark.specs import TableSpec
from brookmark.streaming.cdc import DELETED, VERSION, collapse, current, parse_cdc, tie_order

#: Number of the log folder that holds the columns and no rows.
NO_BATCH = -1
#: Key slots of a month mirror are so many times wider, since their rows part into months.
MONTHS = 12


class Mirror:
    """Versions of one table under ``path``.

    ``log/batch_id=<n>`` holds the versions of one micro-batch; a batch that is run again
    overwrites itself. ``base`` holds compacted versions cut into key slots. ``folded`` gets one row
    per compaction, the last batch that is wholly in the base, once the base is in place; only log
    batches after it are read. Reading is the newest version over base and log, and because that is
    idempotent it does not matter where a compaction was interrupted: without its row the batches
    are read from both. Batches come with rising numbers, as a stream gives them; one at or below the
    mark may only be a repetition. A rebuild from the first message takes a new path.

    Each of the three folders begins with a file without rows (``prepare``), which maintenance never removes, so
    that SQL on the folders finds their columns whatever has come or gone.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, width: int | None = 1_000_000):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.base = SlotTable(spark, f"{self.path}/base", spec.primary_key, width)

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(f.name, f.dataType, True) for f in self.spec.schema.fields]
        return (
            T.StructType(fields)
            .add(VERSION, T.LongType())
            .add(DELETED, T.BooleanType())
            .add("seq", T.LongType())
            .add("batch_id", T.LongType())
        )

    def prepare(self) -> None:
        """Lay down the folders with their columns, where that was not done yet."""
        folders = Folders(self.spark, self.path)
        rows = [f for f in self.schema.fields if f.name != "batch_id"]
        for part, schema in (
            (f"log/batch_id={NO_BATCH}", T.StructType(rows)),
            ("folded", T.StructType([T.StructField("upto", T.LongType())])),
            *self._base_folders(),
        ):
            if not folders.exists(f"{part}/_SUCCESS"):
                self.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{part}")

    def _base_folders(self) -> list[tuple[str, T.StructType]]:
        return [("base/slot=-1", self.schema)]

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Store a micro-batch, at most one version per key; used as the stream's batch function."""
        rows = batch if "seq" in batch.columns else batch.withColumn("seq", F.lit(None).cast("long"))
        newest = collapse(rows, self.spec).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (
            newest.select(*self.schema.fieldNames())
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(f"{self.path}/log")
        )

    def _stored(self, part: str, schema: T.StructType | str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def folded(self) -> int | None:
        """Last log batch that the base holds."""
        return self._stored("folded", "upto long").agg(F.max("upto")).first()[0]

    def _log(self) -> DataFrame:
        """Log batches that the base does not hold yet; the folders of others are not opened."""
        log, mark = self._stored("log", self.schema), self.folded()
        return log if mark is None else log.where(F.col("batch_id") > mark)

    def versions(self) -> DataFrame:
        """Every version that counts, collapsed or not."""
        log, base = self._log(), self.base.read_or_none()
        return log if base is None else base.select(*log.columns).unionByName(log)

    def current(self) -> DataFrame:
        return current(self.versions(), self.spec)

    def compact(self, upto: int | None = None) -> None:
        """Fold log batches into the base, rewriting only the key slots they touch.

        The last batch is settled first, so that one which arrives meanwhile is left for the next
        compaction; the mark is written last.
        """
        log = self._log() if upto is None else self._log().where(F.col("batch_id") <= upto)
        last = log.agg(F.max("batch_id")).first()[0]
        if last is None:
            return
        log = log.where(F.col("batch_id") <= last)
        news = collapse(log, self.spec)
        stored = self.base.touched(log)
        if stored is not None:
            news = collapse(stored.select(*log.columns).unionByName(log), self.spec)
        self.base.write(news)
        mark = self.spark.createDataFrame([(last,)], "upto long").coalesce(1)
        mark.write.mode("append").parquet(f"{self.path}/folded")

    def compacted_batches(self, upto: int | None = None) -> DataFrame:
        """Log folders that the base has made redundant, all of them or those up to a batch."""
        mark = self.folded()
        last = -1 if mark is None else mark if upto is None else min(mark, upto)
        batches = self._stored("log", self.schema).where(F.col("batch_id").between(0, last)).select("batch_id").distinct()
        return batches.select(
            F.concat(F.lit(f"{self.path}/log/batch_id="), F.col("batch_id").cast("string")).alias("path")
        )


class MonthMirror(Mirror):
    """Mirror whose base lies in folders of the month of the specification's partition column.

    The column never changes, so all versions of a key belong to one month, except that a delete may come
    with the key alone: its date is then the default and its month a wrong one. The map of keys beside
    the base gives such a tombstone the month of the row that it ends, and the collapse is by key
    over all folders a key may lie in, so a late delete hides its row in whatever month it was logged.
    A tombstone that comes before its row stays in its own month until the row comes, which it then hides.

    A slot of the base is ``MONTHS`` times as wide as ``width``: keys that do not rise with the date lie in every month,
    and slots of ``width`` keys would give very many folders of few rows, each with its own file.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, width: int | None = 1_000_000):
        if spec.partition_column is None:
            raise ValueError(f"{spec.name} has no partition column")
        super().__init__(spark, path, spec, width)
        stored = T.StructType([*self.schema.fields, T.StructField("month", T.StringType())])
        self.base = AttributeTable(spark, f"{self.path}/base", spec.primary_key, "month", stored, width and width * MONTHS)

    def _base_folders(self) -> list[tuple[str, T.StructType]]:
        return [("base/month=none/slot=-1", self.schema)]

    def _month(self) -> Column:
        return F.date_format(self.spec.partition_column, "yyyy-MM")

    def _settle(self, stored: DataFrame | None, batch: DataFrame, once: bool) -> DataFrame:
        """Newest version of each key; a tombstone keeps the month its key was in, a row takes its own.

        ``stored`` holds each key once, ``batch`` as well where it comes from ``once`` log folder alone.
        """
        news = batch if once else collapse(batch, self.spec)
        if stored is None:
            return news.withColumn("month", self._month())
        key, ties = self.spec.primary_key, tie_order(batch.columns, self.spec)
        both = stored.alias("s").join(news.alias("n"), F.col(f"s.{key}") == F.col(f"n.{key}"), "full_outer")
        # in structs a null is below all values, as in the order of a collapse
        rank = {side: F.struct(*[F.col(f"{side}.{c}") for c in ties]) for side in "sn"}
        wins = F.col(f"s.{key}").isNull() | (F.col(f"n.{key}").isNotNull() & (rank["n"] > rank["s"]))
        rows = [c for c in batch.columns if c != "month"]
        newest = both.select(*[F.when(wins, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in rows], F.col("s.month").alias("was"))
        month = F.when(F.col(DELETED), F.coalesce("was", self._month())).otherwise(self._month())
        return newest.withColumn("month", month).drop("was")

    def compact(self, upto: int | None = None) -> None:
        """Fold log batches into the base, rewriting only the months and key slots they touch."""
        log = self._log() if upto is None else self._log().where(F.col("batch_id") <= upto)
        first, last = log.agg(F.min("batch_id"), F.max("batch_id")).first()
        if last is None:
            return
        news = log.where(F.col("batch_id").between(first, last)).withColumn("month", self._month())
        settle = partial(self._settle, once=first == last)
        self.base.merge(news, combine=settle, stays=F.col(DELETED))
        mark = self.spark.createDataFrame([(last,)], "upto long").coalesce(1)
        mark.write.mode("append").parquet(f"{self.path}/folded")

    def month(self, month: str) -> DataFrame:
        """Live rows of one month (``yyyy-MM``).

        A live row of the month lies in its folder of the base or has come in the log, dated in the month. So of the
        base that folder is opened, and the folders of keys that the log names in this month; all news of
        these keys in the log count, whatever month they are logged under.
        """
        log, key = self._log(), self.spec.primary_key
        base = self.base.read()
        named = log.where((self._month() == month) & ~F.col(DELETED)).select(key).distinct()
        own = base.where(F.col("month") == month)
        elsewhere = ~F.col("value").eqNullSafe(month)
        others = [r[0] for r in self.base.places_of(named).where(elsewhere).select("value").distinct().collect()]  # folder names
        if others:
            there = F.col("month").isin([m for m in others if m is not None])
            rows = base.where(there | F.col("month").isNull() if None in others else there)
            own = own.unionByName(rows.join(named, key, "left_semi").select(*own.columns))
        versions = own.select(*log.columns).unionByName(log)
        return current(versions, self.spec).where(self._month() == month)


def mirror_of(spark: SparkSession, path: str, spec: TableSpec) -> Mirror:
    """Mirror in the layout the specification asks for."""
    return (Mirror if spec.partition_column is None else MonthMirror)(spark, path, spec)


def run_mirror(stream: DataFrame, spec: TableSpec, path: str, checkpoint: str,
               once: bool = False, interval: str = "10 seconds") -> StreamingQuery:
    """Keep a mirror of a change-log stream.

    The same checkpoint resumes where it stopped; a new checkpoint and path rebuild from the
    earliest message. ``once`` works off what is there and stops.
    """
    spark = stream.sparkSession
    mirror = mirror_of(spark, path, spec)
    mirror.prepare()
    writer = parse_cdc(stream, spec).writeStream.foreachBatch(mirror.append).option(
        "checkpointLocation", checkpoint
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
