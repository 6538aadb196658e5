"""Counts of a mirror that follow its change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.operators.unions import union_all
from brookmark.sources.files import Folders
from brookmark.streaming.cdc import DELETED, collapse
from brookmark.streaming.mirror import Mirror


class FollowedCounts:
    """Live rows per value of a column, kept up by signed sums instead of counting again.

    For each micro-batch the rows of its keys before and after it are compared: a live row before counts -1, one after
    +1, so late, repeated and deleting messages come out right. The differences are stored
    under the batch's number before the batch itself, once; a batch that is run again finds them there. Only
    keys of the batch are looked up in the mirror.
    """

    def __init__(self, mirror: Mirror, by: str):
        self.mirror, self.by = mirror, by
        self.folders = Folders(mirror.spark, f"{mirror.path}/counts_{by}")

    def feed(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """(key, before, after): the counted value of each key of a batch where its row is live."""
        spec, key = self.mirror.spec, self.mirror.spec.primary_key
        rows = batch if "seq" in batch.columns else batch.withColumn("seq", F.lit(None).cast("long"))
        names = self.mirror.schema.fieldNames()
        news = rows.withColumn("batch_id", F.lit(batch_id).cast("long")).select(*names)
        stored = self.mirror.versions().where(F.col("batch_id") < batch_id).select(*names)
        known = stored.join(news.select(key), key, "left_semi").select(*names)
        held, after = collapse(known, spec), collapse(known.unionByName(news), spec)

        def valued(df: DataFrame, name: str) -> DataFrame:
            return df.where(~F.col(DELETED)).select(key, F.struct(self.by).alias(name))

        return valued(held, "before").join(valued(after, "after"), key, "full_outer")

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Count a micro-batch, then store it; the stream's batch function."""
        name = f"batch_id={batch_id}"
        if not self.folders.exists(f"{name}/_SUCCESS"):
            both = self.feed(batch, batch_id)
            signed = union_all([
                both.where(f"{side} is not null").select(F.col(f"{side}.{self.by}").alias(self.by), F.lit(sign).alias("n"))
                for side, sign in (("before", -1), ("after", 1))
            ])
            sums = signed.groupBy(self.by).agg(F.sum("n").alias("n")).where(F.col("n") != 0)
            sums.write.mode("overwrite").parquet(f"{self.folders.root}/{name}")
        self.mirror.append(batch, batch_id)

    def counts(self) -> DataFrame:
        """(value, rows) of the values that have live rows."""
        spark, kind = self.mirror.spark, self.mirror.schema[self.by].dataType.simpleString()
        schema = f"`{self.by}` {kind}, n long, batch_id long"
        if not self.folders.exists():
            return spark.createDataFrame([], f"`{self.by}` {kind}, rows long")
        stored = spark.read.schema(schema).parquet(self.folders.root)
        return stored.groupBy(self.by).agg(F.sum("n").alias("rows")).where(F.col("rows") != 0)
