"""Dated landing area: one folder per day and run, rewritten only by a rerun of that run."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmark.specs import TableSpec


def bronze_root(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.name}_source"


def run_stamp(logical_time: datetime) -> str:
    return logical_time.strftime("%Y%m%dT%H%M%S")


def write_bronze(
    df: DataFrame, root: str, spec: TableSpec, logical_time: datetime, max_rows: int = 5_000_000
) -> Observation:
    """Land a batch under its day and run; returns what the same pass observed: ``rows_synced`` and
    ``mark``, the highest cursor in microseconds (null without one).

    Dynamic partition overwrite makes a retry replace its own files and leaves other runs alone.
    """
    loaded = Observation(f"rows_synced_{spec.name}")
    mark = F.max(F.unix_micros(spec.cursor_column)) if spec.cursor_column else F.max(F.lit(None).cast("long"))
    (
        df.observe(loaded, F.count(F.lit(1)).alias("rows_synced"), mark.alias("mark"))
        .withColumn("ingest_date", F.lit(logical_time.date()))
        .withColumn("run_id", F.lit(run_stamp(logical_time)))
        .write.partitionBy("ingest_date", "run_id")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows)
        .parquet(bronze_root(root, spec))
    )
    return loaded


def bronze_schema(spec: TableSpec) -> T.StructType:
    return (
        T.StructType([T.StructField(f.name, f.dataType, True) for f in spec.schema.fields])
        .add("ingest_date", T.DateType())
        .add("run_id", T.StringType())
    )


def _read_under(spark: SparkSession, root: str, spec: TableSpec, folder: str) -> DataFrame:
    schema, base = bronze_schema(spec), bronze_root(root, spec)
    try:
        return spark.read.schema(schema).option("basePath", base).parquet(f"{base}{folder}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_bronze_history(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """Every landed run of a table; a root that was never written reads as no rows."""
    return _read_under(spark, root, spec, "")


def read_bronze_day(
    spark: SparkSession, root: str, spec: TableSpec, day: str | None = None
) -> DataFrame:
    """Runs landed on one day (``yyyymmdd``, today by default); only its folder is listed."""
    wanted = datetime.strptime(day, "%Y%m%d").date() if day else date.today()
    landed = _read_under(spark, root, spec, f"/ingest_date={wanted.isoformat()}")
    return landed.where(F.col("ingest_date") == F.lit(wanted))
