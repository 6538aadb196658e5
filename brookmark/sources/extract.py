"""Full and incremental extracts with schema and key guards."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmark.specs import TableSpec

Reader = Callable[[SparkSession, TableSpec], DataFrame]


class SchemaMismatch(ValueError):
    """The source lacks columns its specification declares."""


class NullKey(ValueError):
    """A batch holds rows without a primary key."""


def jdbc_reader(url: str, lower: int, upper: int, partitions: int, **options: str) -> Reader:
    """Reader that splits a row-store table on its primary key, one range per task.

    Filters and the column list are pushed into the source query by Spark.
    """

    def read(spark: SparkSession, spec: TableSpec) -> DataFrame:
        return (
            spark.read.format("jdbc")
            .options(
                url=url,
                dbtable=spec.name,
                partitionColumn=spec.primary_key,
                lowerBound=str(lower),
                upperBound=str(upper),
                numPartitions=str(partitions),
                fetchsize="10000",
                **options,
            )
            .load()
        )

    return read


def key_bounds(spark: SparkSession, url: str, spec: TableSpec, **options: str) -> tuple[int, int]:
    """Smallest and largest primary key of a row-store table, for the ranges of jdbc_reader."""
    query = f"SELECT min({spec.primary_key}) AS lo, max({spec.primary_key}) AS hi FROM {spec.name}"
    row = jdbc_query(spark, url, query, **options).first()
    return row["lo"], row["hi"]


def jdbc_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Read-only query against an external row store; paging happens inside the source."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    present = set(df.columns)
    needed = list(spec.column_names)
    if spec.cursor_column and spec.cursor_column not in needed:
        needed.append(spec.cursor_column)
    return [c for c in needed if c not in present]


def check_schema(df: DataFrame | None, spec: TableSpec) -> DataFrame:
    """Fail naming every declared column the source lacks, or the table itself."""
    if df is None:
        raise SchemaMismatch(f"source table {spec.name} does not exist")
    missing = missing_columns(df, spec)
    if missing:
        raise SchemaMismatch(
            f"source table {spec.name} is missing {', '.join(missing)};"
            f" present: {', '.join(sorted(df.columns))}"
        )
    return df


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns only, each in its declared type (money never stays a double)."""
    schema = spec.schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def extract(spark: SparkSession, spec: TableSpec, reader: Reader) -> DataFrame:
    """Every row of a source table, declared columns only; partitions take the place of chunks."""
    try:
        source = reader(spark, spec)
    except AnalysisException as error:
        if error.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND"):
            source = None
        else:
            raise
    return conform(check_schema(source, spec), spec)


def high_water_mark(target: DataFrame | None, spec: TableSpec) -> datetime | None:
    """Largest cursor already loaded; None when there is no target, no row or no cursor."""
    if target is None or not spec.cursor_column or spec.cursor_column not in target.columns:
        return None
    return target.agg(F.max(spec.cursor_column)).first()[0]


def newer_than(
    source: DataFrame, spec: TableSpec, mark: datetime | int | None, overlap: timedelta = timedelta(0)
) -> DataFrame:
    """Rows with a cursor strictly above the mark (a time, or microseconds as a ledger keeps them).

    The mark is a literal, so the filter reaches the parquet or row-store scan. ``overlap`` reads
    a little behind the mark to pick up late commits; keyed merges make that harmless.
    """
    if mark is None:
        return source
    if isinstance(mark, int):
        line = F.timestamp_micros(F.lit(mark - overlap // timedelta(microseconds=1)))
    else:
        line = F.lit(mark - overlap)
    return source.where(F.col(spec.cursor_column) > line)


def extract_incremental(
    source: DataFrame,
    target: DataFrame | None,
    spec: TableSpec,
    overlap: timedelta = timedelta(0),
    mark: datetime | int | None = None,
) -> DataFrame:
    """Rows changed since the target was last loaded, or all of them on a first load.

    A known mark saves the scan of the target for it.
    """
    rows = conform(check_schema(source, spec), spec)
    return newer_than(rows, spec, high_water_mark(target, spec) if mark is None else mark, overlap)


def guard_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Same rows, but the job fails when one without a primary key comes by; no extra pass."""
    key = F.col(spec.primary_key)
    message = F.lit(f"null {spec.primary_key} in a {spec.name} batch")
    checked = F.when(key.isNull(), F.raise_error(message).cast(df.schema[spec.primary_key].dataType))
    return df.withColumn(spec.primary_key, checked.otherwise(key))


def assert_pk_not_null(df: DataFrame, spec: TableSpec) -> None:
    """Reject a batch that holds a null primary key (one column-pruned pass)."""
    if not df.where(F.col(spec.primary_key).isNull()).select(F.lit(1)).isEmpty():
        raise NullKey(f"null {spec.primary_key} in a {spec.name} batch")


def valid_batch(df: DataFrame, key: str, amount: str) -> DataFrame:
    """One row: how many records break the load rules (key present, amount not negative)."""
    return df.agg(
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(F.col(amount) < 0).alias("negative_amounts"),
        F.count(F.lit(1)).alias("batch_rows"),
    )
