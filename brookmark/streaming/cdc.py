"""Change-log messages to versioned rows, and versioned rows to the current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.functions.decode import decode_columns
from brookmark.operators.merge import latest_by_key
from brookmark.specs import TableSpec

VERSION = "ver"
DELETED = "is_deleted"


def parse_cdc(df: DataFrame, spec: TableSpec, nulls: str = "default") -> DataFrame:
    """Typed rows with ``ver`` and ``is_deleted`` from raw messages in ``value``; works on streams.

    One typed parse of the envelope: deletes take the ``before`` image, everything else ``after``.
    Empty, unparsable and image-less messages are dropped. Money is read as an exact decimal.
    Other input columns (``seq``) are kept.

    Image-less messages fall out as empty arrays in ``explode``. A filter on the image would be
    moved below the projection and parse every message again for each field it looks at.
    """
    rest = [c for c in df.columns if c != "value"]
    parsed = df.select(*rest, F.from_json("value", spec.envelope_schema.simpleString()).alias("_msg"))
    deleted = F.coalesce(F.col("_msg.op") == "d", F.lit(False))
    image = F.when(deleted, F.col("_msg.before")).otherwise(F.col("_msg.after"))
    rows = parsed.select(
        *rest,
        F.coalesce("_msg.ts_ms", F.lit(0)).cast("long").alias(VERSION),
        deleted.alias(DELETED),
        F.explode(F.when(image.isNotNull(), F.array(image))).alias("_row"),
    )
    return rows.select(*decode_columns("_row", spec, nulls), VERSION, DELETED, *rest)


def tie_order(columns: list[str], spec: TableSpec) -> list[str]:
    """Columns that rank versions, highest first: version, arrival, deletes, then content."""
    arrival = [c for c in ("batch_id", "seq") if c in columns]
    rest = [c for c in spec.column_names if c != spec.primary_key]
    return [VERSION, *arrival, DELETED, *rest]


def collapse(versions: DataFrame, spec: TableSpec) -> DataFrame:
    """Newest version of every key, tombstones included."""
    first, *ties = tie_order(versions.columns, spec)
    return latest_by_key(versions, spec.primary_key, first, ties)


def current(versions: DataFrame, spec: TableSpec) -> DataFrame:
    """Live rows only; tombstones are removed after the collapse, never before."""
    live = collapse(versions, spec).where(~F.col(DELETED))
    return live.drop(VERSION, DELETED, "batch_id", "seq")


def tombstones(versions: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys whose newest version is a delete."""
    return collapse(versions, spec).where(F.col(DELETED)).select(spec.primary_key, VERSION)


def merge_latest(batch: DataFrame, target: DataFrame, spec: TableSpec) -> DataFrame:
    """State after a batch: old versions lose, deletes stay as tombstones, replays change nothing."""
    return collapse(target.unionByName(batch), spec)
