"""Latest version per key and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame, key: str | Sequence[str], version: str | None, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest (version, *tiebreak) of every key; without a version, the tie-break decides.

    Written as ``row_number() == 1``: Spark turns that into a group limit that runs before the
    shuffle, so each task sends at most one row per key and a hot key cannot pile up anywhere.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).desc_nulls_last() for c in (*([version] if version else []), *tiebreak)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    update_columns: Sequence[str],
    version: str | None = None,
) -> DataFrame:
    """New state of ``target`` after a keyed upsert; both sides hold each key at most once.

    Matched rows take ``update_columns`` from the update and keep the rest; unmatched updates are
    inserted whole; nothing is ever removed. With ``version`` set, an update older than the stored
    row is ignored, so replaying an old batch cannot undo a newer one.
    """
    both = target.alias("t").join(
        updates.alias("u"), F.col(f"t.{key}") == F.col(f"u.{key}"), "full_outer"
    )
    new = F.col(f"t.{key}").isNull()
    wins = F.col(f"u.{key}").isNotNull()
    if version:
        # a stored row without a version never blocks, an update without one never wins
        wins = wins & (
            F.col(f"t.{version}").isNull()
            | F.coalesce(F.col(f"u.{version}") >= F.col(f"t.{version}"), F.lit(False))
        )
    changed = set(update_columns)
    columns = []
    for name in target.columns:
        take_update = (new | wins) if name in changed else new
        columns.append(
            F.when(take_update, F.col(f"u.{name}")).otherwise(F.col(f"t.{name}")).alias(name)
        )
    return both.select(*columns)


def prepare_batch(
    batch: DataFrame, key: str, version: str | None, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per key before a merge: a landed day may hold several versions of a key."""
    return latest_by_key(batch, key, version, tiebreak)


def unique_violations(df: DataFrame, column: str, key: str) -> DataFrame:
    """Values of a unique column that belong to more than one key, with the number of keys."""
    pairs = df.where(F.col(column).isNotNull()).select(column, key).distinct()
    return pairs.groupBy(column).agg(F.count(F.lit(1)).alias("keys")).where(F.col("keys") > 1)


def batch_conflicts(stored: DataFrame, batch: DataFrame, column: str, key: str) -> DataFrame:
    """Violations a batch would cause if merged, found before anything is written.

    Only stored rows sharing a value with the batch are looked at, less those whose key the batch
    itself replaces.
    """
    arriving = batch.select(column, key).where(F.col(column).isNotNull())
    kept = (
        stored.select(column, key)
        .join(arriving.select(column), column, "left_semi")
        .join(batch.select(key), key, "left_anti")
    )
    return unique_violations(kept.unionByName(arriving), column, key)


class UniqueViolation(ValueError):
    """A merge would give one value of a unique column to two keys."""


def assert_no_conflicts(stored: DataFrame | None, batch: DataFrame, column: str, key: str) -> None:
    if stored is None:
        found = unique_violations(batch, column, key)
    else:
        found = batch_conflicts(stored, batch, column, key)
    if not found.isEmpty():
        raise UniqueViolation(f"{column} would belong to more than one {key}")
