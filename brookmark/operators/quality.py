"""Declarative data-quality checks with a tri-state report.

A check that cannot run, because its table is absent or empty, is SKIP and never PASS: checks that
look for the absence of bad rows hold trivially on an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmark.operators.reconcile import select_keys
from brookmark.operators.unions import union_all


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str  # not_null, unique, accepted_values, range, relationships, populated
    values: tuple = ()
    minimum: float | None = None
    maximum: float | None = None
    parent: str | None = None
    parent_column: str | None = None


def _bad_row(check: Check) -> Column:
    """Condition of a failing row for the checks that look at one row at a time."""
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return column.isNotNull() & ~column.isin(list(check.values))
    low = column < check.minimum if check.minimum is not None else F.lit(False)
    high = column > check.maximum if check.maximum is not None else F.lit(False)
    return F.coalesce(low | high, F.lit(False))


_ROW_KINDS = ("not_null", "accepted_values", "range")


def _plain(value: Column, kind: T.DataType) -> Column:
    """A value as text that is equal for equal values only."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")  # local time repeats an hour a year
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")  # one zero
    return value.cast("string")


def _line(number: int, value: Column | None = None, parent: bool = False, when: Column | None = None) -> Column:
    made = F.struct(
        F.lit(number).alias("line"), (F.lit(None).cast("string") if value is None else value).alias("value"),
        F.lit(parent).alias("parent"),
    )
    return made if when is None else F.when(when, made)


def _lines(df: DataFrame, table: int, own: dict[int, Check], asked: dict[int, tuple[Check, T.DataType]]) -> DataFrame:
    """What a table's rows say to all checks, from one pass over it.

    Every row gives one line under the table's number, one per value to be unique or to have a parent, one per row
    check it fails, and one per reference from elsewhere (``asked``) that it may be the parent of.
    """
    lines = [_line(table)]
    for number, check in own.items():
        column = F.col(check.column)
        if check.kind in _ROW_KINDS:
            lines.append(_line(number, when=_bad_row(check)))
        else:
            lines.append(_line(number, _plain(column, df.schema[check.column].dataType), when=column.isNotNull()))
    for number, (check, kind) in asked.items():
        known = F.col(check.parent_column).cast(kind)
        lines.append(_line(number, _plain(known, kind), parent=True, when=known.isNotNull()))
    return df.select(F.explode(F.array(*lines)).alias("line")).where(F.col("line").isNotNull()).select("line.*")


def _populated(df: DataFrame, number: int) -> DataFrame:
    """One line for the check if there is any row; reads no more than that."""
    return df.limit(1).select(F.lit(number).alias("line"), F.lit(None).cast("string").alias("value"), F.lit(False).alias("parent"))


def run_checks(spark: SparkSession, frames: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check: ``(table_name, column_name, check_name, failures, status)``.

    Each table is read once for all its checks, as a child and as a parent. Lines of all tables meet in one aggregation
    per check and value, summed before the shuffle, so a hot value is one line of each task; a second one
    per check gives the counts.
    """
    tables = list(dict.fromkeys(c.table for c in checks))
    parents = [c.parent for c in checks if c.kind == "relationships"]
    named = {n: frames.get(n) for n in dict.fromkeys([*tables, *parents])}
    numbered = dict(enumerate(checks))
    # a reference whose parent is absent cannot be checked
    runs = {i: c for i, c in numbered.items() if named[c.table] is not None and (c.parent is None or named[c.parent] is not None)}
    parts = []
    for place, (name, df) in enumerate(named.items()):
        own = {i: c for i, c in runs.items() if c.table == name and c.kind != "populated"}
        asked = {i: (c, named[c.table].schema[c.column].dataType) for i, c in runs.items() if c.parent == name}
        if df is not None and (own or asked):
            parts.append(_lines(df, -1 - place, own, asked))
        parts += [_populated(df, i) for i, c in runs.items() if c.table == name and c.kind == "populated"]
    number = {name: -1 - place for place, name in enumerate(named)}

    listed = spark.range(1).select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("check"), F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"),
            F.lit(c.kind).alias("check_name"), F.lit(number[c.table]).alias("table"), F.lit(i in runs).alias("runs"),
        )
        for i, c in numbered.items()
    ])))
    none = F.lit(0).cast("long")
    if parts:
        child = F.count_if(~F.col("parent"))
        met = union_all(parts).groupBy("line", "value").agg(child.alias("n"), F.max("parent").alias("known"))
        counts = met.groupBy("line").agg(
            F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"),
            F.sum(F.when(~F.col("known"), F.col("n"))).alias("alone"),
        )
        seen = counts.select(F.col("line").alias("table"), F.col("rows").alias("seen"))
        found = listed.join(counts, listed.check == counts.line, "left").join(seen, "table", "left")
    else:
        found = listed.select("*", none.alias("rows"), none.alias("repeated"), none.alias("alone"), none.alias("seen"))
    kind = F.col("check_name")
    empty = F.coalesce("rows", none) == 0
    failures = (
        F.when(kind == "populated", empty.cast("long")).when(kind == "unique", F.col("repeated"))
        .when(kind == "relationships", F.col("alone")).otherwise(F.col("rows"))
    )
    # emptiness is what a populated check finds, so that one always counts as run
    ran = (kind == "populated") | (F.col("runs") & (F.coalesce("seen", none) > 0))
    failed = F.when(ran, F.coalesce(failures, none)).otherwise(none)
    status = F.when(~ran, "SKIP").when(failed == 0, "PASS").otherwise("FAIL")
    return found.select("table_name", "column_name", "check_name", failed.alias("failures"), status.alias("status"))


def failing_rows(frames: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """The rows (or repeated values) behind a failed check."""
    df = frames[check.table]
    if check.kind == "unique":
        counted = df.where(F.col(check.column).isNotNull()).groupBy(check.column)
        return counted.agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    if check.kind == "relationships":
        return orphans(df, check.column, frames[check.parent], check.parent_column)
    return df.where(_bad_row(check))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null reference has no parent row."""
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return child.where(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("_parent"), "left_anti"
    )


def verdict(report: DataFrame) -> DataFrame:
    """One row: counts per status; verified only when nothing failed and nothing was skipped."""
    status = F.col("status")
    return report.agg(
        F.count_if(status == "PASS").alias("passed"),
        F.count_if(status == "FAIL").alias("failed"),
        F.count_if(status == "SKIP").alias("skipped"),
    ).withColumn("verified", (F.col("failed") == 0) & (F.col("skipped") == 0))


def replica_checks(source: DataFrame, replica: DataFrame, key: str, deleted: DataFrame,
                   expected_status: DataFrame, scope: Column | None = None) -> DataFrame:
    """Replica equality after a batch of changes, as report rows.

    ``deleted`` holds keys that must be gone, ``expected_status`` keys with the status they must
    show. On an empty replica both are SKIP. ``scope`` limits both sides, for a replica that still
    holds rows of an earlier source (such as ``order_id <= n``).
    """
    if scope is not None:
        source, replica = source.where(scope), replica.where(scope)
    rows = replica.agg(F.count(F.lit(1)).alias("n"))
    counted = source.agg(F.count(F.lit(1)).alias("n"))
    still_there = select_keys(replica, key, deleted).agg(F.count(F.lit(1)).alias("n"))
    applied = replica.join(expected_status.select(key, "status"), [key, "status"], "left_semi").agg(
        F.count(F.lit(1)).alias("n")
    )
    expected = expected_status.agg(F.count(F.lit(1)).alias("n"))

    def tagged(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("what"), "n")

    facts = union_all(
        [
            tagged(rows, "replica"), tagged(counted, "source"), tagged(still_there, "left"),
            tagged(applied, "applied"), tagged(expected, "expected"),
        ]
    ).groupBy().pivot("what", ["replica", "source", "left", "applied", "expected"]).sum("n")
    empty = F.col("replica") == 0
    lines = F.array(
        F.struct(F.lit("row_count").alias("check_name"),
                 F.abs(F.col("source") - F.col("replica")).alias("failures"), F.lit(False).alias("skip")),
        F.struct(F.lit("not_empty").alias("check_name"),
                 empty.cast("long").alias("failures"), F.lit(False).alias("skip")),
        F.struct(F.lit("deletes_applied").alias("check_name"),
                 F.col("left").alias("failures"), empty.alias("skip")),
        F.struct(F.lit("statuses_applied").alias("check_name"),
                 (F.col("expected") - F.col("applied")).alias("failures"), empty.alias("skip")),
    )
    status = F.when(F.col("skip"), "SKIP").when(F.col("failures") == 0, "PASS").otherwise("FAIL")
    return facts.select(F.inline(lines)).select("check_name", "failures", status.alias("status"))
