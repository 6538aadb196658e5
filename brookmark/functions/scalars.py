"""Column expressions whose exact semantics matter to the models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_text(left: Column, separator: str, right: Column) -> Column:
    """Concatenation that is NULL when either side is (concat_ws would skip the NULL)."""
    return F.concat(left, F.lit(separator), right)


def tidy(text: Column) -> Column:
    return F.trim(text)


def tidy_lower(text: Column) -> Column:
    return F.lower(F.trim(text))


def money(amount: Column, precision: int = 18, scale: int = 2) -> Column:
    return amount.cast(f"decimal({precision},{scale})")


def iso_weekday(day: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(day) + F.lit(1)


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_bucket(ts: Column) -> Column:
    """yyyyMM as an integer."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def days_between(first: Column, last: Column) -> Column:
    """Array of every day from first to last; NULL bounds give NULL, so explode gives no rows."""
    return F.sequence(first, last, F.expr("interval 1 day"))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with microsecond precision."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000)


def day_path(day: Column) -> Column:
    """yyyy/MM/dd folder text."""
    return F.date_format(day, "yyyy/MM/dd")


def day_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from text parts; anything that is not a calendar day is NULL."""
    padded = F.concat(
        F.lpad(year, 4, "0"), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0")
    )
    numeric = year.rlike("^[0-9]{1,4}$") & month.rlike("^[0-9]{1,2}$") & day.rlike("^[0-9]{1,2}$")
    return F.when(numeric, padded.try_cast("date"))


def epoch_micros_to_timestamp(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def epoch_days_to_date(days: Column) -> Column:
    return F.date_from_unix_date(days)


def render(value: Column) -> Column:
    """Text form for display: NULL shows as an empty string."""
    return F.coalesce(value.cast("string"), F.lit(""))


def readable_size(size: Column) -> Column:
    """Bytes as text in binary units, two decimals."""
    text = F.concat(F.format_number(size, 2), F.lit(" B"))
    for power, unit in ((1, "KiB"), (2, "MiB"), (3, "GiB"), (4, "TiB"), (5, "PiB")):
        step = F.lit(float(1024**power))
        text = F.when(size >= step, F.concat(F.format_number(size / step, 2), F.lit(f" {unit}"))).otherwise(text)
    return text
