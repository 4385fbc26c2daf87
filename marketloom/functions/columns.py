"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names in report order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour periods between two timestamps."""
    return F.timestamp_diff("DAY", as_column(start), as_column(end)).cast("int")


def calendar_days(start: Column | str, end: Column | str) -> Column:
    """Midnights between two timestamps."""
    return F.date_diff(as_column(end), as_column(start))


def year_month(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM")


def year_month_label(year: Column | str, month: Column | str) -> Column:
    return F.format_string("%d-%02d", as_column(year), as_column(month))


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(as_column(year), as_column(month), F.lit(1))


def first_word(text: Column | str) -> Column:
    """First word as a product category, 'Unknown' for missing or blank text."""
    word = F.split(F.trim(as_column(text)), r"\s+").getItem(0)
    return F.coalesce(F.when(word != "", word), F.lit("Unknown"))


def pair_label(left: Column | str, right: Column | str, width: int = 30) -> Column:
    return F.concat(
        F.substring(as_column(left), 1, width), F.lit(" + "), F.substring(as_column(right), 1, width)
    )


def percent_text(share: Column | str) -> Column:
    """0.1234 as '12.34%'."""
    return F.format_string("%.2f%%", as_column(share) * 100)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Quotient in double, NULL when the divisor is zero."""
    return F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))


def percent_change(old: Column | str, new: Column | str) -> Column:
    old, new = as_column(old).cast("double"), as_column(new).cast("double")
    return F.try_divide(new - old, old) * 100


def finite_or_zero(value: Column | str) -> Column:
    """NULL, NaN and both infinities as 0."""
    value = as_column(value).cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def money_mean(amount: Column | str, rows: Column | None = None) -> Column:
    """Mean of a money column as the exact sum over the count of its values."""
    amount = as_column(amount)
    count = F.count(amount) if rows is None else rows
    return ratio(F.sum(amount), count)


def at_least(value: Column | str, floors: Sequence[float], labels: Sequence, default) -> Column:
    """First label whose floor the value reaches; floors go from high to low."""
    value = as_column(value)
    out = None
    for floor, label in zip(floors, labels, strict=True):
        hit = value >= F.lit(floor)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def at_most(value: Column | str, ceilings: Sequence[float], labels: Sequence, default) -> Column:
    """First label whose ceiling the value stays under or meets; ceilings go from low to high."""
    value = as_column(value)
    out = None
    for ceiling, label in zip(ceilings, labels, strict=True):
        hit = value <= F.lit(ceiling)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def position_in(value: Column | str, ordered: Sequence[str]) -> Column:
    """1-based place of a label in a list, one past the end for any other label."""
    out = None
    for i, label in enumerate(ordered, start=1):
        hit = as_column(value) == F.lit(label)
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return out.otherwise(F.lit(len(ordered) + 1))
