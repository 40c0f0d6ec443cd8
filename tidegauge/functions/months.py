"""Months as integers YYYYMM: arithmetic without dates, so that gaps and year ends need no care."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def index(month: Column) -> Column:
    """Months since year zero."""
    return F.floor(month / 100) * 12 + month % 100 - 1


def from_index(i: Column) -> Column:
    return (F.floor(i / 12) * 100 + i % 12 + 1).cast("long")


def shift(month: Column, k: Column | int) -> Column:
    return from_index(index(month) + k)


def distance(a: Column, b: Column) -> Column:
    """Months from a to b."""
    return (index(b) - index(a)).cast("long")


def between(first: Column, last: Column) -> Column:
    """Array of the months from first to last."""
    return F.transform(F.sequence(index(first), index(last)), from_index)


def month_end(month: Column) -> Column:
    return F.last_day(F.make_date(F.floor(month / 100).cast("int"), (month % 100).cast("int"), F.lit(1)))


def valid(month: Column) -> Column:
    """The month itself; an error if its last two digits are no month."""
    return F.when((month % 100).between(1, 12), month).otherwise(F.raise_error(F.concat(F.lit("not a month: "), month.cast("string"))))


def status(lag: Column, settled_after: int = 12) -> Column:
    """A month younger than ``settled_after`` months is provisional."""
    return F.when(lag < settled_after, "provisional").otherwise("consolidated")


def of_list(text: Column) -> Column:
    """Months of a list such as ``202001..202003, 202007``: ranges run through, repeats dropped, order kept; anything else is an error."""
    one = lambda t: valid(F.try_to_number(t, F.lit("999999")).cast("long"))

    def run(part: Column) -> Column:
        ends = F.split(F.trim(part), r"\.\.")
        well = F.trim(part).rlike(r"^[0-9]{6}(\.\.[0-9]{6})?$")
        months = between(one(ends[0]), one(F.element_at(ends, -1)))
        ordered = F.when(index(one(ends[0])) <= index(one(F.element_at(ends, -1))), months)
        bad = F.raise_error(F.concat(F.lit("not a list of months: "), part)).cast("array<bigint>")
        return F.coalesce(F.when(well, ordered), bad)

    return F.array_distinct(F.flatten(F.transform(F.split(text, ","), run)))


def last(month: Column, n: Column | int) -> Column:
    """The ``n`` months up to and with ``month``."""
    return between(shift(month, 1 - n), month)


def of_years(first: Column, to: Column, target: Column, of: list[int] | None = None) -> Column:
    """Months of the years ``first`` to ``to`` that aren't after ``target``; only the calendar months ``of``, if given."""
    every = between((first * 100 + 1).cast("long"), (to * 100 + 12).cast("long"))
    return F.filter(every, lambda m: (m <= target) & ((m % 100).isin(*of) if of else F.lit(True)))


def available(wanted: Column, known: Column) -> Column:
    """The wanted months; an error if one isn't among those known."""
    gap = F.array_except(wanted, known)
    return F.when(F.size(gap) == 0, wanted).otherwise(F.raise_error(F.concat(F.lit("months not available: "), F.array_join(gap.cast("array<string>"), ", "))).cast("array<bigint>"))
