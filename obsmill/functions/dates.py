"""Date spines and cadence tags."""

from pyspark.sql import Column, functions as F

from obsmill.functions.text import truthy
from obsmill.schemas import DEFAULT_GRANULARITY


def granularity_of(frequency: Column) -> Column:
    return (
        F.when(frequency == "yearly", F.lit("year"))
        .when(frequency == "monthly", F.lit("month"))
        .otherwise(F.lit(DEFAULT_GRANULARITY))
    )


def granularity_tag(granularity: Column, frequency: Column) -> Column:
    """The plan's own tag if it has one, else the tag of the cadence."""
    return truthy(granularity, granularity_of(frequency))


def _bounds(start: Column, end: Column) -> tuple[Column, Column]:
    first, last = start.cast("date"), end.cast("date")
    return F.least(first, last), F.greatest(first, last)


def date_spine(start: Column, end: Column, frequency: Column) -> Column:
    """Array of ISO dates for a cadence; reversed bounds are swapped.

    Yearly gives each year's last day even past the end, monthly each month's first day even
    before the start, everything else every day of the inclusive range.
    """
    low, high = _bounds(start, end)
    years = F.transform(
        F.sequence(F.year(low), F.year(high)), lambda y: F.concat(y.cast("string"), F.lit("-12-31"))
    )
    months = F.transform(
        F.sequence(F.trunc(low, "MM").cast("date"), high, F.expr("INTERVAL 1 MONTH")),
        lambda d: d.cast("string"),
    )
    days = F.transform(F.sequence(low, high, F.expr("INTERVAL 1 DAY")), lambda d: d.cast("string"))
    return F.when(frequency == "yearly", years).when(frequency == "monthly", months).otherwise(days)


def cadence(frequency: Column) -> Column:
    """The unit of a spine's steps: year, month or day."""
    return F.when(frequency == "yearly", "year").when(frequency == "monthly", "month").otherwise("day")


def spine_steps(start: Column, end: Column, frequency: Column) -> tuple[Column, Column]:
    """First and last step of `date_spine`: years, months since year 0 or days since 1970."""
    low, high = _bounds(start, end)

    def step(day: Column) -> Column:
        yearly = F.year(day)
        monthly = F.year(day) * 12 + F.month(day) - 1
        return F.when(frequency == "yearly", yearly).when(frequency == "monthly", monthly).otherwise(F.unix_date(day))

    return step(low), step(high)


def step_date(unit: Column, step: Column) -> Column:
    """The day that a step of `cadence` stands for."""
    whole = step.cast("int")
    return (
        F.when(unit == "year", F.make_date(whole, F.lit(12), F.lit(31)))
        .when(unit == "month", F.make_date(F.floor(whole / 12).cast("int"), F.pmod(whole, F.lit(12)) + 1, F.lit(1)))
        .otherwise(F.date_from_unix_date(whole))
    )


def step_text(unit: Column, step: Column) -> Column:
    """The same day as `date_spine` writes it."""
    return step_date(unit, step).cast("string")


def spine_size(start: Column, end: Column, frequency: Column) -> Column:
    """Length of `date_spine` without building it."""
    low, high = _bounds(start, end)
    years = F.year(high) - F.year(low)
    return (
        F.when(frequency == "yearly", years + 1)
        .when(frequency == "monthly", years * 12 + F.month(high) - F.month(low) + 1)
        .otherwise(F.datediff(high, low) + 1)
    ).cast("bigint")


def days_inclusive(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date")) + 1
