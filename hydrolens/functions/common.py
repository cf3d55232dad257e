"""Small expression builders: SQL text, exact averages, time parts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- SQL text ---------------------------------------------------------------
# Long expressions are put together as SQL text and parsed once. Building them Column by
# Column costs a round trip to the JVM for every operator.
def num(value: float) -> str:
    """A double literal. Without the suffix it would be a decimal."""
    return f"{float(value)!r}D"


def text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def any_of(*conditions: str) -> str:
    return " or ".join(f"({condition})" for condition in conditions)


def flag(condition: str) -> str:
    """1 when the condition holds, 0 when it is false or null."""
    return f"case when {condition} then 1 else 0 end"


def ladder(branches: Iterable[tuple[str, str]], default: str) -> str:
    """First branch whose condition holds wins; a null condition is skipped. The outcomes are
    plain text."""
    return case([(condition, text(outcome)) for condition, outcome in branches], text(default))


def case(branches: Iterable[tuple[str, str]], default: str) -> str:
    """Like `ladder`, with SQL expressions as outcomes."""
    steps = " ".join(f"when {condition} then {outcome}" for condition, outcome in branches)
    return f"case {steps} else {default} end"


def clamp(value: str, low: float = 0.0, high: float = 100.0) -> str:
    return f"least({num(high)}, greatest({num(low)}, {value}))"


def added(*names: str) -> list[Column]:
    """Sums under the names of their columns."""
    return [F.expr(f"sum({name}) as {name}") for name in names]


def counted(conditions: Mapping[str, str]) -> list[Column]:
    """How many rows meet each named condition."""
    return [F.expr(f"count_if({condition}) as {name}") for name, condition in conditions.items()]


# --- averages ---------------------------------------------------------------
# A sum of doubles depends on the order in which partitions arrive, so it can change when a
# lost task is run again. Here values are summed as whole units and billionths, both as
# integers: the sums are exact, stay in the hash aggregate's buffer, and can be added up to
# coarser groups. They become doubles once, for the division.
def exact_totals(column: str) -> list[Column]:
    """Aggregates <column>_whole, <column>_billionths and <column>_n."""
    rest = f"sum(floor(({column} - floor({column})) * 1e9D + 0.5D))"
    return [
        # Full units among the billionths are carried, so totals of totals stay far from the limit.
        F.expr(f"sum(floor({column})) + {rest} div 1000000000 as {column}_whole"),
        F.expr(f"{rest} % 1000000000 as {column}_billionths"),
        F.expr(f"count({column}) as {column}_n"),
    ]


def _average(whole: str, billionths: str, n: str) -> Column:
    carried = f"cast({whole} + ({billionths}) div 1000000000 as double)"
    total = f"{carried} + cast(({billionths}) % 1000000000 as double) / 1e9D"
    return F.expr(f"try_divide({total}, cast({n} as double))")


def average_of_totals(column: str) -> Column:
    """The average of one row of totals."""
    return _average(f"{column}_whole", f"{column}_billionths", f"{column}_n")


def combined_average(column: str) -> Column:
    """The average over a group of totals."""
    return _average(f"sum({column}_whole)", f"sum({column}_billionths)", f"sum({column}_n)")


def exact_avg(column: str) -> Column:
    # Any number of rows: a bigint would hold the billionths of about 1e10 of them.
    rest = f"cast(floor(({column} - floor({column})) * 1e9D + 0.5D) as decimal(10, 0))"
    return _average(f"sum(floor({column}))", f"sum({rest})", f"count({column})")


# --- time -------------------------------------------------------------------
def date_key(ts: str) -> str:
    """yyyymmdd as an integer."""
    return f"year({ts}) * 10000 + month({ts}) * 100 + day({ts})"


def time_key(ts: str) -> str:
    """hhmmss as an integer."""
    return f"hour({ts}) * 10000 + minute({ts}) * 100 + second({ts})"


def minutes_between(start: str, end: str) -> str:
    """Number of minute boundaries crossed from start to end."""
    return f"timestampdiff(minute, date_trunc('minute', {start}), date_trunc('minute', {end}))"


def week_of_year_sunday(day: str) -> str:
    """Week number with weeks starting on Sunday; week 1 holds 1 January."""
    return f"cast(ceil((dayofyear({day}) + dayofweek(trunc({day}, 'year')) - 1) / 7) as int)"


def moment(value: dt.datetime | str) -> str:
    """A fixed point in time, for `as_of` arguments."""
    return f"timestamp '{value}'"


def hours_before(as_of: dt.datetime | str, hours: int) -> str:
    return f"{moment(as_of)} - interval {int(hours)} hours"


def minutes_before(as_of: dt.datetime | str, minutes: int) -> str:
    return f"{moment(as_of)} - interval {int(minutes)} minutes"
