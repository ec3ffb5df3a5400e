"""Joins over time: year spines, predecessors, validity intervals and cut-offs.

None of them pairs rows inside a group. Conditions such as "exists a later event" are first reduced
to one bound per key or turned into an ordered scan, so the work stays linear for hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from viewloom.operators.scans import Ordering, at_extreme, running
from viewloom.session import materialize


def year_spine(df: DataFrame, start: str, to_year: int, out: str) -> DataFrame:
    """One row per year from ``start`` to ``to_year``; rows that start later drop out."""
    years = F.sequence(F.col(start), F.lit(to_year).cast(df.schema[start].dataType))
    return df.filter(F.col(start) <= to_year).withColumn(out, F.explode(years)).drop(start)


def covered_by_event(
    df: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    event_order: str,
    event_value: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Rows for which an event of the same key has ``order <= event_order`` and ``value <= event_value``.

    Seen from the latest order backwards, the best event value so far decides: one running maximum
    over rows and events together replaces the inequality join.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    rows = df.select(*keys, F.col(order).alias("__o"), F.col(value).alias("__v"), F.lit(0).alias("__e"), row.alias("__row"))
    marks = events.select(
        *keys, F.col(event_order).alias("__o"), F.col(event_value).alias("__v"), F.lit(1).alias("__e"),
        F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"),
    )
    both = rows.unionByName(marks).withColumn("__m", F.when(F.col("__e") == 1, F.col("__v")))
    # the default frame shares results between ties, so an event also covers rows of its own order value
    scan = Ordering(tuple(keys), ("__o",), descending=True, chunk=chunk)
    seen = running(both, scan, {"__best": (F.max, "__m")}, rows=False)
    return seen.filter((F.col("__e") == 0) & (F.col("__v") <= F.col("__best"))).select("__row.*")


def latest_before(
    df: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    event_order: str,
    event_value: str,
    chunk: Column | None = None,
) -> DataFrame:
    """The last rows per key that precede an event; ties are kept."""
    before = covered_by_event(df, events, keys, order[0], value, event_order, event_value, chunk)
    # read twice, for the extreme and for the rows at it
    return at_extreme(materialize(before, "before"), keys, order)


def last_event(events: DataFrame, keys: Sequence[str], order: str, out: str = "__until") -> DataFrame:
    return events.groupBy(*keys).agg(F.max(order).alias(out))


def until_event(df: DataFrame, events: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """EXISTS an event of the key at or after the row: compare with the last event."""
    bounded = df.join(last_event(events, keys, order), list(keys), "inner")
    return bounded.filter(F.col(order) <= F.col("__until")).select(*df.columns)


def without_event(df: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NOT EXISTS an event of the key."""
    return df.join(events.select(*keys).distinct(), list(keys), "left_anti")


def cut_after_event(df: DataFrame, events: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keys without event keep all rows, keys with one keep those up to it: both cases in one join."""
    bounded = df.join(last_event(events, keys, order), list(keys), "left")
    until = F.col("__until")
    return bounded.filter(until.isNull() | (F.col(order) <= until)).select(*df.columns)


def yearly(history: DataFrame, valid_from: str, valid_to: str, first: Column, last: Column, out: str) -> DataFrame:
    """Half-open validity intervals as one row per year inside ``first..last``."""
    low = F.greatest(F.col(valid_from), first)
    high = F.least(F.col(valid_to) - 1, last)
    rows = history.filter(low <= high)
    return rows.withColumn(out, F.explode(F.sequence(low, high))).drop(valid_from, valid_to)


def valid_at(
    df: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    year: str,
    valid_from: str,
    valid_to: str,
    columns: Sequence[str],
) -> DataFrame:
    """Left join to the history rows with ``valid_from <= year < valid_to``.

    The intervals become years, so the join is an equality on key and year: a frequent key (blank
    identifiers, say) spreads over the years instead of filtering all its pairs. Open ends are cut at the first
    and last year that occur in ``df``.
    """
    first, last = (df.agg(pick(F.col(year).cast("int"))).scalar() for pick in (F.min, F.max))
    # without a year in df nothing matches: an interval of no years
    steps = yearly(
        history.select(*keys, valid_from, valid_to, *columns), valid_from, valid_to, F.coalesce(first, F.lit(1)), F.coalesce(last, F.lit(0)), out=year
    )
    return df.join(steps, [*keys, year], "left").select(*df.columns, *columns)
