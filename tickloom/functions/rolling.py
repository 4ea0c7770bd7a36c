"""Window expressions over bars: frames count rows, never time; a value is NULL until its frame is full."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

KEY, TS = "symbol", "ts"


def ordered(key: str = KEY, ts: str = TS) -> WindowSpec:
    return Window.partitionBy(key).orderBy(ts)


def last_rows(n: int, key: str = KEY, ts: str = TS) -> WindowSpec:
    """The current row and the n - 1 before it."""
    return ordered(key, ts).rowsBetween(-(n - 1), 0)


def so_far(key: str = KEY, ts: str = TS) -> WindowSpec:
    return ordered(key, ts).rowsBetween(Window.unboundedPreceding, 0)


def full(value: Column, of: Column | str, n: int, key: str = KEY, ts: str = TS) -> Column:
    """A rolling value, NULL unless all n rows of the frame have `of`."""
    return F.when(F.count(of).over(last_rows(n, key, ts)) >= n, value)


def mean(c: Column | str, n: int, key: str = KEY, ts: str = TS) -> Column:
    return full(F.avg(c).over(last_rows(n, key, ts)), c, n, key, ts)


def std(c: Column | str, n: int, key: str = KEY, ts: str = TS) -> Column:
    """Sample standard deviation."""
    return full(F.stddev_samp(c).over(last_rows(n, key, ts)), c, n, key, ts)


def highest(c: Column | str, n: int, key: str = KEY, ts: str = TS) -> Column:
    return full(F.max(c).over(last_rows(n, key, ts)), c, n, key, ts)


def lowest(c: Column | str, n: int, key: str = KEY, ts: str = TS) -> Column:
    return full(F.min(c).over(last_rows(n, key, ts)), c, n, key, ts)


def total(c: Column | str, n: int, key: str = KEY, ts: str = TS) -> Column:
    return full(F.sum(c).over(last_rows(n, key, ts)), c, n, key, ts)


def prev(c: Column | str, n: int = 1, key: str = KEY, ts: str = TS) -> Column:
    return F.lag(c, n).over(ordered(key, ts))


def ahead(c: Column | str, n: int = 1, key: str = KEY, ts: str = TS) -> Column:
    return F.lead(c, n).over(ordered(key, ts))


def crosses_above(a: str, b: str) -> Column:
    """a is over b now and was not on the row before."""
    return (F.col(a) > F.col(b)) & (prev(a) <= prev(b))


def crosses_below(a: str, b: str) -> Column:
    return (F.col(a) < F.col(b)) & (prev(a) >= prev(b))


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a, b)
