"""Aggregate expressions shared by the reports.

Rounding goes through ``decimal(28,10)``: a mean that sits on a rounding tie
then comes out the same whatever order the rows were summed in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column, digits: int) -> Column:
    return F.round(c.cast("decimal(28,10)"), digits).cast("double")


def mean(c: str | Column, digits: int | None = 2) -> Column:
    out = F.avg(c)
    return out if digits is None else rounded(out, digits)


def sample_stddev(c: str | Column, digits: int = 2) -> Column:
    return rounded(F.stddev_samp(c), digits)


def pct(part: Column, whole: Column, digits: int | None = 2) -> Column:
    share = F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
    return share if digits is None else rounded(share, digits)


def rows_where(cond: Column) -> Column:
    return F.count_if(cond)


def pct_where(cond: Column, digits: int | None = 2) -> Column:
    """Percentage of the group's rows that satisfy ``cond``."""
    return pct(F.count_if(cond), F.count(F.lit(1)), digits)


def any_true(c: str | Column) -> Column:
    return F.bool_or(c)
