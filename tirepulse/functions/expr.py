"""Small column-expression helpers.

All of them compose built-in ``pyspark.sql.functions`` so they stay inside
whole-stage codegen. They encode the NULL/NaN conventions the reports rely
on (see SURVEY §1.2):

* a division by zero yields NULL, never an error (ANSI mode) or infinity;
* a boolean mask that is NULL counts as false.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)``: NULL when the denominator is 0 or NULL."""
    return col(num) / F.nullif(col(den), F.lit(0))


def fill0(c: str | Column) -> Column:
    """``COALESCE(c, 0)``."""
    return F.coalesce(col(c), F.lit(0))


def truthy(cond: Column) -> Column:
    """A mask that treats NULL as false."""
    return F.coalesce(cond, F.lit(False))


def any_positive(cols: Iterable[str | Column]) -> Column:
    """``c1 > 0 OR c2 > 0 OR ...`` with SQL three-valued logic."""
    return reduce(or_, [col(c) > 0 for c in cols])


def not_nan(c: str | Column) -> Column:
    """The value, NULL if it is NaN."""
    return F.when(~F.isnan(col(c)), col(c))
