"""Column-expression library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: it is bound to a lambda's variable instead of being repeated."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
