"""Running sums and ordinals over a whole table without one task that sees it all.

Keys of any type, range and density are put in order by range partitions; what each partition adds up to says where the
next one starts, and windows run within partitions only. The one window over the whole has a row per partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import kept


def ascending(keys: list[str]) -> list[Column]:
    """The order of keys: ascending, nulls last."""
    return [F.col(f"`{k}`").asc_nulls_last() for k in keys]


def in_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``__part``, the number of its range partition in order of the keys; kept, so that numbers stay."""
    return kept(df.repartitionByRange(*ascending(keys)).withColumn("__part", F.spark_partition_id()), "ranges")


def starts(parts: DataFrame, total: Column) -> DataFrame:
    """(__part, __start): for each partition, ``total`` of those before it; one row per partition."""
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("__part").agg(total.alias("__sum"))
    return F.broadcast(sums.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).cast("long").alias("__start")))


def running_total(df: DataFrame, value: Column, by: str | list[str], name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows up to this one in order of the columns ``by``, nulls last.

    Rows of equal keys are peers: each has the total with all of them, as in SQL's default frame, so that the result
    doesn't depend on an order among them; a key that is unique gives a total row by row. Null values count as zero.
    A key's values are summed before anything is put in order, so that no key is too frequent for a task.
    """
    keys = [by] if isinstance(by, str) else list(by)
    rows = df.withColumn("__value", F.coalesce(value, F.lit(0)).cast("long"))
    parts = in_ranges(rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.sum("__value").alias("__sum")), keys)
    within = Window.partitionBy("__part").orderBy(*ascending(keys)).rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.join(starts(parts, F.sum("__sum")), "__part")
    totals = placed.select(*[F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(keys)], (F.col("__start") + F.sum("__sum").over(within)).alias("__total"))
    same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)])
    return rows.join(totals, same).select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.col("__total").alias(name))


def numbered(df: DataFrame, by: list[str], name: str, within: list[str] = ()) -> DataFrame:
    """Adds a number from 0 in order of the columns ``by``, nulls last; ``within`` these columns it starts anew.

    No group is gathered: a group's numbers are those of the whole table less its first. The columns should tell all
    rows apart; rows that they don't tell apart are numbered in any order.
    """
    keys = [*within, *by]
    parts = in_ranges(df, keys)
    own = Window.partitionBy("__part").orderBy(*ascending(keys))
    rows = parts.join(starts(parts, F.count("*")), "__part").withColumn("__number", F.col("__start") + F.row_number().over(own) - 1)
    if not within:
        return rows.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.col("__number").alias(name))
    firsts = rows.groupBy(*[F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(within)]).agg(F.min("__number").alias("__first"))
    same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(within)])
    return rows.join(firsts, same).select(*[F.col(f"`{c}`") for c in df.columns if c != name], (F.col("__number") - F.col("__first")).alias(name))
