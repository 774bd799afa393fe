"""Running and ranked windows: islands, last known values, deduplication, recent history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def island_ids(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], bridge: Column, name: str = "island") -> DataFrame:
    """Numbers the chains of each key: a row joins the one before it if that one's ``bridge`` is true."""
    w = Window.partitionBy(*by).orderBy(*order)
    joined = F.lag(F.coalesce(bridge, F.lit(False)), 1, False).over(w)
    return df.withColumn("_break", (~joined).cast("long")).withColumn(name, F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_break")


def last_known(column: Column | str, by: Sequence[str], order: Sequence[Column | str]) -> Column:
    """The column's latest value that isn't null, this row's included."""
    return F.last(column, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def last_in_group(column: Column | str, by: Sequence[str], order: Sequence[Column | str]) -> Column:
    """The value of the group's last row, null or not."""
    return F.last(column, ignorenulls=False).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each key, the first in a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")


def null_count(columns: Sequence[str]) -> Column:
    """How many of the columns are null in a row."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def keep_fewest_nulls(df: DataFrame, by: Sequence[str], tie: Sequence[Column]) -> DataFrame:
    """Of the rows of each key, which mustn't be null, that with the fewest nulls."""
    for c in by:
        df = df.where(F.col(c).isNotNull())
    return keep_first(df, by, [null_count(df.columns).asc(), *tie])


def lag_deltas(df: DataFrame, columns: Sequence[str], by: Sequence[str], order: Sequence[Column | str], suffix: str = "_delta") -> DataFrame:
    """Adds each column's difference to the row before it, all in one window."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumns({f"{c}{suffix}": F.col(c) - F.lag(c).over(w) for c in columns})


def changed(column: str, by: Sequence[str], order: Sequence[Column | str]) -> Column:
    """Whether a value differs from the one before it; true for a key's first row, which has none before it."""
    before = F.lag(column).over(Window.partitionBy(*by).orderBy(*order))
    return F.when(F.col(column) == before, False).otherwise(True)


def recent(df: DataFrame, columns: Sequence[str], by: Sequence[str], order: Sequence[Column | str], n: int, name: str = "history", strict: str | None = None) -> DataFrame:
    """Adds an array of the n rows before this one, newest first, each with its recency rn from 1.

    A frame of n rows does it: no row is joined with all of its history. ``strict`` names the first column of the order, of which
    only lower values count as before: rows that are equal in it all get the history of the first of them.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-n, -1)
    listed = F.reverse(F.collect_list(F.struct(*columns)).over(w))
    ranked = F.transform(listed, lambda x, i: F.struct((i + 1).cast("int").alias("rn"), *(x[c].alias(c) for c in columns)))
    df = df.withColumn(name, ranked)
    if strict:
        df = df.withColumn(name, F.first(name).over(Window.partitionBy(*by, strict).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return df


def _values(history: Column, column: str, n: int) -> Column:
    kept = F.filter(history, lambda x: (x["rn"] <= n) & x[column].isNotNull())
    return F.transform(kept, lambda x: x[column].cast("double"))


def recent_mean(history: Column, column: str, n: int) -> Column:
    v = _values(history, column, n)
    return F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v))


def recent_stddev(history: Column, column: str, n: int) -> Column:
    """Population standard deviation."""
    v = _values(history, column, n)
    mean = F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v)
    return F.when(F.size(v) > 0, F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean)) / F.size(v)))


def recent_slope(history: Column, column: str, n: int) -> Column:
    """Least-squares slope of a value against its recency: a rising trend has a negative one. Null for fewer than two values."""
    kept = F.filter(history, lambda x: (x["rn"] <= n) & x[column].isNotNull())
    size = F.size(kept).cast("double")

    def total(of) -> Column:
        return F.aggregate(kept, F.lit(0.0), lambda s, x: s + of(x))

    sx, sy = total(lambda x: x["rn"].cast("double")), total(lambda x: x[column].cast("double"))
    sxy = total(lambda x: x["rn"] * x[column].cast("double"))
    sxx = total(lambda x: (x["rn"] * x["rn"]).cast("double"))
    return F.when(F.size(kept) > 1, (size * sxy - sx * sy) / (size * sxx - sx * sx))
