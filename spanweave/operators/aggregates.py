"""Grouped reports: pivots, stacked metrics, top N with a rest, null-aware folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_metrics(df: DataFrame, by: Sequence[str], kind: str, kinds: Sequence[str], metrics: Sequence[str], fold: Callable[[Column], Column] = F.max) -> DataFrame:
    """A column for each kind and metric, <kind>_<metric> in lower case, all in one aggregation."""
    columns = [fold(F.when(F.col(kind) == k, F.col(m))).alias(f"{k}_{m}".lower()) for k in kinds for m in metrics]
    return df.groupBy(*by).agg(*columns)


def stacked(df: DataFrame, dims: Sequence[str], metric: Column, name: str) -> DataFrame:
    """A metric summed by one or two dimensions (twice the same: by one); rows with a null dimension are left out, a group of nulls only is 0."""
    dims = list(dict.fromkeys(dims))
    for d in dims:
        df = df.where(F.col(d).isNotNull())
    return df.groupBy(*dims).agg(F.coalesce(F.sum(metric), F.lit(0)).alias(name))


def top_with_others(df: DataFrame, name: str, value: str, n: int, others: str = "Others") -> DataFrame:
    """The n names with the greatest totals, ties by name, and one row for all the rest."""
    totals = df.groupBy(name).agg(F.sum(value).alias(value))
    best = totals.orderBy(F.col(value).desc_nulls_last(), F.col(name).asc_nulls_last()).limit(n).select(F.col(name).alias("_name"), F.lit(True).alias("_best"))
    label = F.when(F.col("_best"), F.col(name)).otherwise(F.lit(others))
    joined = totals.join(F.broadcast(best), F.col(name).eqNullSafe(F.col("_name")), "left")  # n rows
    return joined.groupBy(label.alias(name)).agg(F.sum(value).alias(value))


def with_totals(df: DataFrame, dims: Sequence[str], folds: Sequence[Column], total: str = "Total", every: bool = False) -> DataFrame:
    """Folds by all dims, and totals from the same scan, named ``total`` in the dims that they are over.

    Totals are over the last dims, step by step, up to the total of all; with ``every`` over each subset of them. A null of a dim stays null: grouping sets
    tell it from a total.
    """
    grouped = df.cube(*dims) if every else df.rollup(*dims)
    over = [F.grouping(d).alias(f"_over_{d}") for d in dims]
    out = grouped.agg(*folds, *over)
    shown = {d: F.when(F.col(f"_over_{d}") == 1, F.lit(total)).otherwise(F.col(d).cast("string")) for d in dims}
    return out.select(*(c.alias(d) for d, c in shown.items()), *(c for c in out.columns if c not in dims and not c.startswith("_over_")))


def order_categories(df: DataFrame, name: str, value: str, last: str = "Others") -> DataFrame:
    """Adds place: categories by their total, greatest first, ``last`` always at the end."""
    totals = df.groupBy(name).agg(F.sum(value).alias("_total"))
    place = F.row_number().over(Window.orderBy((F.col(name).cast("string") == last).cast("int"), F.col("_total").desc_nulls_last(), F.col(name)))  # a row for each category
    return df.join(totals.select(name, place.alias("place")), name)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def distinct_text(column: str, separator: str = "; ", none: str = "—") -> Column:
    """The distinct values of a group in order, as one text."""
    joined = F.array_join(F.array_sort(F.collect_set(column)), separator)
    return F.when(joined == "", none).otherwise(joined)


def null_if_any_null(column: str, fold: Callable[[Column | str], Column] = F.max) -> Column:
    """The fold of a group, or null if any of its values is null."""
    return F.when(F.sum(F.col(column).isNull().cast("int")) > 0, None).otherwise(fold(column))


def first_known(column: str, order: Column) -> Column:
    """A group's first value in an order that isn't null."""
    return F.min(F.when(F.col(column).isNotNull(), F.struct(order.alias("o"), F.col(column).alias("v"))))["v"]


def ordered_json(fields: Sequence[Column], order: Column, condition: Column | None = None) -> Column:
    """A JSON array of objects in an order, without their null fields; [] for none."""
    item = F.struct(order.alias("_o"), F.struct(*fields).alias("f"))
    listed = F.array_sort(F.collect_list(F.when(condition, item) if condition is not None else item))
    return F.to_json(F.transform(listed, lambda x: x["f"]))


def share_of_range(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds where a value lies between the least and the greatest, 0 to 1; null if they are equal. The two come as one joined row, not by a window over everything."""
    ends = df.agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    share = (F.col(column) - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0))
    return df.join(F.broadcast(ends)).withColumn(name, share).drop("_low", "_high")
