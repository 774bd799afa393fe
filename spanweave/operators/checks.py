"""Expectations on tables: each returns the rows that break it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def nulls_in(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    bad = F.lit(False)
    for c in columns:
        bad |= F.col(c).isNull()
    return df.where(bad)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def overlapping(df: DataFrame, by: Sequence[str], start: str, end: Column) -> DataFrame:
    """Rows that end after the next one of their key starts; ``end`` is what an open end stands for."""
    w = Window.partitionBy(*by).orderBy(start, end, *(c for c in df.columns if c not in (*by, start)))
    return df.withColumn("next_start", F.lead(start).over(w)).where(F.col("next_start") < end)


def expect(df: DataFrame, what: str) -> None:
    """Fail if an expectation has any row against it."""
    if not df.isEmpty():
        raise AssertionError(f"{what}: {df.limit(5).collect()}")


@dataclass(frozen=True)
class Expectations:
    """What is expected of a table. Nulls and values are counted while it is written, unique keys and ranges by reading what was written.

    ``unique`` are columns that name a row together; ``apart`` are (key columns, start, end) of ranges that mustn't overlap, an open end being far off.
    """

    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    unique: Sequence[str] = ()
    apart: tuple[Sequence[str], str, str] | None = None

    def write(self, df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
        """Write a table, over an old one if there is one; AssertionError if it isn't as expected, and then it is removed again."""
        counted = {f"{c} is null": F.count(F.when(F.col(c).isNull(), 1)) for c in self.not_null}
        counted |= {f"{c} is something else": F.count(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*v), 1)) for c, v in self.accepted.items()}
        seen = Observation()
        rows = df.observe(seen, *(n.alias(k) for k, n in counted.items())) if counted else df
        rows.write.mode("overwrite").partitionBy(*by).parquet(path)
        broken = {k: n for k, n in seen.get.items() if n} if counted else {}
        written = df.sparkSession.read.schema(df.schema).parquet(path)
        if self.unique and not (again := repeated_keys(written, self.unique)).isEmpty():
            broken["not unique"] = [tuple(r) for r in again.limit(5).collect()]
        if self.apart:
            keys, start, end = self.apart
            stop = F.coalesce(F.col(end), F.lit("9999-12-31").cast(df.schema[end].dataType))
            if not (crossed := overlapping(written, keys, start, stop)).isEmpty():
                broken["overlaps"] = [tuple(r) for r in crossed.select(*keys, start).limit(5).collect()]
        if broken:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
            raise AssertionError(f"{path}: {broken}")
