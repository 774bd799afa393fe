"""Keyed writes on plain files: upserts, overrides, whole replacement, incremental windows.

Every function returns the new version of a table; ``write_version`` puts it in place of the old one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.operators.checks import Expectations
from spanweave.operators.windows import keep_first


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def upsert_coalesce(target: DataFrame, batch: DataFrame, keys: Sequence[str], touched: str | None = None, now: Column | None = None) -> DataFrame:
    """Merge by key: a matched row takes the batch's values that aren't null, others are added. Batch rows with a null key are dropped.

    A key that stands in the batch more than once is an error, since no row of it is the last; ``latest_of_keys`` takes one of each.

    ``touched`` names a column that matched and added rows get set to ``now``. A column that only the batch has is added.
    """
    names = [*target.columns, *(c for c in batch.columns if c not in target.columns)]
    other = _one_of_each(with_keys(batch, keys), keys).select(*(F.col(c).alias(f"_b_{c}") for c in batch.columns), F.lit(True).alias("_hit"))
    on = F.lit(True)
    for k in keys:
        on &= F.col(k) == F.col(f"_b_{k}")
    joined = target.join(other, on, "full_outer")

    def value(c: str) -> Column:
        if c == touched:
            return F.when(F.col("_hit"), now).otherwise(F.col(c)).alias(c)
        sides = [F.col(f"_b_{c}")] if c in batch.columns else []
        sides += [F.col(c)] if c in target.columns else []
        kind = target.schema[c].dataType if c in target.columns else batch.schema[c].dataType
        return F.coalesce(*(s.cast(kind) for s in sides)).alias(c)

    return joined.select(*(value(c) for c in names))


def _one_of_each(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch; a key that comes again fails the job."""
    again = F.count("*").over(Window.partitionBy(*keys)) > 1
    failed = F.raise_error(F.concat_ws(" ", F.lit("the batch has a key twice:"), *(F.col(k).cast("string") for k in keys)))
    return batch.withColumn("_twice", F.when(again, failed.cast("boolean"))).where("_twice IS NULL").drop("_twice")


def latest_of_keys(batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of a batch's rows of one key that which comes last in a total order; rows with a null key go."""
    return keep_first(with_keys(batch, keys), keys, order)


def keep_newer(target: DataFrame, batch: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """The batch without rows that are older than the stored row of their key; one as old is taken, a null is the oldest."""
    stored = target.select(*(F.col(k).alias(f"_t_{k}") for k in keys), F.col(newest).alias("_newest"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k) == F.col(f"_t_{k}")
    older = F.col("_newest").isNotNull() & (F.col(newest).isNull() | (F.col(newest) < F.col("_newest")))
    return batch.join(stored, same & older, "left_anti")


def upsert_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge by key where the batch's row replaces the whole old one, nulls too."""
    batch = with_keys(batch, keys)
    return target.join(batch.select(*keys).distinct(), list(keys), "left_anti").unionByName(batch, allowMissingColumns=True)


def apply_overrides(target: DataFrame, key: str, updates: DataFrame | None = None, deletes: DataFrame | None = None, upserts: DataFrame | None = None) -> DataFrame:
    """Hand-made corrections by key, in this order: updates of the values given, deletions, whole rows put in."""
    if updates is not None:
        known = target.join(updates.select(key), key, "left_semi").select(key)
        target = upsert_coalesce(target, updates.join(known, key, "left_semi"), [key])
    if deletes is not None:
        target = target.join(deletes.select(key), key, "left_anti")
    return upsert_replace(target, upserts, [key]) if upserts is not None else target


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a table in the folder that the cluster shares (spark.checkpoint.dir); a local session without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='spanweave-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at, at(path).getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table; one that a stopped write had moved aside is put back first."""
    at, fs = file_system(spark, path)
    if not fs.exists(at(path)) and fs.exists(at(f"{path}.last")) and not fs.rename(at(f"{path}.last"), at(path)):
        raise OSError(f"can't put {path} back")
    return fs.exists(at(path))


def write_version(df: DataFrame, path: str, expects: Expectations | None = None) -> None:
    """Write a table beside its old version, then put it in its place, unless it breaks what is expected of it.

    If it stops between the two renames, the old version lies aside; the next call, or ``table_exists``, puts it back.
    """
    spark = df.sparkSession
    at, fs = file_system(spark, path)
    fresh, old = f"{path}.next", f"{path}.last"
    (expects or Expectations()).write(df, fresh)
    if table_exists(spark, path):
        fs.delete(at(old), True)
        if not fs.rename(at(path), at(old)):
            raise OSError(f"can't move {path}")
    if not fs.rename(at(fresh), at(path)):
        raise OSError(f"can't put {path} in place")
    fs.delete(at(old), True)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table as they are."""
    df.write.mode("append").parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at a path, made empty with the two ingest times if there is none."""
    if not table_exists(spark, path):
        times = [T.StructField(c, T.TimestampType()) for c in ("first_ingested_at", "last_ingested_at")]
        write_version(spark.createDataFrame([], T.StructType([*schema.fields, *times])), path)
    return spark.read.parquet(path)


def truncate(spark: SparkSession, path: str) -> None:
    """Remove all rows of a table; its columns stay."""
    write_version(spark.createDataFrame([], spark.read.parquet(path).schema), path)


def first_ingest(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Adds the times of the first and the last ingest of each row."""
    now = F.current_timestamp() if now is None else now
    return df.withColumns({"first_ingested_at": now, "last_ingested_at": now})


def resume_point(target: DataFrame, column: str, days: int, default: str = "2010-01-01") -> Column:
    """The latest date of a table less some days, as a literal; ``default`` for an empty table."""
    latest = target.agg(F.max(F.try_to_timestamp(F.col(column).cast("string"))).cast("date").alias("d")).first()["d"]
    return F.date_sub(F.lit(latest), days) if latest else F.lit(default).cast("date")


def recompute_window(source: DataFrame, target: DataFrame, column: str, keys: Sequence[str], days: int, margin: int, model: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Recompute a table's last days and merge them in.

    The model reads ``margin`` days more than it writes, so that lags and rolling values at the window's edge are what a full run gives.
    """
    cutoff = resume_point(target, column, days)
    fresh = model(source.where(F.col(column) >= F.date_sub(cutoff, margin))).where(F.col(column) >= cutoff)
    return upsert_replace(target, fresh, keys)
