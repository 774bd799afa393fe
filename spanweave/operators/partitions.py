"""Tables in partitions, of which a write reads and replaces only those that it touches.

New partitions are first written beside the table, then the list of those touched, and then they are put in by Spark's dynamic overwrite. If that stops
half-way, the copy and its list beside the table are complete, and the next reader or writer (``read_partitions`` is the reader) puts it in again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.operators.checks import Expectations
from spanweave.operators.tables import file_system, upsert_replace, with_keys

#: Rows of one long column that may be broadcast.
MAX_BROADCAST = 1_000_000


def _paths(path: str) -> tuple[str, str]:
    """Of the new partitions, and of the values of those touched."""
    return f"{path}.parts", f"{path}.touched"


def _exists(spark: SparkSession, path: str) -> bool:
    at, fs = file_system(spark, path)
    return fs.exists(at(path))


def _delete(spark: SparkSession, path: str) -> None:
    at, fs = file_system(spark, path)
    fs.delete(at(path), True)


def _is(by: Sequence[str], values: Sequence) -> Column:
    """Whether a row is of one of the partitions; plain comparisons, so that the scan is pruned."""
    if len(by) == 1:
        known = [v[0] for v in values if v[0] is not None]
        out = F.col(by[0]).isin(known) if known else F.lit(False)
        return out | F.col(by[0]).isNull() if len(known) < len(values) else out
    out = F.lit(False)
    for v in values:
        same = F.lit(True)
        for c, x in zip(by, v, strict=True):
            same &= F.col(c).isNull() if x is None else F.col(c) == F.lit(x)
        out |= same
    return out


def _read_parts(spark: SparkSession, parts: str, values: DataFrame) -> DataFrame | None:
    """The rows that lie beside a table, their partitions typed like ``values``; None where there are none."""
    at, fs = file_system(spark, parts)
    if not any(s.isDirectory() for s in fs.listStatus(at(parts))):
        return None
    return spark.read.option("mergeSchema", True).parquet(parts).withColumns({c: F.col(c).cast(values.schema[c].dataType) for c in values.columns})


def _put_in(spark: SparkSession, path: str) -> None:
    """Put partitions that lie complete beside a table into it, and remove those of the touched that are empty now."""
    parts, touched = _paths(path)
    if not _exists(spark, f"{touched}/_SUCCESS"):
        return
    values = spark.read.parquet(touched)
    by, left = values.columns, set()
    fresh = _read_parts(spark, parts, values)
    if fresh is not None:
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
        left = {tuple(r) for r in fresh.select(*by).distinct().collect()}
    gone = [r for r in values.collect() if tuple(r) not in left]
    if gone:
        at, fs = file_system(spark, path)
        folders = spark.read.parquet(path).where(_is(by, gone)).select(F.regexp_replace(F.input_file_name(), "/[^/]*$", "").alias("p")).distinct().collect()
        for r in folders:
            fs.delete(at(r["p"]), True)
    _delete(spark, touched)
    _delete(spark, parts)


def read_partitions(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, None if there is none; a write that stopped half-way is finished first."""
    if _exists(spark, path):
        _put_in(spark, path)
        return spark.read.parquet(path)
    return None


def replace_partitions(path: str, by: Sequence[str], touched: DataFrame, make: Callable[[DataFrame | None], DataFrame], expects: Expectations | None = None) -> None:
    """Replace the partitions whose values ``touched`` has by what ``make`` makes of their stored rows; it is given None where there is no table.

    What it makes must be of these partitions; one of which it makes no row is removed. The values of partitions are collected, never rows. Rows that
    break what is expected of them are not put in.
    """
    expects = expects or Expectations()
    spark = touched.sparkSession
    stored = read_partitions(spark, path)
    if stored is None:
        fresh = f"{path}.new"
        expects.write(make(None), fresh, by)
        at, fs = file_system(spark, path)
        if not fs.rename(at(fresh), at(path)):
            raise OSError(f"can't put {path} in place")
        return
    parts, noted = _paths(path)
    values = touched.select(*by).distinct()
    known = values.collect()
    if not known:
        return
    old = stored.where(_is(by, known)).withColumns({c: F.col(c).cast(values.schema[c].dataType) for c in by})
    expects.write(make(old), parts, by)
    spark.createDataFrame(known, values.schema).coalesce(1).write.mode("overwrite").parquet(noted)
    _put_in(spark, path)


def merge_partitions(batch: DataFrame, path: str, keys: Sequence[str], by: Sequence[str], merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = upsert_replace, moves: bool = False, expects: Expectations | None = None) -> None:
    """Merge a batch by key into a table in partitions; of the table only the batch's partitions are read and written.

    With ``moves`` a key's partition may have changed: the partitions that hold one of the batch's keys are found first, by a scan of keys only, and lose it.
    ``merge`` takes the whole stored rows of the partitions, so a row that moves is merged, too.
    """
    spark = batch.sparkSession
    batch = with_keys(batch, keys)
    touched = batch.select(*by)
    stored = read_partitions(spark, path)
    if moves and stored is not None:
        kinds = {c: F.col(c).cast(batch.schema[c].dataType) for c in by}
        touched = touched.unionByName(stored.select(*{*keys, *by}).join(batch.select(*keys).distinct(), list(keys), "left_semi").withColumns(kinds).select(*by))
    replace_partitions(path, by, touched, lambda old: batch if old is None else merge(old, batch, keys), expects)


def bucket_of(entity: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")


def rebuild_entities(path: str, entity: str, changed: DataFrame, build: Callable[[Callable[[DataFrame], DataFrame]], DataFrame], buckets: int = 64, bucket: str = "bucket") -> None:
    """Recompute all rows of changed entities, a table's other rows stay; the table is in partitions by a hash of the entity.

    ``build`` is given a function that keeps an input's rows of changed entities, for each of its inputs, and returns the new rows: a chain of models sees the
    whole history of an entity or nothing of it. An entity without new rows loses its old ones. Changed entities are found once and written beside the table,
    since every input is joined with them; they are broadcast if they are counted to be few.
    """
    spark, noted = changed.sparkSession, f"{path}.changed"
    found = changed.select(entity).where(F.col(entity).isNotNull()).distinct()
    found.write.mode("overwrite").parquet(noted)
    changed = spark.read.schema(found.schema).parquet(noted)
    few = changed.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    keys = F.broadcast(changed) if few else changed
    rows = build(lambda df: df.join(keys, entity, "left_semi")).withColumn(bucket, bucket_of(entity, buckets))

    def make(old: DataFrame | None) -> DataFrame:
        return rows if old is None else old.join(keys, entity, "left_anti").unionByName(rows, allowMissingColumns=True)

    replace_partitions(path, [bucket], changed.select(bucket_of(entity, buckets).alias(bucket)), make)
    _delete(spark, noted)


def reach_of(dates: DataFrame, before: int, after: int) -> DataFrame:
    """(date): all dates from so many days before to so many days after each of (date)."""
    return dates.select(F.explode(F.sequence(F.date_sub("date", before), F.date_add("date", after))).alias("date")).distinct()


def backfill(path: str, date: str, missing: DataFrame, source: DataFrame, model: Callable[[DataFrame], DataFrame], margin: int, reach: int | None = None) -> None:
    """Recompute the daily partitions that missing dates change, from a source that has them now.

    A day's result depends on ``margin`` days before it, so a missing day changes ``reach`` (else as many) days after it, and these need their own margin. The model
    gets these days of the source only; they are few, so they are broadcast and prune its scan.
    """
    reach = margin if reach is None else reach
    known = missing.select(F.col("date").cast("date").alias("date")).distinct()
    touched = reach_of(known, 0, reach)
    needed = reach_of(touched, margin, 0)
    rows = source.join(F.broadcast(needed.withColumnRenamed("date", date)), date, "left_semi")
    fresh = model(rows).join(F.broadcast(touched.withColumnRenamed("date", date)), date, "left_semi")
    replace_partitions(path, [date], touched.withColumnRenamed("date", date), lambda _: fresh)
