"""Streaming counterparts of the incremental loads: keyed merges of micro-batches, late rows, sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from spanweave.operators.tables import keep_newer, table_exists, upsert_coalesce, upsert_replace, write_version
from spanweave.operators.windows import keep_first


def latest_in_lookback(stream: DataFrame, keys: Sequence[str], ts: str, days: int = 7) -> DataFrame:
    """The latest row of each key and period of so many days, of rows not more than so many days late.

    In update mode a later row of the same key and period comes out anew, for a merge by key to take it.
    """
    newest = F.max_by(F.struct(*stream.columns), F.struct(ts, *(c for c in stream.columns if c != ts))).alias("newest")
    return stream.withWatermark(ts, f"{days} days").groupBy(*keys, F.window(ts, f"{days} days")).agg(newest).select("newest.*")


def merge_into(stream: DataFrame, path: str, keys: Sequence[str], newest: str, checkpoint: str, coalesce: bool = True) -> DataStreamWriter:
    """Merges every micro-batch into the table at ``path``: the row with the greatest ``newest`` of a key wins, among a batch's and the stored one.

    A batch that is run again gives the same table.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = keep_first(batch, keys, [F.col(newest).desc_nulls_last(), F.xxhash64(*batch.columns)])
        if table_exists(spark, path):
            stored = spark.read.parquet(path)
            fresh = (upsert_coalesce if coalesce else upsert_replace)(stored, keep_newer(stored, fresh, keys, newest), keys)
        write_version(fresh, path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def sessions(stream: DataFrame, key: str, ts: str, gap: str, late: str) -> DataFrame:
    """Chains of events of a key that are less than a gap apart."""
    return stream.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap).alias("s")).agg(F.count("*").alias("n_events")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n_events")
