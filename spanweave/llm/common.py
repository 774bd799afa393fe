"""Shared folder handling and small helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where it is unset, a local session gets a temporary one; a cluster must set it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='spanweave-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends there, so a lost executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes a query's shuffle files at its end, not at some later garbage collection of the driver."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ranges(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes add up to about so much each."""
    start = total = end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield start, end
            start, total = end, 0
    if start < end:
        yield start, end


def slices(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of about so many characters each, to bound what a Python worker holds at once."""
    return ranges(map(len, texts), chars)


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Such names, with more underscores where a column has one of them already."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def single_threaded() -> None:
    """Spark runs one task a core already."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("OMP_NUM_THREADS", "1")


#: Rows of one long key that may be broadcast.
MAX_BROADCAST_KEYS = 1_000_000


def with_rows_of(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among ``keys``; these are broadcast if counted to be few, else both sides are shuffled."""
    from pyspark.sql import functions as F

    keys = materialize(keys.distinct(), "keys")
    few = keys.count() <= MAX_BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, on, "left_semi")
