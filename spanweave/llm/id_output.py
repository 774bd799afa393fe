"""Token ids in frequency-ranked, byte-aligned variable-length code.

Ids are replaced by their rank in the whole corpus (0 the most frequent), so that common ones need one byte. An id takes 1 to 4 bytes; the
numbers of bytes stand apart, two bits each, in control bytes. numpy decodes by looking each control byte up in a table.

The files are a Parquet table of blocks of whole documents in ascending doc_id order (``ids``: shard, local_start, doc_ids, n_tokens, control,
data) beside the ranking (``ranks``: rank, id), so that Spark's committer makes them whole, on any file system, however often a task is
run again. A shard is one range of doc_ids; local_start counts the ids before a block in its shard.

Defined cases: a null text is empty and yields the end id alone; null doc_ids come first; repeated rows are all written, in the order of their bytes;
an empty table gives empty files; extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanweave.llm.common import documents, materialize, shared_dir, slices, tokenizer_path
from spanweave.llm.pieces import encoder

QUERY = "op5_id_output"
ORACLE_SQL = None  # a tokenizer is no SQL; tests check the round trip against the library
END_ID = 2
#: Tokens of a shard, at most, where shuffle partitions would be larger.
SHARD_TOKENS = 1 << 27

_LENGTHS = np.stack([(np.arange(256) >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.uint8)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
_BYTES = np.arange(4, dtype=np.uint8)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of uint32 values."""
    values = values.astype("<u4", copy=False)
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[_BYTES <= extra[:, None]]
    quads = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    quads[: len(values)] = extra
    quads = quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    return np.bitwise_or.reduce(quads, axis=1, dtype=np.uint8).tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values, as uint32."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    if lengths.size and lengths.max() <= 2:
        words = raw[:-1] | raw[1:] << np.uint32(8)
    else:
        words = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
    return words[starts] & _MASKS[lengths]


def _narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id where all of them fit."""
    return ids.astype("<u4" if len(ids) and ids.max() > 0xFFFF else "<u2").tobytes()


def _wide(raws: list[bytes], counts: np.ndarray) -> np.ndarray:
    """The ids of many documents of so many ids each, from ``_narrow``."""
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    if (sizes == 2 * counts).all():
        return np.frombuffer(b"".join(raws), "<u2")
    return np.concatenate([np.frombuffer(r, "<u2" if len(r) == 2 * n else "<u4") for r, n in zip(raws, counts.tolist(), strict=True)])


def _tokenize(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """A row for each document (doc_id, n_tokens with the end id, ids), and at a task's end one for each id that it met (id, n)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, end = encoder(path), np.array([end_id], np.uint32)
        counts = np.zeros(max(own.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                found = own.encode(texts[a:b])
                counts += np.bincount(np.concatenate(found), minlength=len(counts))
                counts[end_id] += b - a
                out = pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "n_tokens": [len(ids) + 1 for ids in found]})
                yield out.assign(ids=[_narrow(np.concatenate([ids, end])) for ids in found], id=None, n=None)
        own.forget()
        met = np.flatnonzero(counts)
        yield pd.DataFrame({"doc_id": pd.array([None] * len(met), dtype="Int64"), "n_tokens": None, "ids": None, "id": met, "n": counts[met]})

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(run, "doc_id long, n_tokens long, ids binary, id int, n long")


def write_ids(docs: DataFrame, path: str, target: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the files of all documents under ``target``."""
    spark = docs.sparkSession
    table = materialize(_tokenize(docs, path, end_id), "id-output")
    counted = table.where("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n"))
    # no more rows than the vocabulary has ids
    ranked = counted.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).cast("long").alias("rank"), "id", "n")
    ranked.coalesce(1).write.parquet(f"{target}/ranks")
    ranking = spark.read.parquet(f"{target}/ranks").collect()
    rank_of = np.zeros(max((r.id for r in ranking), default=0) + 1, np.uint32)
    for r in ranking:
        rank_of[r.id] = r.rank

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, at = TaskContext.get().partitionId(), 0
        for frame in frames:
            counts, raws = frame["n_tokens"].to_numpy(np.int64), frame["ids"].tolist()
            doc_ids = [None if pd.isna(x) else int(x) for x in frame["doc_id"].tolist()]
            for a, b in slices(raws):
                control, data = encode_values(rank_of[_wide(raws[a:b], counts[a:b])])
                yield pd.DataFrame({"shard": [shard], "local_start": [at], "doc_ids": [doc_ids[a:b]], "n_tokens": [counts[a:b].tolist()], "control": [control], "data": [data]})
                at += int(counts[a:b].sum())

    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(sum(r.n for r in ranking) / shard_tokens))
    rows = table.where("id IS NULL").select("doc_id", "n_tokens", "ids")
    ordered = rows.repartitionByRange(shards, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "ids")
    blocks = ordered.mapInPandas(run, "shard int, local_start long, doc_ids array<long>, n_tokens array<long>, control binary, data binary")
    blocks.write.option("compression", "zstd").parquet(f"{target}/ids")


def read_ids(spark: SparkSession, target: str) -> tuple[DataFrame, np.ndarray]:
    """Blocks with their global start, in file code, and the id of each rank."""
    ranking = spark.read.parquet(f"{target}/ranks").collect()
    id_of = np.zeros(len(ranking), np.uint32)
    for r in ranking:
        id_of[r.rank] = r.id
    blocks = spark.read.parquet(f"{target}/ids")
    in_block = F.expr("aggregate(n_tokens, 0L, (a, b) -> a + b)")
    totals = sorted(blocks.groupBy("shard").agg(F.sum(in_block).alias("n")).collect())  # one for each file shard
    base, at = [], 0
    for shard, n in totals:
        base.append((shard, at))
        at += n
    bases = spark.createDataFrame(base, "shard int, base long")
    return blocks.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("local_start")), id_of


def decode_ids(blocks: DataFrame, id_of: np.ndarray) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian uint32) of every document, read from the files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                counts = np.asarray(r.n_tokens, np.int64)
                raw = id_of[decode_values(r.control, r.data, int(counts.sum()))].astype("<u4", copy=False).tobytes()
                ends = np.cumsum(counts)
                ids = [raw[4 * a : 4 * b] for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                doc_ids = pd.array([None if pd.isna(x) else int(x) for x in r.doc_ids], dtype="Int64")
                yield pd.DataFrame({"doc_id": doc_ids, "start": r.start + ends - counts, "n_tokens": counts, "ids": ids})

    return blocks.select("doc_ids", "start", "n_tokens", "control", "data").mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary")


def query(spark, sf_dir):
    target = f"{shared_dir(spark)}/id-files-{uuid.uuid4().hex}"
    write_ids(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), target)
    return decode_ids(*read_ids(spark, target)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
