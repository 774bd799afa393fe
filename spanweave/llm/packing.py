"""Best-two-fit packing of token sequences.

Every document becomes its ids and one end id; only one longer than the capacity is cut, into full pieces and a rest. A full
piece is a sequence by itself. The others are dealt evenly, by a hash of a row number, into groups of bounded size
that are packed apart. In a group a bin is filled greedily with the largest document that still fits; then, if two unpacked
documents together fit the gap that its smallest one would leave more tightly than that one does, they replace it.
A group leaves at most about one bin partly filled that larger groups would not, among thousands.

Defined cases: a null text is empty and yields one piece with the end id alone; null doc_ids and repeated rows are packed
row by row; an empty table gives an empty plan; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import documents, materialize, slices, tokenizer_path
from spanweave.llm.pieces import encoder

QUERY = "op1_best_fit_packing"
ORACLE_SQL = None  # a tokenizer is no SQL; tests check the plan against the library and the text
CAPACITY = 2048
END_ID = 0
#: Documents packed together in one task.
GROUP_ITEMS = 4096


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece: item (unique), doc_id, piece, start, length, ids_crc32 and, if asked, ids (little-endian uint32)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, end = encoder(path), np.array([end_id], np.uint32)
        for frame in frames:
            texts = frame["text"].tolist()
            doc_ids = frame["doc_id"].tolist()
            for a, b in slices(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], own.encode(texts[a:b]), strict=True):
                    ids = np.concatenate([ids, end]).astype("<u4", copy=False)
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        raw = ids[at : at + capacity].tobytes()
                        rows.append((doc_id, k, at, len(raw) // 4, zlib.crc32(raw), *([raw] if with_ids else [])))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out
        own.forget()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # written with the rows: the numbers stay the same if a task is run again later
    return texts.mapInPandas(run, schema).withColumn("item", F.monotonically_increasing_id())


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (1 to capacity)."""
    order = np.argsort(-lengths, kind="stable")
    by_length: dict[int, list[int]] = {}
    for i in order[::-1].tolist():
        by_length.setdefault(int(lengths[i]), []).append(i)
    left = np.zeros(capacity + 1, np.int64)
    for length, items in by_length.items():
        left[length] = len(items)
    sizes = np.arange(capacity + 1)
    #: largest unpacked length at most x, 0 if none
    below = np.maximum.accumulate(np.where(left > 0, sizes, 0))

    def take(length: int) -> int:
        left[length] -= 1
        if left[length] == 0:
            high = int(below.searchsorted(length, "right"))
            below[length:high] = below[length - 1]
        return by_length[length].pop()

    def give(length: int, item: int) -> None:
        left[length] += 1
        by_length[length].append(item)
        if left[length] == 1:
            high = int(below.searchsorted(length, "left"))
            below[length : max(high, length)] = length

    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    count = 0
    while below[capacity]:
        gap, content = capacity, []
        while gap and below[gap]:
            length = int(below[gap])
            content.append((length, take(length)))
            gap -= length
        if gap and below[capacity]:
            small, item = content[-1]
            room = gap + small
            first = np.flatnonzero(left[1:room] > 0) + 1
            second = below[room - first]
            second = np.where((second == first) & (left[first] < 2), below[first - 1], second)
            both = np.where((second > 0) & (second <= first), first + second, 0)
            if len(both) and both.max() > small:
                a = int(first[both.argmax()])
                b = int(second[both.argmax()])
                content[-1:] = [(a, take(a)), (b, take(b))]
                give(small, item)
        at = 0
        for length, item in content:
            bins[item], offsets[item] = count, at
            at += length
        count += 1
    return bins, offsets


def plan(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Adds sequence_id and offset to (item, length, ...) rows, which must not be recomputed differently (a written table)."""
    full = items.where(F.col("length") == capacity).select("*", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.where(F.col("length") < capacity)
    groups = max(1, math.ceil(rest.count() / group_items))
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups)))
    schema = items.schema.add("sequence_id", "long").add("offset", "long")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item")
        bins, offsets = best_two_fit(frame["length"].to_numpy(), capacity)
        frame["sequence_id"] = frame["group"].to_numpy().astype("int64") * (1 << 32) + bins
        frame["offset"] = offsets
        return frame.drop(columns="group")

    return full.unionByName(dealt.groupBy("group").applyInPandas(pack, schema))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packing plan of all documents: every piece with its sequence and its place there."""
    return plan(materialize(pieces(docs, path, capacity, end_id), "packing-pieces"), capacity)


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, the doc_ids in order and ids (little-endian uint32)."""
    rows = materialize(pieces(docs, path, capacity, end_id, with_ids=True), "packing-ids")
    placed = plan(rows.drop("ids"), capacity).select("item", "sequence_id", "offset").join(rows.select("item", "doc_id", "length", "ids"), "item")
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))  # at most ``capacity`` of them
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, 0L, (n, p) -> n + p.length)").alias("length"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.expr("aggregate(parts, CAST('' AS BINARY), (all, p) -> concat(all, p.ids))").alias("ids"),
    )


def query(spark, sf_dir):
    placed = pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
