"""Token counts of whole texts, with huge documents cut into overlapping chunks.

A document beyond ``chunk_chars`` becomes chunks that overlap, spread over the cluster. Each is encoded with
offsets. Two neighbours are spliced at a boundary which both have and which is proven stable: a token starts
there in both, a word starts there after white space, and a whole word on either side lies inside both chunks. The
tokenizers given here never merge across white space, so nothing beyond can move such a boundary. Where an overlap has
no such place (a word longer than the overlap), the document's overlap is widened fourfold and it is tried again,
in the end as one chunk.

Defined cases: null text counts as empty (0 bytes, 0 tokens); a null doc_id stays one row per input row; repeated
rows stay repeated; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import documents, materialize, slices, tokenizer_path
from spanweave.llm.pieces import encoder

QUERY = "op3_token_counts"
ORACLE_SQL = None  # a tokenizer is no SQL; tests compare with the library on whole texts
LIMIT = 2048
CHUNK_CHARS = 50_000
OVERLAP_CHARS = 400
WIDEN = 4
#: Characters of chunks that a task hands on at a time.
MAX_HELD_CHARS = 2_000_000

_WORD_START = re.compile(r"(?<=[ \t\n\r])(?=[^ \t-\r])")


def _chunk_summary(path: str, text: str, head: int, tail: int) -> tuple[int, list[int], list[int], list[int], list[int]]:
    """Tokens of a chunk, and the stable boundaries in its first ``head`` and last ``tail`` characters with the tokens before each.

    A boundary is kept only if a whole word of its own side of the overlap stands before and after it inside the chunk.
    """
    encoding = encoder(path).tokenizer.encode(text, add_special_tokens=False)
    starts: dict[int, int] = {}
    keeps_space = encoder(path).keeps_space
    for k, (at, _) in enumerate(encoding.offsets):
        starts.setdefault(at, k)
    found: list[tuple[list[int], list[int]]] = []
    for low, high in ((0, head), (len(text) - tail, len(text))):
        places, before = [], []
        words = [m.start() for m in _WORD_START.finditer(text, max(low, 0), high)] if high > low else []
        for at in words[1:-1]:  # the first and last may be cut
            token = starts.get(at - 1 if keeps_space and text[at - 1] == " " else at)
            if token is not None:
                places.append(at)
                before.append(token)
        found.append((places, before))
    return len(encoding.ids), found[0][0], found[0][1], found[1][0], found[1][1]


def _chunks(huge: DataFrame, chunk_chars: int) -> DataFrame:
    """Chunk k of a text starts at k * chunk_chars and runs ``overlap`` characters into the next one. A text is read once, not for each chunk."""

    def of_text(text: str, overlap: int) -> Iterator[tuple[int, int, str]]:
        n = max(1, -(-(len(text) - overlap) // chunk_chars))
        for k in range(n):
            yield n, k, text[k * chunk_chars : (k + 1) * chunk_chars + overlap if k < n - 1 else None]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["row", "overlap", "n_chunks", "chunk", "part"]
        for frame in frames:
            held, size = [], 0
            for row, overlap, text in zip(frame["row"], frame["overlap"].tolist(), frame["text"], strict=True):
                for n, k, part in of_text(text, overlap):
                    held.append((row, overlap, n, k, part))
                    size += len(part)
                    if size > MAX_HELD_CHARS:
                        yield pd.DataFrame(held, columns=columns)
                        held, size = [], 0
            yield pd.DataFrame(held, columns=columns)

    return huge.select("row", "overlap", "text").mapInPandas(run, "row string, overlap int, n_chunks int, chunk int, part string")


def _encode_chunks(chunks: DataFrame, path: str, chunk_chars: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                head = int(r.overlap) if r.chunk else 0
                tail = int(r.overlap) if r.chunk < r.n_chunks - 1 else 0
                n, p, b, q, c = _chunk_summary(path, r.part, head, tail)
                base = int(r.chunk) * chunk_chars
                rows.append((r.row, r.overlap, r.n_chunks, r.chunk, n, [x + base for x in p], b, [x + base for x in q], c))
            yield pd.DataFrame(rows, columns=["row", "overlap", "n_chunks", "chunk", "n", "head_at", "head_before", "tail_at", "tail_before"])

    schema = "row string, overlap int, n_chunks int, chunk int, n long, head_at array<int>, head_before array<int>, tail_at array<int>, tail_before array<int>"
    return chunks.repartition("row", "chunk").mapInPandas(run, schema)


def _splice(summaries: DataFrame) -> DataFrame:
    """Tokens of each text, null where some pair of neighbours has no common stable boundary."""
    from pyspark.sql import Window

    after = Window.partitionBy("row").orderBy("chunk")
    pairs = summaries.select(
        "row", "overlap", "n_chunks", "n", "chunk", "tail_at", "tail_before",
        F.lead("head_at").over(after).alias("next_at"), F.lead("head_before").over(after).alias("next_before"),
    )
    at = F.array_min(F.array_intersect("tail_at", "next_at"))
    cut = F.try_element_at("tail_before", F.array_position("tail_at", at).cast("int"))
    skip = F.try_element_at("next_before", F.array_position("next_at", at).cast("int"))
    last = F.col("chunk") == F.col("n_chunks") - 1
    return pairs.groupBy("row", "overlap").agg(
        F.when(F.count_if(~last & at.isNull()) == 0, F.sum(F.when(last, F.col("n")).otherwise(cut - skip))).alias("n_tokens")
    )


def count_huge(huge: DataFrame, path: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(row, n_tokens) for (row, text), by chunks; ``row`` is a unique key of the input rows."""
    todo = huge.select("row", "text").withColumn("overlap", F.lit(overlap_chars))
    done = None
    while True:
        counts = materialize(_splice(_encode_chunks(_chunks(todo, chunk_chars), path, chunk_chars)), "token-chunks")
        good = counts.where("n_tokens IS NOT NULL").select("row", "n_tokens")
        done = good if done is None else done.unionByName(good)
        failed = counts.where("n_tokens IS NULL").select("row", (F.col("overlap") * WIDEN).alias("overlap"))
        if failed.isEmpty():
            return done
        todo = huge.select("row", "text").join(failed, "row")


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    huge = F.length("text") > chunk_chars

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for frame in frames:
            texts = frame["text"].tolist()
            counts = [n for a, b in slices(texts) for n in own.count(texts[a:b]).tolist()]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts})
        own.forget()

    short = texts.where(~huge).mapInPandas(run, "doc_id long, n_bytes long, n_tokens long")
    # a text is its own key, so that copies of a huge document are encoded once
    long = texts.where(huge).withColumn("row", F.sha2("text", 256))
    counted = count_huge(long.groupBy("row").agg(F.min("text").alias("text")), path, chunk_chars, overlap_chars)
    keys = long.select("doc_id", "row", F.octet_length("text").cast("long").alias("n_bytes"))
    rest = keys.join(counted, "row").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(rest).withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir):
    return count_tokens(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
