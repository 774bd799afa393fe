"""Benchmark passages in documents, by latent semantic retrieval and a check of the wording.

Passages are windows of words. Over all passages of the corpus, and those of the benchmark with the weight of all of these together,
a randomised SVD of the TF-IDF matrix is computed by passes that sum small dense products on the executors. Its columns are
words of the benchmark (hashed to FEATURES places) that aren't too common; the norm of a passage counts all its words.
Every block of the benchmark has a space of its own, so that its passages keep their length there however large the benchmark is. Every
passage is compared with every benchmark passage by the cosine in the latent space; the shorter the latter is there, the less will do. A document is found if
an item's longest common subsequence with the surroundings of such a passage is nearly the whole item, or most of it and its answer
(its last words) stands there too: the latter finds paraphrases. Common words alone are no evidence: what is there must have part of the item's IDF, or be an
answer with a rare word.

Words are runs of letters and digits in lower case. Defined cases: null texts and ones without words match nothing; null doc_ids
are reported as null; repeated rows are reported once; an item of no words matches nothing; equal items are all reported; an
empty table on either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm import words as W
from spanweave.llm.common import documents, materialize, slices

QUERY = "op9_benchmark_decontamination"
ORACLE_SQL = None  # an SVD is no SQL; tests compare products and common subsequences with brute force, and findings with planted cases
FEATURES = 1 << 17
PASSAGE = 64
STEP = 32
RANK = 96
OVERSAMPLE = 16
#: A word in more than this part of the documents weighs nothing, unless it is among the rarest few of some benchmark item
#: (an item that stands in a third of all documents is found by these).
COMMON = 0.03
RAREST = 12
COSINE = 0.2
WHOLE = 0.8
MOST = 0.6
ANSWER = 0.8
ANSWER_WORDS = 6
RARE = -float(np.log(COMMON))
#: Of an item's IDF, what its words that are there must have: common words alone stand in order in many clean texts. It isn't asked for where so much of
#: the answer is there as makes an item found, a rare word (in no more documents than COMMON) among it.
WORTH = 0.45
#: Passages of the benchmark that share a space: more of them would be too short in it to be found.
BLOCK_PASSAGES = 3 * RANK
#: Blocks whose spaces are fitted, and searched, in one pass over the corpus; their matrices are in a task's memory together (some 6 MB each).
BLOCKS = 16
#: A passage is also compared if its cosine reaches so much of the length that the item's own passage has in the space.
CAPTURED = 0.25


class Space(NamedTuple):
    idf: np.ndarray  # of every feature
    weight: np.ndarray  # its weight in the matrix, 0 for common words
    column: np.ndarray  # of every feature: its place in the matrix, -1 for what is common or the benchmark lacks
    latent: np.ndarray  # columns x rank


def _tokens(texts: list[str]) -> list[np.ndarray]:
    return [(h >> np.uint64(32)).astype(np.uint32) for h in W.words(texts, lower=True, part=W.PUNCTUATION).of_texts()]


def _feature(words: np.ndarray) -> np.ndarray:
    return words & np.uint32(FEATURES - 1)


def _words(docs: DataFrame) -> DataFrame:
    """A row for each document (doc_id, words as little-endian uint32), and one for each task with its document frequencies."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, total, seen = np.zeros(FEATURES, np.int64), 0, np.zeros(FEATURES, bool)
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in slices(texts):
                found = _tokens(texts[a:b])
                total += b - a
                for words in found:
                    own = _feature(words)
                    seen[own] = True
                    df[np.flatnonzero(seen)] += 1
                    seen[own] = False
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].astype("Int64"), "words": [w.astype("<u4").tobytes() for w in found], "df": None})
        yield pd.DataFrame({"doc_id": pd.array([None], dtype="Int64"), "words": None, "df": [np.append(df, total).astype("<i8").tobytes()]})

    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    return texts.mapInPandas(run, "doc_id long, words binary, df binary")


def _sum_vectors(rows: DataFrame, column: str, dtype: str, parts: int = 16) -> np.ndarray:
    """The sum of packed vectors of one length, cut into parts that are summed apart on the executors."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            for raw in frame[column]:
                own = np.frombuffer(raw, dtype)
                total = own.copy() if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"part": range(parts), "v": [x.tobytes() for x in np.array_split(total, parts)]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(raw, dtype) for raw in frame["v"])
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "v": [total.tobytes()]})

    sums = rows.select(column).mapInPandas(split, "part int, v binary").groupBy("part").applyInPandas(add, "part int, v binary").collect()
    return np.concatenate([np.empty(0, dtype), *(np.frombuffer(r.v, dtype) for r in sorted(sums))])


def _spans(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one words of the passages of n words."""
    starts = np.arange(0, max(1, n - PASSAGE + STEP), STEP)
    return starts, np.minimum(starts + PASSAGE, n)


class _Passages(NamedTuple):
    """Passages of several texts, as ranges of the words that have a column."""

    column: np.ndarray
    weight: np.ndarray
    low: np.ndarray  # of each passage, into column and weight
    high: np.ndarray
    norm: np.ndarray
    text: np.ndarray
    start: np.ndarray


def _passages(texts: list[np.ndarray], weights: np.ndarray, columns: np.ndarray) -> _Passages:
    """Those with a word that has a column."""
    all_words = np.concatenate([np.empty(0, np.uint32), *texts])
    feature = _feature(all_words)
    weight = weights[feature]
    squares = np.concatenate([[0], np.cumsum(weight.astype(np.float64) ** 2)])
    column = columns[feature]
    some = column >= 0
    before = np.concatenate([[0], np.cumsum(some)])
    low, high, text, start, at = [], [], [], [], 0
    for i, words in enumerate(texts):
        a, b = _spans(len(words))
        low.append(a + at)
        high.append(b + at)
        text.append(np.full(len(a), i))
        start.append(a)
        at += len(words)
    low, high, text, start = (np.concatenate([np.empty(0, np.int64), *x]) for x in (low, high, text, start))
    keep = before[high] > before[low]
    low, high, text, start = low[keep], high[keep], text[keep], start[keep]
    where = np.flatnonzero(some)
    return _Passages(column[where], weight[where], before[low], before[high], np.sqrt(squares[high] - squares[low]), text, start)


def _project(p: _Passages, matrix: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows of passages times a columns x k matrix."""
    rows = np.concatenate([np.zeros((1, matrix.shape[1]), np.float32), np.cumsum(matrix[p.column] * p.weight[:, None], axis=0, dtype=np.float32)])
    return (rows[p.high] - rows[p.low]) / p.norm[:, None].astype(np.float32)


def _normal_product(p: _Passages, matrix: np.ndarray) -> np.ndarray:
    """(transposed rows) x (rows) x matrix for the unit TF-IDF rows of passages."""
    scaled = _project(p, matrix) / p.norm[:, None].astype(np.float32)
    steps = np.zeros((len(p.column) + 1, matrix.shape[1]), np.float32)
    for bound, sign in ((p.low, 1), (p.high, -1)):  # both never decrease
        first = np.flatnonzero(np.diff(bound, prepend=-1))
        if len(first):
            steps[bound[first]] += sign * np.add.reduceat(scaled, first, axis=0)
    by_word = np.cumsum(steps[:-1], axis=0) * p.weight[:, None]
    order = np.argsort(p.column, kind="stable")
    found, first = np.unique(p.column[order], return_index=True)
    out = np.zeros(matrix.shape, np.float32)
    if len(found):
        out[found] = np.add.reduceat(by_word[order], first, axis=0)
    return out


def _batches(frames: Iterator[pd.DataFrame], most: int = 400_000) -> Iterator[tuple[list, list[np.ndarray]]]:
    """doc_ids and words of rows, about so many words at a time."""
    ids, texts, size = [], [], 0
    for frame in frames:
        for doc_id, raw in zip(frame["doc_id"].tolist(), frame["words"], strict=True):
            if raw:
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(np.frombuffer(raw, "<u4"))
                size += len(texts[-1])
                if size >= most:
                    yield ids, texts
                    ids, texts, size = [], [], 0
    if texts:
        yield ids, texts


class _Block(NamedTuple):
    """What the matrix of one block of the benchmark is made of."""

    weight: np.ndarray
    column: np.ndarray
    matrix: np.ndarray


def _pass(rows: DataFrame, benches: list[list[np.ndarray]], blocks: list[_Block]) -> list[np.ndarray]:
    """The normal products of several blocks over all passages, from one pass; a block's own passages weigh as much as the corpus' together."""
    shared = rows.sparkSession.sparkContext.broadcast(blocks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, counts = [np.zeros_like(b.matrix) for b in shared.value], np.zeros(len(shared.value))
        for _, texts in _batches(frames):
            for k, block in enumerate(shared.value):
                p = _passages(texts, block.weight, block.column)
                counts[k] += len(p.low)
                totals[k] += _normal_product(p, block.matrix)
        yield pd.DataFrame({"v": [np.concatenate([*(t.reshape(-1) for t in totals), counts]).astype("<f8").tobytes()]})

    summed = _sum_vectors(rows.select("doc_id", "words").mapInPandas(run, "v binary"), "v", "<f8")
    out, at = [], 0
    for k, (bench, block) in enumerate(zip(benches, blocks, strict=True)):
        own, count = np.zeros(block.matrix.shape), 0
        for i in range(0, len(bench), 1000):
            p = _passages(bench[i : i + 1000], block.weight, block.column)
            count += len(p.low)
            own += _normal_product(p, block.matrix)
        corpus, n = np.zeros(block.matrix.shape), 0
        if len(summed):
            corpus, n = summed[at : at + block.matrix.size].reshape(block.matrix.shape), summed[len(summed) - len(blocks) + k]
            at += block.matrix.size
        out.append(corpus + own * (max(n, count) / max(1, count)))
    return out


def fit_spaces(rows: DataFrame, df: np.ndarray, benches: list[list[np.ndarray]]) -> list[Space]:
    """IDF weights, and each block's leading right singular vectors by a randomised SVD; all of them read the passages once.

    Of a normal matrix only its product with random vectors is known; the Nystrom approximation from it has the same range.
    """
    total = int(df[-1])
    idf = np.log((1 + total) / (1 + df[:-1])).astype(np.float32)
    blocks = []
    for bench in benches:
        weight = idf + np.float32(1)
        in_bench = np.zeros(FEATURES, bool)
        for words in bench:
            in_bench[_feature(words)] = True
        rare = df[:-1] <= max(COMMON * total, 2)
        for words in bench:
            own = np.unique(_feature(words))
            rare[own[np.argsort(df[own], kind="stable")[:RAREST]]] = True
        weight[~rare] = 0
        useful = np.flatnonzero(in_bench & rare)
        column = np.full(FEATURES, -1, np.int32)
        column[useful] = np.arange(len(useful))
        k = min(len(useful), RANK + OVERSAMPLE)
        start = np.linalg.qr(np.random.default_rng(3).standard_normal((len(useful), k)))[0] if k else np.zeros((0, 0))
        blocks.append(_Block(weight, column, start.astype(np.float32)))
    out = []
    for block, product in zip(blocks, _pass(rows, benches, blocks), strict=True):
        latent = np.zeros((len(block.matrix), 0), np.float32)
        if block.matrix.size:
            inner = block.matrix.T.astype(np.float64) @ product
            values, turn = np.linalg.eigh((inner + inner.T) / 2)
            some = values > 1e-6 * max(values[-1], 0)
            left, _, _ = np.linalg.svd(product @ (turn[:, some] / np.sqrt(values[some])), full_matrices=False)
            latent = left[:, :RANK].astype(np.float32)
        out.append(Space(idf, block.weight, block.column, latent))
    return out


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with one bit for each word of a."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    everything = row = (1 << len(a)) - 1
    for y in b:
        hit = row & places.get(y, 0)
        row = ((row + hit) | (row - hit)) & everything
    return len(a) - row.bit_count()


class _Item(NamedTuple):
    item_id: int | None
    words: list[int]
    worth: list[float]  # the IDF of each word


def overlap(item: _Item, text: list[int]) -> tuple[float, float]:
    """Parts of an item and of its answer that stand in order in a text; zeros if fewer than MOST of its words are there at all, or too common ones."""
    there = set(text)
    here = [v for w, v in zip(item.words, item.worth, strict=True) if w in there]
    if len(here) < MOST * len(item.words):
        return 0.0, 0.0
    answer = item.words[-ANSWER_WORDS:]
    if sum(here) < WORTH * sum(item.worth):
        told = [v for w, v in zip(answer, item.worth[-ANSWER_WORDS:], strict=True) if w in there]
        if len(told) < ANSWER * len(answer) or max(told) < RARE:
            return 0.0, 0.0
    return lcs(item.words, text) / len(item.words), lcs(answer, text) / len(answer)


def is_found(common: float, answer: float) -> bool:
    return common >= WHOLE or (common >= MOST and answer >= ANSWER)


class _Targets(NamedTuple):
    """A block's passages in its space: unit vectors, the least cosine of each and which item it is of; and the items."""

    space: Space
    vectors: np.ndarray
    bound: np.ndarray
    owners: np.ndarray
    items: list[_Item]


def _targets(space: Space, items: list[tuple[int | None, np.ndarray]]) -> _Targets:
    own = _passages([w for _, w in items], space.weight, space.column)
    vectors = _project(own, space.latent)
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 0)
    listed = [_Item(item_id, w.tolist(), space.idf[_feature(w)].tolist()) for item_id, w in items]
    return _Targets(space, vectors, np.minimum(COSINE, CAPTURED * size[:, 0]), own.text, listed)


def _near(texts: list[np.ndarray], block: _Targets) -> Iterator[tuple[int, int, int, float]]:
    """(text, start, item, cosine) of passages whose cosine with one of an item's is high enough."""
    p = _passages(texts, block.space.weight, block.space.column)
    for at in range(0, len(p.low), 8192):
        part = p._replace(low=p.low[at : at + 8192], high=p.high[at : at + 8192], norm=p.norm[at : at + 8192])
        cosines = _project(part, block.space.latent) @ block.vectors.T
        for i, j in np.argwhere(cosines >= block.bound).tolist():
            yield int(p.text[at + i]), int(p.start[at + i]), int(block.owners[j]), float(cosines[i, j])


def _matches(rows: DataFrame, blocks: list[_Targets]) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer) for some blocks of benchmark items."""
    shared = rows.sparkSession.sparkContext.broadcast(blocks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, texts in _batches(frames):
            out = []
            for block in shared.value:
                best: dict[tuple[int, int], tuple] = {}
                for text, start, item, cosine in _near(texts, block):
                    size = len(block.items[item].words)
                    near = texts[text][max(0, start - size) : start + PASSAGE + size].tolist()
                    found = (*overlap(block.items[item], near), cosine)
                    if is_found(*found[:2]):
                        best[text, item] = max(found, best.get((text, item), found))
                out += [(ids[t], block.items[i].item_id, cosine, common, answer) for (t, i), (common, answer, cosine) in best.items()]
            frame = pd.DataFrame(out, columns=["doc_id", "item_id", "cosine", "common", "answer"])
            frame["doc_id"], frame["item_id"] = frame["doc_id"].astype("Int64"), frame["item_id"].astype("Int64")
            yield frame

    return rows.select("doc_id", "words").mapInPandas(run, "doc_id long, item_id long, cosine double, common double, answer double")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each pair of a document and a benchmark item found in it: doc_id, item_id, cosine, common, answer."""
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    blocks, size = [], BLOCK_PASSAGES
    for r in items.toLocalIterator():  # the stated query set, in blocks
        words = _tokens([r.text])[0]
        if len(words):
            size += len(_spans(len(words))[0])
            if size > BLOCK_PASSAGES:
                blocks.append([])
                size = len(_spans(len(words))[0])
            blocks[-1].append((r.item_id, words))
    table = materialize(_words(docs), "decontamination-words")
    rows = table.where("words IS NOT NULL")
    df = _sum_vectors(table.where("df IS NOT NULL"), "df", "<i8")
    df = df if len(df) else np.zeros(FEATURES + 1, np.int64)
    out = None
    for at in range(0, len(blocks), BLOCKS):
        some = blocks[at : at + BLOCKS]
        spaces = fit_spaces(rows, df, [[w for _, w in block] for block in some])
        targets = [_targets(space, block) for space, block in zip(spaces, some, strict=True) if space.latent.shape[1]]
        if targets:
            own = materialize(_matches(rows, targets), "decontamination-matches")
            out = own if out is None else out.unionByName(own)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, cosine double, common double, answer double")
    return out.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("cosine", "common", "answer")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = materialize(contaminated(docs, benchmark).select(F.col("doc_id").alias("found_id")).distinct(), "decontamination-found")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["found_id"]), "left_anti")


def query(spark, sf_dir):
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
