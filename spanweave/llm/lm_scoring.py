"""Stupid-backoff scores of documents under the n-gram counts of all other documents.

Documents are dealt out to batches of about BATCH_CHARS characters by a hash. A batch has each of its n-grams as a 64-bit hash and its count
there, so that a frequent n-gram stands once for each batch, not once for each place. The counts are sums over equal hashes, over all documents and
with every n-gram that can be found. Ranges of hashes are parts, whose number grows with the batches: a batch sends a part one row with the list of its
n-grams there, the part adds up equal ones and sends the row back with the counts over all batches.

An n-gram that another document has, too, consists of two shorter ones by a word that another document has. So of three words or more only those are
counted whose two parts were seen elsewhere: all others are known to stand nowhere else, and nothing is left out. What is counted at once are the
n-grams in one of ROUNDS ranges of hashes, of one and two words together, then of each order alone; each round's shuffle files go at its end, so that
the disk holds those of one round.

A word's score is that of the longest n-gram ending there that another document has, too: its count over that of its first words, times ALPHA for every word
left out, where both counts are without the document's own. A word that no other document has counts as one seen once. The score of a document is the
sum of natural logarithms over its words.

Without its own n-grams a document is not its own evidence: one that occurs twice scores high, one unlike all others low.

Defined cases: a null or empty text has no words and the score 0 (mean null); null doc_ids and repeated rows are scored row by row (equal
texts are evidence for each other); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.llm import words as W
from spanweave.llm.common import CLEANUP as _CLEANUP  # noqa: F401
from spanweave.llm.common import documents, materialize, shuffle_files_removed

QUERY = "op7_lm_scoring"
ORACLE_SQL = None  # a trigram table and its backoff over whole texts are slow in SQL; tests compare with a direct count of all n-grams
ORDER = 3
ALPHA = 0.4
BATCH_CHARS = 4_000_000
#: Ranges of hashes that are counted one after the other.
ROUNDS = 2
#: Batches for each part that counts n-grams; of one round a batch has some 300,000.
BATCHES_A_PART = 5


def batches_of(docs: DataFrame, batch_chars: int = BATCH_CHARS) -> int:
    """Number of batches of about so many characters."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0]
    return max(1, math.ceil((chars or 0) / batch_chars))


def batched(docs: DataFrame, batch_chars: int = BATCH_CHARS, batches: int | None = None) -> DataFrame:
    """doc_id, text (null: empty) and the batch of every row."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches or batches_of(docs, batch_chars))))


def _hashes(found: W.Words, n: int) -> np.ndarray:
    """Hash of the n-gram that ends at each word, of no meaning where its text has fewer words before it."""
    own = np.zeros(len(found.hashes), np.uint64)
    own[n - 1 :] = W.grams(found.hashes, n) ^ W.mix(np.array([n], np.uint64))
    return own


def _bounds(grams: np.ndarray) -> np.ndarray:
    """Where each round's range of hashes begins among sorted ones, and their number."""
    firsts = np.array([(r << 64) // ROUNDS for r in range(ROUNDS)], np.uint64)
    return np.append(np.searchsorted(grams, firsts), len(grams))


def _places(found: W.Words, n: int, lower: np.ndarray | None) -> np.ndarray:
    """Words at which an n-gram ends that may stand elsewhere; of three words or more, by the counts elsewhere of the next lower order."""
    place = np.arange(len(found.hashes)) - np.repeat(np.cumsum(found.counts) - found.counts, found.counts)
    whole = place >= n - 1
    if n > 2:
        seen = lower > 0
        whole[1:] &= seen[1:] & seen[:-1]
    return np.flatnonzero(whole)


def _elsewhere(found: W.Words, n: int, at: np.ndarray, totals: pd.DataFrame) -> np.ndarray:
    """Of the n-gram ending at each word, the count in all other documents; totals has lists of (round, first, totals); others are those of this batch alone."""
    grams, which, here = np.unique(_hashes(found, n)[at], return_inverse=True, return_counts=True)
    total, bounds = here.copy(), _bounds(grams)
    for r, first, known in zip(totals["round"], totals["first"], totals["totals"], strict=True):
        total[bounds[r] + first : bounds[r] + first + len(known)] = known
    text = np.repeat(np.arange(len(found.counts)), found.counts)[at]
    own, again = np.ones(len(at), np.int64), np.flatnonzero(here[which] > 1)
    _, pair, in_text = np.unique(text[again] * np.int64(len(here) or 1) + which[again], return_inverse=True, return_counts=True)
    own[again] = in_text[pair]
    out = np.zeros(len(found.hashes), np.int64)
    out[at] = total[which] - own
    return out


def _all_elsewhere(found: W.Words, orders: range, known: pd.DataFrame) -> list[np.ndarray]:
    """The counts of ``_elsewhere`` for successive orders, of which the first is 1 or 2."""
    out: list[np.ndarray] = []
    for n in orders:
        out.append(_elsewhere(found, n, _places(found, n, out[-1] if out else None), known[known["n"] == n]))
    return out


def ngrams(rows: DataFrame, known: DataFrame | None, orders: range, turn: int, parts: int | None = None) -> DataFrame:
    """The n-grams of these orders that may stand in several documents and whose hashes are in a round's range.

    With ``parts`` (batch, n, part, first, here, gram): of each batch and order a row for each of so many parts of the range, with lists in the order of
    hashes. ``gram`` has the hashes, ``here`` how often the batch has them, and ``first`` is the first one's place among the batch's of n words in the range.
    Without, (batch, n, here, gram, nth), a row for each n-gram. ``known`` has the totals of all lower orders; there are none for those of one and two words.
    """
    edges = np.array([((turn * (parts or 1) + p) << 64) // (ROUNDS * (parts or 1)) for p in range(parts or 1)], np.uint64)

    def run(texts: pd.DataFrame, counts: pd.DataFrame | None) -> pd.DataFrame:
        found = W.words(texts["text"].tolist())
        lower = None if counts is None else _all_elsewhere(found, range(2, orders[0]), counts)[-1]
        lists = []
        for n in orders:
            grams, here = np.unique(_hashes(found, n)[_places(found, n, lower)], return_counts=True)
            own = slice(*_bounds(grams)[turn : turn + 2].tolist())
            grams, here = grams[own], here[own].astype(np.int32)
            cuts = np.append(np.searchsorted(grams, edges), len(grams)).tolist()
            lists += [(n, p, a, here[a:b], grams[a:b].view(np.int64)) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
        out = pd.DataFrame(lists, columns=["n", "part", "first", "here", "gram"])
        out.insert(0, "batch", texts["batch"].iloc[0] if len(texts) else 0)
        return out

    schema = "batch long, n int, part int, first int, here array<int>, gram array<long>"
    if known is None:
        out = rows.groupBy("batch").applyInPandas(lambda texts: run(texts, None), schema)
    else:
        out = rows.groupBy("batch").cogroup(known.where("n > 1").groupBy("batch")).applyInPandas(run, schema)
    if parts:
        return out
    return out.select("batch", "n", "first", F.posexplode(F.arrays_zip("here", "gram"))).select("batch", "n", "col.*", (F.col("first") + F.col("pos")).alias("nth"))


def with_totals(grams: DataFrame) -> DataFrame:
    """(batch, n, first, totals): beside a batch's n-grams, lists or single ones, their counts over all batches; they are shuffled once, by their part."""
    if "part" not in grams.columns:
        grams = grams.select("batch", "n", F.lit(0).alias("part"), F.col("nth").alias("first"), F.array("here").alias("here"), F.array("gram").alias("gram"))

    def run(rows: pa.Table) -> pa.Table:
        lists = rows["gram"].combine_chunks()
        gram, here = lists.flatten().to_numpy(), rows["here"].combine_chunks().flatten().to_numpy()
        order = np.argsort(gram)
        own = gram[order]
        firsts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        sums = np.add.reduceat(here[order], firsts, dtype=np.int64)
        total = np.empty(len(gram), np.int64)
        total[order] = np.repeat(sums, np.diff(np.append(firsts, len(gram))))
        ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy())).astype(np.int32)
        schema = pa.schema([rows.schema.field(c) for c in ("batch", "n", "first")] + [("totals", lists.type)])
        return pa.table([rows["batch"], rows["n"], rows["first"], pa.ListArray.from_arrays(ends, pa.array(total)).cast(lists.type)], schema)

    return grams.groupBy("part").applyInArrow(run, "batch long, n int, first int, totals array<long>")


def listed(counted: DataFrame, turn: int) -> DataFrame:
    """(batch, n, round, first, totals): the lists of one round."""
    return counted.select("batch", "n", F.lit(turn).alias("round"), "first", "totals")


def backoff(counts: list[np.ndarray], alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Log score of each word, and whether it is that of the word alone, from which the logarithm of the number of words is still to be taken.

    counts[n - 1] has the count of the n-gram ending at each word, 0 where there is none.
    """
    score = np.log(np.maximum(counts[0], 1)) + (len(counts) - 1) * np.log(alpha)
    alone = np.ones(len(score), bool)
    for n in range(2, len(counts) + 1):
        at = np.flatnonzero(counts[n - 1])
        score[at] = np.log(counts[n - 1][at] / counts[n - 2][at - 1]) + (len(counts) - n) * np.log(alpha)
        alone[at] = False
    return score, alone


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """doc_id, n_words, log_score and mean_log_score of every document."""
    batches = batches_of(docs, batch_chars)
    rows, known, parts = batched(docs, batches=batches), None, math.ceil(batches / BATCHES_A_PART)

    def add(texts: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        found = W.words(texts["text"].tolist())
        each, alone = backoff(_all_elsewhere(found, range(1, order + 1), counts), alpha)
        ends = np.cumsum(found.counts)

        def by_text(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[ends] - sums[ends - found.counts]

        out = pd.DataFrame({"doc_id": texts["doc_id"].astype("Int64"), "n_words": found.counts})
        return out.assign(n_alone=by_text(alone), log_score=by_text(each))

    with shuffle_files_removed(docs.sparkSession):
        for orders in (range(1, min(order, 2) + 1), *(range(n, n + 1) for n in range(3, order + 1))):
            lower = known
            for turn in range(ROUNDS):
                found = materialize(listed(with_totals(ngrams(rows, lower, orders, turn, parts)), turn), "counts")
                known = found if known is None else known.unionByName(found)
        grouped = rows.groupBy("batch").cogroup(known.groupBy("batch"))
        scored = materialize(grouped.applyInPandas(add, "doc_id long, n_words long, n_alone long, log_score double"), "scores")
    words = scored.agg(F.sum("n_words")).first()[0] or 0
    others = F.greatest(F.lit(words) - F.col("n_words"), F.lit(1))
    out = scored.select("doc_id", "n_words", (F.col("log_score") - F.col("n_alone") * F.log(others)).alias("log_score"))
    return out.withColumn("mean_log_score", F.expr("try_divide(log_score, n_words)"))


def query(spark, sf_dir):
    return score(documents(spark, sf_dir))
