"""Runs of words that repeat with a period, found on a harmonic grid.

A run with period p and four periods or more holds four neighbouring multiples of p at least. For each p and j the longest common extensions of jp and
(j + 1)p, forward and backward, give the whole run. They are queries of least values over the common prefixes of neighbours in the suffix array of the
words, and in that of the words reversed. The grid of n words has about n log n pairs; a pair is only asked for where the words at four multiples are
equal, since elsewhere no run goes through them. A run found by several multiples of its period has the least of them.

A document is worked on in one task, whole; the arrays take some 250 bytes for each word of a text with a candidate, so texts share one suffix array only
up to BLOCK words.

Defined cases: a null text or one without words has no runs and an empty collapsed text; repeated rows stay; an empty table gives an empty result; other
columns are kept, and a column named like a new one is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm import words as W
from spanweave.llm.common import documents, fresh, ranges, slices

QUERY = "op11_periodic_runs"
ORACLE_SQL = None  # extensions on suffix arrays are no SQL; tests compare with brute force
#: A run has so many periods at least, and so many words.
FOLD = 4
LEAST = 6
#: Words of the texts that share a suffix array, and grid pairs looked at together.
BLOCK = 200_000
PAIRS = 1_000_000
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Extensions:
    """Longest common prefixes of any two suffixes of a sequence of ids, by suffix array and range minima."""

    def __init__(self, ids: np.ndarray) -> None:
        n = self.n = len(ids)
        rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        levels = []  # ranks of the 1, 2, 4 ... ids from each place on
        while True:
            levels.append(np.append(rank, -1))
            width = 1 << (len(levels) - 1)
            ahead = np.zeros(n, np.int64)
            ahead[: max(0, n - width)] = rank[width:] + 1
            key = rank * (n + 2) + ahead
            order = np.argsort(key, kind="stable")
            new = np.append(0, np.cumsum(np.diff(key[order]) != 0))
            rank = np.empty(n, np.int64)
            rank[order] = new
            if not n or new[-1] == n - 1:
                break
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(0, n - 1), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][a] == levels[k][b]
            common[same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        self.rank = rank
        table = [common.astype(np.int32)]
        while 2 << (len(table) - 1) <= len(common):
            last, half = table[-1], 1 << (len(table) - 1)
            table.append(np.append(np.minimum(last[:-half], last[half:]), last[-half:]))
        self.table = np.stack(table)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places i != j; a place behind the end has no extension."""
        out = np.zeros(len(i), np.int64)
        inside = (i < self.n) & (j < self.n)
        x, y = self.rank[i[inside]], self.rank[j[inside]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        k = np.frexp(high - low)[1] - 1
        out[inside] = np.minimum(self.table[k, low], self.table[k, high - (1 << k)])
        return out


def grid(n: int, fold: int = FOLD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): multiples of each period after which ``fold`` - 1 more lie within n words."""
    periods = np.arange(1, n // fold + 1)
    counts = (n - 1) // periods - fold + 2
    for a, b in ranges(counts.tolist(), PAIRS) if counts.sum() > PAIRS else [(0, len(counts))]:
        period = np.repeat(periods[a:b], counts[a:b])
        turn = np.arange(len(period)) - np.repeat(np.cumsum(counts[a:b]) - counts[a:b], counts[a:b])
        yield turn * period, period


def candidates(hashes: np.ndarray, fold: int = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """The (place, period) of the grid with the same word at ``fold`` multiples in a row."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for place, period in grid(len(hashes), fold):
        for k in range(1, fold):
            same = hashes[place + (k - 1) * period] == hashes[place + k * period]
            place, period = place[same], period[same]
        found.append((place, period))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _settled(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of stretches found by several multiples of their period those with the least, by start and period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0)) if len(start) else np.empty(0, bool)
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def runs_of(texts: list[list], asked: list[tuple[np.ndarray, np.ndarray]], fold: int = FOLD, least: int = LEAST) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, lengths, periods) of each list of words, which share a suffix array, at the candidates of each."""
    sizes = np.array([len(t) + 1 for t in texts])
    offsets = np.cumsum(sizes) - sizes
    ids = pd.factorize(np.array([w for t in texts for w in (*t, None)], object), use_na_sentinel=True)[0].astype(np.int64)
    ends = offsets + sizes - 1
    ids[ends] = ids.max(initial=-1) + 1 + np.arange(len(ends))  # no extension goes from one text into the next
    n = len(ids)
    place = np.concatenate([p + o for (p, _), o in zip(asked, offsets, strict=True)])
    period = np.concatenate([p for _, p in asked])
    owner = np.repeat(np.arange(len(texts)), [len(p) for p, _ in asked])
    forward = Extensions(ids).of(place, place + period)
    backward = Extensions(ids[::-1]).of(n - place, n - place - period)
    start, end = place - backward, place + period + forward
    good = end - start >= np.maximum(least, fold * period)
    bounds = np.searchsorted(owner[good], np.arange(len(texts) + 1))
    start, end, period = start[good], end[good], period[good]
    for a, b, offset in zip(bounds[:-1], bounds[1:], offsets, strict=True):
        yield _settled(start[a:b] - offset, end[a:b] - offset, period[a:b])


def collapse(words: list, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> list:
    """The words without those that stand in a run after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _of_texts(texts: list[str], fold: int, least: int) -> Iterator[tuple[list[dict], str]]:
    """Runs and collapsed text of each."""
    split = [t.encode(errors="surrogatepass").split() for t in texts]
    asked = [candidates(h, fold) for h in W.words(texts).of_texts()]
    hit = [i for i, (p, _) in enumerate(asked) if len(p)]
    found = {}
    for a, b in ranges((len(split[i]) for i in hit), BLOCK):
        own = hit[a:b]
        found |= dict(zip(own, runs_of([split[i] for i in own], [asked[i] for i in own], fold, least), strict=True))
    for i, words in enumerate(split):
        runs = found.get(i)
        kept = words if runs is None else collapse(words, *runs)
        listed = [] if runs is None else [{"start": s, "length": n, "period": p} for s, n, p in zip(*(x.tolist() for x in runs), strict=True)]
        yield listed, b" ".join(kept).decode(errors="surrogatepass")


def with_runs(docs: DataFrame, fold: int = FOLD, least: int = LEAST) -> DataFrame:
    """Adds ``runs``, maximal stretches of words with their smallest period, of at least ``fold`` periods and ``least`` words, by start and
    period; and ``collapsed``, the text without what stands in a run after its first period, words joined by one space."""
    for name in ("runs", "collapsed"):
        if fresh(docs, name) != [name]:
            raise ValueError(f"there is a column {name} already")
    if fold < 2:
        raise ValueError("a run has two periods at least")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].fillna("").tolist()
            for a, b in slices(texts):
                runs, collapsed = zip(*_of_texts(texts[a:b], fold, least), strict=True)
                yield frame.iloc[a:b].assign(runs=list(runs), collapsed=list(collapsed))

    return docs.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"runs {_RUNS}", "collapsed string"]))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where, in every tenth document by a hash of its doc_id, the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.pmod("h", F.lit(10)) == 0, split)).withColumn("n", F.size(F.coalesce("w", F.array().cast("array<string>"))))
    hit, g = F.col("n") > 0, F.floor(F.col("h") / 10)
    rows = rows.withColumn("a", F.when(hit, F.pmod(g, F.col("n"))).cast("int")).withColumn("p", F.when(hit, 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.pmod(g, F.lit(8))))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a"))), " ")
    return rows.select("doc_id", F.when(hit, text).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Of each document with its runs: how many, the one with most periods, and hashes of all runs and of the collapsed text."""
    best: Column = F.expr("aggregate(runs, runs[0], (b, r) -> IF(r.length * b.period > b.length * r.period, r, b))")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.expr("CAST(1000 * best.length div best.period AS BIGINT)").alias("exponent_milli")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent, "runs_sha256", "collapsed_sha256")


def query(spark, sf_dir):
    return digests(with_runs(planted(documents(spark, sf_dir))))
