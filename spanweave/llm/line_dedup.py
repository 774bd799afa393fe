"""Repeated passages removed by winnowing over line hashes.

Passages that repeat begin and end inside the lines of a file, so a text is taken as rolling lines of LINE_WORDS words, one from each
word on. In every WINDOW of consecutive lines the least hash is a fingerprint; so any run of LINE_WORDS + WINDOW - 1 words that
stands in two texts gives both the same fingerprint. Of texts that share a fingerprint, every passage of MIN_WORDS words whose least line it is
is hashed; a passage's first document in the corpus (by doc_id, nulls first) keeps it, and it is deleted from all others. So a
passage meets all its places, whatever else the line in it stands in. Within a document, too, a passage that stood before is deleted: that is
settled where its fingerprints are taken, if one of them comes again.

Documents are rows with the same doc_id and text. Defined cases: a null text has no runs and stays null; rows repeated as a whole are one document
and get the same result; a short text is never changed; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm import words as W
from spanweave.llm.common import documents, fresh, materialize, slices, with_rows_of

QUERY = "op4_line_dedup"
ORACLE_SQL = None  # winnowing and word-wise extension are no SQL; tests compare with brute force
LINE_WORDS = 16
WINDOW = 34
MIN_WORDS = 50
#: Documents whose passages by one fingerprint are dealt out together.
PLENTY = 1000


def _least(hashes: np.ndarray, window: int) -> np.ndarray:
    """Place of the least hash (the last of equal ones) of each window."""
    n = len(hashes)
    bits = max(1, int(n - 1).bit_length())
    late = np.uint64((1 << bits) - 1)
    order = (hashes & ~late) | (late - np.arange(n, dtype=np.uint64))
    least, width = order, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: n - window + 1], least[window - width :])
    return (late - (least & late)).astype(np.int64)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash of each window (the last of equal ones). In a stretch of equal hashes one place for a window is kept."""
    return _thinned(hashes, _places(hashes, window), window)


def _places(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash of each window (the last of equal ones)."""
    return np.unique(_least(hashes, min(window, len(hashes)))) if len(hashes) else np.empty(0, np.int64)


def _thinned(hashes: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
    """In a stretch of equal hashes one place for a window is kept."""
    if not len(places):
        return places
    own, window = hashes[places], min(window, len(hashes))
    chained = np.append(False, (own[1:] == own[:-1]) & (np.diff(places) < window))
    head = places[np.maximum.accumulate(np.where(chained, 0, np.arange(len(places))))]
    turn = (places - head) // window
    return places[~chained | np.append(True, turn[1:] != turn[:-1])]


def _key(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text)"""
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def _again(words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Runs of a document's passages that it has had before."""
    passages = W.grams(words, min_words)
    order = np.argsort(passages, kind="stable")
    later = order[1:][passages[order[1:]] == passages[order[:-1]]]
    return union([(s, s + min_words) for s in later.tolist()])


def _fingerprints(docs: DataFrame, min_words: int) -> DataFrame:
    """(fp, key, start, end): the distinct window minima of each text; without a fp, runs of passages that stood in it before."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, keys = frame["text"].tolist(), frame["key"].tolist()
            for a, b in slices(texts, 500_000):
                found = W.words(texts[a:b])
                lines = W.grams(found.hashes, LINE_WORDS)
                fps, owner, runs, at = [], [], [], 0
                for i, n in enumerate(found.counts.tolist(), a):
                    if n >= LINE_WORDS + WINDOW - 1:
                        own = lines[at : at + n - LINE_WORDS + 1]
                        places = _places(own, WINDOW)
                        fps.append(np.unique(own[_thinned(own, places, WINDOW)]))
                        owner.append(np.full(len(fps[-1]), i))
                        if len(fps[-1]) < len(places):
                            runs += [(keys[i], *r) for r in _again(found.hashes[at : at + n], min_words)]
                    at += n
                if fps:
                    yield pd.DataFrame({"fp": pd.array(np.concatenate(fps).view(np.int64), "Int64"), "key": frame["key"].to_numpy()[np.concatenate(owner)]}).assign(start=None, end=None)
                if runs:
                    yield pd.DataFrame(runs, columns=["key", "start", "end"]).assign(fp=None)

    return _key(docs).where("text IS NOT NULL").select("key", "text").mapInPandas(run, "fp long, key long, start int, end int")


def _shared(rows: DataFrame) -> DataFrame:
    """(key, fps): each document's fingerprints that others have, too, and over how many parts these are dealt."""
    rows = rows.where("fp IS NOT NULL").select("fp", "key")
    shared = rows.groupBy("fp").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n")).where("low <> high")
    shared = shared.select("fp", F.ceil(F.col("n") / PLENTY).cast("int").alias("parts"))
    return rows.join(shared, "fp").groupBy("key").agg(F.collect_list(F.struct("fp", "parts")).alias("fps"))


def _passages(rows: DataFrame, min_words: int) -> DataFrame:
    """(fp, part, salts, salt, known, doc_id, key, starts, hashes): the passages of each document by their least line; known: it has a doc_id.

    The passages of a fingerprint of many documents are dealt to parts by their hash, and the documents of each part to as many salts.
    """

    def of_text(key: int, own: np.ndarray, fps: np.ndarray, parts: np.ndarray) -> Iterator[tuple]:
        if len(own) < min_words:
            return
        lines, passages = W.grams(own, LINE_WORDS), W.grams(own, min_words)
        fp = lines[_least(lines, min_words - LINE_WORDS + 1)]
        order = np.argsort(fps)
        fps, parts = fps[order], parts[order]
        at = np.minimum(np.searchsorted(fps, fp), len(fps) - 1)
        where = np.flatnonzero(fps[at] == fp)
        part = (passages[where] % parts[at[where]].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((part, at[where]))
        where, part, group = where[order], part[order], at[where][order]
        ends = np.flatnonzero(np.append((np.diff(group) != 0) | (np.diff(part) != 0), True)) + 1 if len(where) else []
        a = 0
        for b in ends:
            salts = int(parts[group[a]])
            yield int(fps[group[a]].view(np.int64)), int(part[a]), salts, key % salts, where[a:b].astype("<i4").tobytes(), passages[where[a:b]].astype("<u8").tobytes()
            a = b

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at, to in slices(frame["text"].tolist(), 500_000):
                part, out = frame.iloc[at:to], []
                for known, doc_id, key, own, fps in zip(part["known"].tolist(), part["doc_id"].tolist(), part["key"].tolist(), W.words(part["text"].tolist()).of_texts(), part["fps"], strict=True):
                    shared = np.array([f["fp"] for f in fps], np.int64).view(np.uint64), np.array([f["parts"] for f in fps])
                    out += [(*r[:4], known, doc_id, key, *r[4:]) for r in of_text(key, own, *shared)]
                yield pd.DataFrame(out, columns=["fp", "part", "salts", "salt", "known", "doc_id", "key", "starts", "hashes"])

    texts = rows.select(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "key", "text", "fps")
    return texts.mapInPandas(run, "fp long, part int, salts int, salt int, known boolean, doc_id long, key long, starts binary, hashes binary")


def _groups(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[list[tuple]]:
    """Of each frame the rows, as (whether a group of fp, part and salt begins, that group, starts, hashes, the other columns)."""
    group = None
    for frame in frames:
        out = []
        for fp, part, salt, starts, hashes, *rest in zip(*(frame[c].tolist() for c in ("fp", "part", "salt", "starts", "hashes", *columns)), strict=True):
            now = (fp, part, salt)
            out.append((now != group, now, starts, np.frombuffer(hashes or b"", "<u8").tolist(), *rest))
            group = now
        yield out


def _later(starts: bytes, hashes: list[int], first: dict[int, int], key: int, min_words: int) -> list[tuple[int, int]]:
    """Runs of a document's passages whose first document is another one."""
    return union([(s, s + min_words) for s, h in zip(np.frombuffer(starts, "<i4").tolist(), hashes, strict=True) if first[h] != key])


def _repeats(passages: DataFrame, min_words: int) -> DataFrame:
    """(key, start, end): runs of passages that an earlier document has.

    A group without salts is read once, by document. A salted one is read twice: first for each passage's first document under every
    salt, of which the least is taken where there are several, then with these.
    """

    def once(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: dict[int, int] = {}
        for rows in _groups(frames, ["salts", "known", "doc_id", "key"]):
            runs, firsts = [], []
            for begins, (fp, part, _), starts, hashes, salts, known, doc_id, key in rows:
                if begins:
                    first = {}
                fresh = dict.fromkeys((h for h in hashes if h not in first), key)
                first |= fresh
                if salts > 1:
                    firsts += [(key, fp, part, salts, h, known, doc_id) for h in fresh]
                else:
                    runs += [(key, a, b) for a, b in _later(starts, hashes, first, key, min_words)]
            yield pd.DataFrame(runs, columns=["key", "start", "end"]).assign(fp=None, part=None, salts=None, hash=None, known=None, doc_id=None)
            out = pd.DataFrame(firsts, columns=["key", "fp", "part", "salts", "hash", "known", "doc_id"])
            yield out.assign(start=None, end=None, hash=out["hash"].to_numpy(np.uint64).view(np.int64))

    def again(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: dict[int, int] = {}
        for rows in _groups(frames, ["hash", "key"]):
            runs = []
            for begins, _, starts, hashes, own, key in rows:
                if begins:
                    first = {}
                if starts is None:
                    first[int(own) & (1 << 64) - 1] = key
                else:
                    first |= dict.fromkeys((h for h in hashes if h not in first), key)
                    runs += [(key, a, b) for a, b in _later(starts, hashes, first, key, min_words)]
            yield pd.DataFrame(runs, columns=["key", "start", "end"])

    place = ["fp", "part", "salt"]
    passages = materialize(passages, "winnow-passages")
    ordered = passages.repartition(*place).sortWithinPartitions(*place, "known", "doc_id", "key")
    step = materialize(ordered.mapInPandas(once, "key long, start int, end int, fp long, part int, salts int, hash long, known boolean, doc_id long"), "winnow-first")
    runs, firsts = step.where("hash IS NULL").select("key", "start", "end"), step.where("hash IS NOT NULL")
    if firsts.isEmpty():
        return runs
    least = F.min(F.struct("known", "doc_id", "key"))
    # a passage of one salt alone is settled there
    known = firsts.groupBy("fp", "part", "hash").agg(least["key"].alias("key"), F.max("salts").alias("salts"), F.count("*").alias("n")).where("n > 1")
    known = known.select("fp", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "hash", "key")
    rows = known.unionByName(passages.where("salts > 1").select(*place, "starts", "known", "doc_id", F.lit(0).cast("long").alias("hash"), "hashes", "key"), allowMissingColumns=True)
    ordered = rows.repartition(*place).sortWithinPartitions(*place, F.col("starts").isNotNull(), "known", "doc_id", "key")
    return runs.unionByName(ordered.mapInPandas(again, "key long, start int, end int"))


def union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, runs) of documents with runs to delete; key is xxhash64(doc_id, text), a run is (start, end) in words."""
    if min_words < LINE_WORDS + WINDOW - 1:
        raise ValueError("runs so short needn't hold a fingerprint")
    rows = materialize(_fingerprints(docs, min_words), "winnow")
    shared = materialize(_shared(rows), "winnow-shared")
    texts = with_rows_of(_key(docs), shared.select("key"), "key").dropDuplicates(["key"])
    own = rows.where("fp IS NULL").select("key", "start", "end").distinct()  # of rows repeated as a whole
    runs = _repeats(_passages(texts.join(shared, "key"), min_words), min_words).unionByName(own)

    def together(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            joined = [[{"start": a, "end": b} for a, b in union([(r["start"], r["end"]) for r in own])] for own in frame["runs"]]
            yield pd.DataFrame({"key": frame["key"], "runs": joined})

    return runs.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("runs")).mapInPandas(together, "key long, runs array<struct<start:int,end:int>>")


def cut(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without these runs of words; what stood on two lines stays so."""
    found = W.words([text])
    raw = text.encode(errors="surrogatepass")
    out, at = [], 0
    for start, end in runs:
        left = raw[at : int(found.starts[start])]
        stop = int(found.starts[end]) if end < len(found.starts) else len(raw)
        out.append(left)
        if end < len(found.starts) and b"\n" in raw[int(found.starts[start]) : stop] and left and not left.endswith(b"\n"):
            out.append(b"\n")
        at = stop
    return b"".join([*out, raw[at:]]).decode(errors="surrogatepass")


def drop_repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their repeated runs; one of which no word is left goes. Column n_chars, if any, follows the text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in slices(frame["text"].tolist()):
                part = frame.iloc[a:b]
                left = [cut(t, [(r["start"], r["end"]) for r in runs]) for t, runs in zip(part["text"], part["runs"], strict=True)]
                yield pd.DataFrame({"key": part["key"], "left": left})

    runs = materialize(repeated_runs(docs, min_words), "winnow-runs")
    hit = with_rows_of(_key(docs).select("key", "text"), runs.select("key"), "key").dropDuplicates(["key"])
    key, rest = fresh(docs, "key", "left")
    left = materialize(hit.join(runs, "key").select("key", "text", "runs").mapInPandas(run, "key long, left string"), "winnow-left").toDF(key, rest)
    joined = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(left, key, "left").where(F.col(rest).isNull() | F.col(rest).rlike("[^\\x20\\x09-\\x0D]"))
    changed = {"text": F.coalesce(rest, "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(rest).isNull(), F.col("n_chars")).otherwise(F.length(rest))
    return joined.select(*(changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(c) for c in docs.columns))


def query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    runs = repeated_runs(docs)
    rows = _key(docs).select("doc_id", "key").join(runs, "key", "left")
    deleted = F.expr("aggregate(runs, 0L, (n, r) -> n + r.end - r.start)")
    return rows.select("doc_id", F.coalesce(F.size("runs"), F.lit(0)).alias("n_runs"), F.coalesce(deleted, F.lit(0).cast("long")).alias("n_deleted_words"), F.coalesce("runs", F.array().cast("array<struct<start:int,end:int>>")).alias("runs"))
