"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit set where over half of its features' 64-bit hashes have it set. Every one of 64 places gets a
non-zero vector of ``radius`` + 1 bits; a mask for each such vector v keeps the places whose own vector has an odd
product with v. Any ``radius`` places are orthogonal to some v, so two fingerprints that differ there at most are equal under
one mask at least: no pair within the radius is lost. A bucket with more than LIMIT fingerprints is split by the same
construction over the places that its mask leaves out, until buckets are small by construction; nothing is dropped.

``fingerprints`` and ``classes`` link texts by the fingerprints' distance alone. ``near_duplicates`` takes the pairs that fingerprints link, confirms them by the
Jaccard similarity of five-word shingles, and adds the pairs so similar that fingerprints miss by an exact join on prefixes of the shingles.

Defined cases: a text without words (null, too) has the fingerprint zero and links like any other; null doc_ids count as
greater than any; repeated rows stay repeated; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import operator
import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm import words as W
from spanweave.llm.common import documents, fresh, materialize, ranges, slices
from spanweave.llm.graph import components

QUERY = "op2_simhash_near_dedup"
ORACLE_SQL = None  # bitwise majorities over XXH64 are no DuckDB SQL; tests compare with brute force
SEED = 42
RADIUS = 2
WORDS = 3
#: Fingerprints of a bucket that are compared with each other in memory.
LIMIT = 64
#: A mask that leaves out so few places need not be refined.
OPEN = 16


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of texts with so many of the hashes each."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    n = counts[some]
    blocks = -(-n // 255)  # sums of at most 255 ones fit a byte
    first = np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = np.repeat(np.cumsum(n) - n, blocks) + 255 * (np.arange(len(first)) - first)
    texts = np.cumsum(blocks) - blocks
    for k in range(8):
        lanes = hashes >> np.uint64(k) & np.uint64(0x0101010101010101)
        sums = np.add.reduceat(lanes, at).view(np.uint8).reshape(-1, 8).astype(np.int64)
        sums = np.add.reduceat(sums, texts, axis=0)
        for j in range(8):
            out[some] |= (2 * sums[:, j] > n).astype(np.uint64) << np.uint64(8 * j + k)
    return out


def shingle_hashes(text: str, size: int) -> list[int]:
    """XXH64 of every shingle of a text, repeats included."""
    tokens = text.encode().lower().split()  # of bytes: A-Z only, and the six white space characters of ASCII
    if len(tokens) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)] if tokens else []
    line, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    return [digest(line[a:b], SEED) for a, b in zip((ends - lengths)[: 1 - size or None].tolist(), ends[size - 1 :].tolist(), strict=True)]


def _of_shingles(texts: list[str], size: int) -> np.ndarray:
    found = [shingle_hashes(text, size) for text in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return majority(np.fromiter((h for x in found for h in x), np.uint64, int(counts.sum())), counts)


def fingerprints(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """doc_id, node (a hash of the text) and fp, of shingles of so many words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            parts = [_of_shingles(texts[a:b], size) for a, b in slices(texts)]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "node": frame["node"], "fp": np.concatenate([np.empty(0, np.uint64), *parts]).view(np.int64)})

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    return texts.mapInPandas(run, "doc_id long, node long, fp long")


@lru_cache(maxsize=None)
def _vectors(radius: int, n: int) -> tuple[int, ...]:
    """Non-zero vectors of radius + 1 bits for n places, such that no mask keeps few places."""
    every = range(1, 1 << (radius + 1))
    if n >= len(every):
        return tuple(i % len(every) + 1 for i in range(n))
    rng = random.Random(n)
    tries = [tuple(rng.sample(every, n)) for _ in range(50)]
    return max(tries, key=lambda t: min(sum((x & v).bit_count() & 1 for x in t) for v in every))


def masks(radius: int, places: np.ndarray) -> list[int]:
    """The covering masks over some of the 64 places."""
    if radius > 6:
        raise ValueError("a radius over 6 needs more masks than are practical")
    own = _vectors(radius, len(places))
    return [sum(1 << int(p) for x, p in zip(own, places, strict=True) if (x & v).bit_count() & 1) for v in range(1, 1 << (radius + 1))]


def _spread(rows: DataFrame, radius: int) -> DataFrame:
    """(mask, key, fp) for (mask, fp): each fingerprint under the masks that refine its own."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for mask, fps in frame.groupby("mask")["fp"]:
                fps = fps.to_numpy()
                open_places = np.array([p for p in range(64) if not int(mask) >> p & 1])
                for finer in masks(radius, open_places):
                    value = np.array([finer | (int(mask) & (1 << 64) - 1)], np.uint64).view(np.int64)[0]
                    yield pd.DataFrame({"mask": value, "key": fps & value, "fp": fps})

    return rows.mapInPandas(run, "mask long, key long, fp long")


def _close_pairs(fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the radius, nearest first, of fingerprints that are few or differ at few places."""
    own = fps.view(np.uint64)  # of signed values numpy counts the bits of the absolute value
    if len(own) <= LIMIT:
        distance = np.bitwise_count(own[:, None] ^ own[None, :])
        a, b = np.nonzero(np.triu(distance <= radius, 1))
        order = np.argsort(distance[a, b], kind="stable")
        yield a[order], b[order]
        return
    every = int(np.bitwise_or.reduce(own ^ own[0]))
    places = [p for p in range(64) if every >> p & 1]
    corner = sum((own >> np.uint64(p) & np.uint64(1)).astype(np.int64) << i for i, p in enumerate(places))
    at = np.full(1 << len(places), -1, np.int64)
    at[corner] = np.arange(len(own))
    for size in range(1, radius + 1):
        for flipped in itertools.combinations(range(len(places)), size):
            other = at[corner ^ sum(1 << i for i in flipped)]
            a = np.flatnonzero(other > np.arange(len(own)))
            yield a, other[a]


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a minimum spanning forest of the fingerprints within the radius, as index pairs."""
    root = np.arange(len(fps))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    edges = []
    for a, b in _close_pairs(fps, radius):
        apart = root[a] != root[b]
        for i, j in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            x, y = find(i), find(j)
            if x != y:
                root[max(x, y)] = min(x, y)
                edges.append((i, j))
    return edges


def _too_large(mask: int, size: int) -> bool:
    """Whether a bucket is to be split further; one that leaves out OPEN places has 2 ** OPEN fingerprints at most."""
    return size > LIMIT and 64 - (mask & (1 << 64) - 1).bit_count() > OPEN


def _compare(rows: DataFrame, radius: int) -> DataFrame:
    """(u, v, mask): links within buckets; those of buckets too large come back as (fp, null, mask)."""

    def closed(mask: np.ndarray, fps: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
        ends = np.cumsum(sizes)
        twos = (ends - sizes)[sizes == 2]
        for i in twos[np.bitwise_count((fps[twos] ^ fps[twos + 1]).view(np.uint64)) <= radius].tolist():
            yield int(fps[i]), int(fps[i + 1]), 0
        for end, size in zip(ends[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            own = fps[end - size : end]
            if _too_large(int(mask[end - 1]), size):
                yield from ((x, None, int(mask[end - 1])) for x in own.tolist())
            else:
                yield from ((int(own[a]), int(own[b]), 0) for a, b in forest(own, radius))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = np.empty((3, 0), np.int64)
        overfull = None  # mask and key of a bucket that is known to be too large already
        for frame in frames:
            now = np.concatenate([rest, frame[["mask", "key", "fp"]].to_numpy().T], axis=1)
            out = []
            if overfull is not None:
                same = int(np.argmin(np.append((now[0] == overfull[0]) & (now[1] == overfull[1]), False)))
                out += [(x, None, overfull[0]) for x in now[2, :same].tolist()]
                now = now[:, same:]
            starts = np.flatnonzero(np.append(True, (np.diff(now[0]) != 0) | (np.diff(now[1]) != 0))) if now.shape[1] else np.empty(0, np.int64)
            last = int(starts[-1]) if len(starts) else 0
            if now.shape[1]:
                overfull = None
            out += closed(now[0], now[2], np.diff(starts)) if len(starts) > 1 else []
            rest = now[:, last:]
            if rest.shape[1] and _too_large(int(rest[0, 0]), rest.shape[1]):
                overfull = (int(rest[0, 0]), int(rest[1, 0]))
                out += [(x, None, overfull[0]) for x in rest[2].tolist()]
                rest = rest[:, :0]
            yield _edges(out)
        yield _edges(list(closed(rest[0], rest[2], np.array([rest.shape[1]]))) if rest.shape[1] else [])

    return rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInPandas(run, "u long, v long, mask long")


def _edges(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.array([r[i] for r in rows], dtype="Int64") for i, c in enumerate(("u", "v", "mask"))})


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) that join all distinct fingerprints within the radius: a spanning forest of every bucket, not all of its pairs."""
    todo = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    found = None
    while True:
        step = materialize(_compare(_spread(todo, radius), radius), "simhash-links")
        own = step.where("v IS NOT NULL").select("u", "v")
        found = own if found is None else found.unionByName(own)
        todo = step.where("v IS NULL").select("mask", F.col("u").alias("fp")).distinct()
        if todo.isEmpty():
            return found


def classes(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """component_id, the smallest doc_id reachable by links within the radius, for (doc_id, fp) rows of a written table."""
    first = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-first")
    roots = components(links(first, radius))
    named = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(named.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp")


# ---- confirmed by the texts' five-word shingles, for cleaning a corpus ----

SIMILARITY = 0.8
SHINGLE = 5
#: Every so many texts are sampled for common shingles: those that so many of the sample have, and the most common so many of them.
COMMON_SAMPLE = 16
COMMON_SEEN = 3
MAX_COMMON = 1_000_000
#: Comparisons with one text of each key before all pairs of different classes are compared.
ROUNDS = 2


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of the sets of SHINGLE-word shingles; a shorter text is one shingle, one without words equals its like only."""
    x, y = (np.unique(W.grams(h, min(SHINGLE, max(1, len(h))))) for h in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def _shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; zero for one without words."""
    sets = (np.unique(W.grams(h, min(SHINGLE, max(1, len(h))))) for h in W.words(texts, lower=True).of_texts())
    return [x if len(x) else np.zeros(1, np.uint64) for x in sets]


def _common(texts: DataFrame) -> np.ndarray:
    """Shingles that stand in many texts, told from every COMMON_SAMPLE-th text. They only order a text's shingles: any order is exact."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = frame["text"].tolist()
            for a, b in slices(own):
                keys, n = np.unique(np.concatenate(_shingle_sets(own[a:b])), return_counts=True)
                yield pd.DataFrame({"key": keys.view(np.int64), "n": n})

    counts = texts.where(F.pmod("node", F.lit(COMMON_SAMPLE)) == 0).mapInPandas(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= COMMON_SEEN).orderBy(F.desc("n"), "key").limit(MAX_COMMON).select("key").toPandas()
    return np.sort(found["key"].to_numpy(np.int64).view(np.uint64))


def _prefixes(texts: DataFrame, similarity: float) -> DataFrame:
    """(key, node, size, pos): of each text's shingles, common ones last, the first ones; two texts so similar share one of them at least."""
    shared = texts.sparkSession.sparkContext.broadcast(_common(texts))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = np.append(shared.value, np.uint64(2**64 - 1))
        for frame in frames:
            own, nodes = frame["text"].tolist(), frame["node"].to_numpy()
            for a, b in slices(own):
                sets = _shingle_sets(own[a:b])
                sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
                last = common[np.searchsorted(common, every)] == every
                every = every[np.argsort(2 * owner + last, kind="stable")]
                pos = np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                keep = pos <= (sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64))[owner]
                yield pd.DataFrame({"key": every[keep].view(np.int64), "node": nodes[a:b][owner[keep]], "size": sizes[owner[keep]], "pos": pos[keep]})

    return texts.mapInPandas(run, "key long, node long, size int, pos int")


def _not_alone(rows: DataFrame) -> DataFrame:
    """Rows whose key others have, too."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, before = None, None  # the last row so far, and the key of the one before it
        for frame in frames:
            now = frame if held is None else pd.concat([held, frame])
            if len(now):
                keys = now["key"].to_numpy()
                same = keys[1:] == keys[:-1]
                keep = np.append(same, False) | np.append(before is not None and before == keys[0], same)
                yield now.iloc[:-1][keep[:-1]]
                held, before = now.iloc[-1:], keys[-2] if len(keys) > 1 else before
        if held is not None and before is not None and before == held["key"].iloc[0]:
            yield held

    return rows.repartition("key").sortWithinPartitions("key").mapInPandas(run, rows.schema)


def _confirm(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of (u, v) of text hashes, those whose texts are so similar."""
    rows = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("a")), "u").join(texts.select(F.col("node").alias("v"), F.col("text").alias("b")), "v")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at, to in ranges(map(operator.add, map(len, frame["a"]), map(len, frame["b"])), 2_000_000):
                part = frame.iloc[at:to]
                own, other = (W.words(part[c].tolist(), lower=True).of_texts() for c in ("a", "b"))
                good = np.fromiter((jaccard(x, y) >= similarity for x, y in zip(own, other, strict=True)), bool, len(own))
                yield part.loc[good, ["u", "v"]]

    return rows.select("u", "v", "a", "b").mapInPandas(run, "u long, v long")


def _by_fingerprint(keyed: DataFrame) -> DataFrame:
    """(u, v) of text hashes: what joins all texts whose fingerprints link, by one text of each fingerprint."""
    rows = materialize(fingerprints(keyed.withColumn("doc_id", F.col("node"))).select("node", "fp").distinct(), "near-fingerprints")
    first = materialize(rows.groupBy("fp").agg(F.min("node").alias("first")), "near-first")
    equal = rows.join(first, "fp").where("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v"))
    ends = (first.select(F.col("fp").alias(c), F.col("first").alias(f"_{c}")) for c in ("u", "v"))
    linked = links(first.select("fp"))
    for end, c in zip(ends, ("u", "v"), strict=True):
        linked = linked.join(end, c)
    return equal.unionByName(linked.select(F.col("_u").alias("u"), F.col("_v").alias("v"))).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root): classes of distinct texts, by their hashes, for those not alone.

    Two texts are linked if the Jaccard similarity of their five-word shingles is high enough. SimHash comes first: pairs that its fingerprints link and
    the shingles confirm make the first classes. Its radius misses many pairs, so a join by prefixes and places finds the rest, all such pairs that
    aren't yet of one class. Texts with a key in common are first compared with one of them, ROUNDS times, then with all that aren't yet in their class.
    """
    keyed = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    rows = materialize(_not_alone(_prefixes(keyed.dropDuplicates(["node"]), similarity)), "near-keys")
    texts = materialize(keyed.join(rows.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "near-texts")
    found = materialize(_confirm(materialize(_by_fingerprint(keyed), "near-linked"), texts, similarity), "near-by-fingerprint")
    roots = components(found)
    for k in range(ROUNDS + 1):
        named = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("turn"), "node", "size", "pos", "root")).alias("b"))
        mixed = mixed.where("low <> high").select("key", "b")
        own = named.join(mixed, "key").select("key", F.struct("node", "size", "pos", "root").alias("a"), "b") if k < ROUNDS else _all_of(named, mixed.select("key"))
        overlap = F.least(F.expr("a.size - a.pos"), F.expr("b.size - b.pos")) >= similarity / (1 + similarity) * F.expr("a.size + b.size") - 1e-9
        pairs = own.where((F.col("a.root") != F.col("b.root")) & overlap).select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()
        good = materialize(_confirm(materialize(pairs, "near-pairs"), texts, similarity), "near-confirmed")
        found = found.unionByName(good)
        roots = components(found)
    return roots


def _all_of(named: DataFrame, keys: DataFrame) -> DataFrame:
    """(a, b): all pairs of the rows of one key, for some keys, that are of two classes."""
    rows = materialize(named.join(keys, "key"), "near-mixed").select("key", F.struct("node", "size", "pos", "root").alias("a"))
    other = rows.select(F.col("key").alias("other"), F.col("a").alias("b"))
    return rows.join(other, (F.col("key") == F.col("other")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root"))).select("a", "b")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class: that with the smallest doc_id (null last), one row of it.

    Texts without words are one class; of rows repeated as a whole one stays; an empty table stays empty; all columns are kept.
    """
    (node,) = fresh(docs, "node")
    rows = docs.withColumn(node, F.xxhash64(F.coalesce("text", F.lit(""))))
    ids = materialize(rows.groupBy("doc_id", F.col(node).alias("node")).agg(F.count("*").alias("n_rows")), "simhash-ids")
    named = ids.join(near_duplicates(docs, similarity), "node", "left").withColumn("root", F.coalesce("root", "node"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    least = named.groupBy("root").agg(F.min(place).alias("best"), F.count("*").alias("n")).where("n > 1")
    lost = named.join(least, "root").where(place != F.col("best")).select(F.col("doc_id").alias("lost_id"), F.col("node").alias("lost_node"))
    kept = rows.join(lost, (rows[node] == lost["lost_node"]) & rows["doc_id"].eqNullSafe(lost["lost_id"]), "left_anti")
    if not ids.where("n_rows > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", node])
    return kept.select(*docs.columns)


def query(spark, sf_dir):
    rows = materialize(fingerprints(documents(spark, sf_dir)).select("doc_id", "fp"), "simhash-fingerprints")
    return classes(rows).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
