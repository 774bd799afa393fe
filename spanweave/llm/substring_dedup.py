"""Repeated substrings of words removed by recompression.

A text is compressed level by level: runs of one symbol become a symbol, then every pair of a left and a right symbol, sides being drawn by a bit of
the symbols' names. A name is a hash of what it stands for, so equal runs and pairs have the same name in all tasks and documents without a dictionary that would
have to be joined to all texts at every level. Of each symbol is kept which words decide that it stands there (``left`` to ``right``); equal words between
them make equal symbols, whatever stands around. So in every window of ``span`` words one high symbol that the window decides alone is the same
wherever the window's words stand: its anchor, that with the greatest name.

Three rounds of Spark, each on what the one before has left, settle which windows repeat:

1. names of anchors are counted over all texts; those that stand once are done;
2. the windows that an anchor has in one place, a span, are compared as a whole by a hash of their words; equal spans repeat;
3. the windows of a span that has no equal are compared one by one, with each other and with those of one of each equal spans of the same anchor.

Copies of a whole text are worked on once and counted. A long text is cut into pieces that overlap by a window less a word, which changes no anchor.

Defined cases: a null text is an empty one; repeated rows are documents of their own, so all their windows repeat; a text shorter than a window is never
changed; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm import words as W
from spanweave.llm.common import documents, fresh, materialize, shuffle_files_removed, slices, with_rows_of
from spanweave.llm.line_dedup import cut

QUERY = "op12_substring_dedup"
SPAN = 35
#: Levels whose symbols of MIN_SIZE words or more are anchors; below, those of the highest level, where a window decides no such symbol.
LOW, TOP = 4, 7
MIN_SIZE = 5
#: Window starts of one piece of a long text.
PIECE = 100_000
_RUN, _LEFT, _RIGHT, _BASE = (np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Symbols(NamedTuple):
    """Names; first word, last word + 1; and those of the words that decide that the symbol stands there. ``text``: which text it is of."""

    names: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    left: np.ndarray
    right: np.ndarray
    text: np.ndarray


def _runs(x: Symbols, words: np.ndarray) -> Symbols:
    """Runs of equal symbols as one symbol. A neighbour is known to be another symbol by its nearest word, if that differs, else by all that decides it."""
    n = len(x.names)
    close = x.text[1:] == x.text[:-1]
    head = np.flatnonzero(np.append(True, ~(close & (x.names[1:] == x.names[:-1]))))
    tail = np.append(head[1:], n) - 1
    size = tail - head + 1
    names = x.names[head]
    many = size > 1
    names[many] = W.mix(names[many] * _RUN + size[many].astype(np.uint64))
    starts, ends = x.starts[head], x.ends[tail]
    left, right = np.minimum(x.left[head], starts - 1), np.maximum(x.right[tail], ends + 1)
    before = head[1:][close[head[1:] - 1]]  # heads with a symbol before them
    alike = before[words[x.starts[before] - 1] == words[x.ends[before] - 1]]
    left[np.searchsorted(head, alike)] = x.left[alike - 1]
    after = tail[:-1][close[tail[:-1]]]
    alike = after[words[x.ends[after]] == words[x.starts[after]]]
    right[np.searchsorted(tail, alike)] = x.right[alike + 1]
    return Symbols(names, starts, ends, left, right, x.text[head])


def _pairs(x: Symbols, level: int) -> Symbols:
    """Each left symbol with a right one after it as one symbol. Others stand alone because of their neighbour on that side."""
    right_side = (x.names >> np.uint64(level % 64) & np.uint64(1)).astype(bool)
    close = x.text[1:] == x.text[:-1]
    merged = ~right_side[:-1] & right_side[1:] & close
    head = np.flatnonzero(np.append(True, ~merged))
    pair = np.append(merged, False)[head]
    tail = head + pair
    names = x.names[head]
    names[pair] = W.mix(names[pair] * _LEFT + x.names[tail[pair]] * _RIGHT)
    left, right = x.left[head], x.right[tail]
    alone = np.flatnonzero(~pair)
    at = head[alone]
    rights, lefts = right_side[at], ~right_side[at]
    i = alone[rights]
    at = head[i]
    near = (at > 0) & np.append(False, close)[at]
    left[i] = np.where(near, x.left[at - 1], x.starts[at] - 1)
    i = alone[lefts]
    at = head[i]
    near = np.append(close, False)[at]
    right[i] = np.where(near, x.right[np.minimum(at + 1, len(x.names) - 1)], x.ends[at] + 1)
    return Symbols(names, x.starts[head], x.ends[tail], left, right, x.text[head])


def levels(words: np.ndarray, text: np.ndarray, span: int = SPAN) -> list[Symbols]:
    """The words, and the symbols of each level up to TOP, as long as so many words decide any."""
    at = np.arange(len(words))
    out = [Symbols(words, at, at + 1, at, at + 1, text)]
    while len(words) and len(out) <= TOP:
        now = _pairs(_runs(out[-1], words), len(out))
        if not (now.right - now.left <= span).any():
            break
        out.append(now)
    return out


def _chosen(found: list[Symbols], windows: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window the symbol with the greatest name, of those of MIN_SIZE words or more that the window decides alone: its name, and a number; -1 where there is none.

    A symbol is decided by the windows of an interval. Symbols are ranked, and the best rank over all intervals spreads from two halves of a power of two.
    """
    if not found:
        return np.zeros(windows, np.uint64), np.full(windows, -1)
    names, starts, ends, left, right = (np.concatenate([getattr(x, c) for x in found]) for c in ("names", "starts", "ends", "left", "right"))
    good = np.flatnonzero((right - left <= span) & (left >= 0) & (ends - starts >= MIN_SIZE))
    names, starts, low, high = names[good], starts[good], np.maximum(right[good] - span, 0), left[good]
    order = np.argsort(-starts, kind="stable")  # of one name the first place is the best
    order = order[np.argsort(names[order], kind="stable")]
    names, starts, low, high = (x[order] for x in (names, starts, low, high))
    rank = np.cumsum(np.append(True, (names[1:] != names[:-1]) | (np.diff(starts) != 0))) if len(names) else np.empty(0, np.int64)
    width = np.frexp(high - low + 1)[1] - 1
    best = np.zeros(windows, np.int64)
    for k in range(int(span).bit_length() - 1, -1, -1):
        if k + 1 < int(span).bit_length():  # what holds for 2 ** (k + 1) windows holds for both halves
            half = best[: windows - (1 << k)].copy()
            np.maximum(best[1 << k :], half, out=best[1 << k :])
        at = np.flatnonzero(width == k)
        if len(at):
            new = np.zeros(windows, np.int64)
            new[low[at]] = rank[at]  # of equal places the last, which is the best
            np.maximum(best, new, out=best)
            new[:] = 0
            new[high[at] - (1 << k) + 1] = rank[at]
            np.maximum(best, new, out=best)
    of_rank = names[np.searchsorted(rank, np.arange(1, rank[-1] + 1))] if len(rank) else names
    return np.append(np.uint64(0), of_rank)[best], best - 1


class Spans(NamedTuple):
    """Neighbouring windows with one anchor: number of the text, first word there, how many windows, the anchor's name, and a hash of their words."""

    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    names: np.ndarray
    hashes: np.ndarray


def _hash_of(words: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that hashes stretches of words, of equal lengths or not."""
    sums = np.append(np.uint64(0), np.cumsum(words * np.cumprod(np.full(len(words), _BASE))))
    back = np.cumprod(np.full(len(words), _INVERSE))
    return lambda a, b: W.mix((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64))


def _pieces(texts: list[np.ndarray], span: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The words of all texts with a window, in pieces; of each piece its text and its first word there."""
    owner, first, parts = [], [], []
    for k, own in enumerate(texts):
        for a in range(0, len(own) - span + 1, PIECE):
            owner.append(k)
            first.append(a)
            parts.append(own[a : a + PIECE + span - 1])
    return parts, np.array(owner, np.int64), np.array(first, np.int64)


def spans(texts: list[np.ndarray], span: int = SPAN) -> Spans:
    """The spans of texts, given as hashes of their words."""
    parts, owner, first = _pieces(texts, span)
    if not parts:
        none = np.empty(0, np.int64)
        return Spans(none, none, none, *2 * [none.astype(np.uint64)])
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    words, piece = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
    begins = np.cumsum(sizes) - sizes
    found = levels(words, piece, span)
    windows = np.flatnonzero(np.arange(len(words)) + span <= np.repeat(begins + sizes, sizes))
    names, anchor = _chosen(found[LOW:], len(words), span)
    todo = windows[anchor[windows] < 0]
    for k in range(min(LOW, len(found)) - 1, -1, -1):
        if not len(todo):
            break
        at = np.searchsorted(found[k].left, todo)
        good = at < len(found[k].left)
        good[good] = found[k].right[at[good]] <= todo[good] + span
        done, at = todo[good], at[good]
        names[done], anchor[done] = found[k].names[at], -2 - (at * 64 + k)
        todo = todo[~good]
    own = anchor[windows]
    head = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (np.diff(windows) != 1)))
    size = np.diff(np.append(head, len(windows)))
    start = windows[head]
    hashes = _hash_of(words)(start, start + size + span - 1)
    return Spans(owner[piece[start]], start - begins[piece[start]] + first[piece[start]], size, names[start], hashes)


def _node(text: Column) -> tuple[Column, Column]:
    """Two hashes that name a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _texts(docs: DataFrame) -> DataFrame:
    """(a, b, text)"""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*(h.alias(n) for h, n in zip(_node(text), "ab", strict=True)), text.alias("text"))


def _anchors(texts: DataFrame, span: int) -> DataFrame:
    """(name, a, b, n): how often each anchor stands in a text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own, nodes = frame["text"].tolist(), frame[["a", "b"]].to_numpy()
            for a, b in slices(own, 1_000_000):
                found = spans(W.words(own[a:b]).of_texts(), span)
                order = np.lexsort((found.names, found.text))
                text, names = found.text[order], found.names[order]
                head = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (names[1:] != names[:-1]))) if len(text) else []
                node = nodes[a:b][text[head]]
                yield pd.DataFrame({"name": names[head].view(np.int64), "a": node[:, 0], "b": node[:, 1], "n": np.diff(np.append(head, len(text)))})

    return texts.mapInPandas(run, "name long, a long, b long, n int")


def _candidates(docs: DataFrame, span: int) -> DataFrame:
    """(id, a, b, text, copies, names): each text with anchors that stand elsewhere, too, and which these are. A written table."""
    texts = _texts(docs)
    rows = materialize(_anchors(texts, span), "anchors")
    shared = rows.groupBy("name").agg(F.sum("n").alias("n")).where("n > 1").select("name")
    hits = materialize(with_rows_of(rows, shared, "name").groupBy("a", "b").agg(F.collect_set("name").alias("names")), "anchor-hits")
    # both sides stay dealt by a and b: by a alone, all texts would be shuffled a second time
    whole = with_rows_of(texts, hits.select("a"), "a").groupBy("a", "b").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return materialize(whole.join(hits, ["a", "b"]).withColumn("id", F.monotonically_increasing_id()), "anchor-texts")


def _shared_spans(texts: DataFrame, span: int) -> DataFrame:
    """(name, hash, id, copies, start, size) of the spans of candidates whose anchor is among the names."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = frame["text"].tolist()
            for a, b in slices(own, 1_000_000):
                part = frame.iloc[a:b]
                found = spans(W.words(own[a:b]).of_texts(), span)
                bounds = np.searchsorted(found.text, np.arange(len(part) + 1))
                keep = [np.isin(found.names[i:j].view(np.int64), np.asarray(x, np.int64)) for i, j, x in zip(bounds[:-1], bounds[1:], part["names"], strict=True)]
                at = np.flatnonzero(np.concatenate(keep))
                of = {c: part[c].to_numpy()[found.text[at]] for c in ("id", "copies")}
                yield pd.DataFrame({"name": found.names[at].view(np.int64), "hash": found.hashes[at].view(np.int64), **of, "start": found.start[at], "size": found.size[at]})

    return texts.select("id", "copies", "text", "names").mapInPandas(run, "name long, hash long, id long, copies int, start int, size short")


def _each_window(texts: DataFrame, span: int) -> DataFrame:
    """(name, window, id, start, own, n) for each window of the spans of (id, text, starts, sizes, names, own); window is a hash of its words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = frame["text"].tolist()
            for a, b in slices(own, 1_000_000):
                part, found = frame.iloc[a:b], W.words(own[a:b])
                start, size, name, alone = (np.concatenate(part[c].tolist()) for c in ("starts", "sizes", "names", "own"))
                text = np.repeat(np.arange(len(part)), part["starts"].str.len())
                turn = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                each = np.repeat(np.arange(len(size)), size)
                at = (start + (np.cumsum(found.counts) - found.counts)[text])[each] + turn
                window = _hash_of(found.hashes)(at, at + span)
                alone = alone.astype(bool)[each]
                yield pd.DataFrame({"name": name[each], "window": window.view(np.int64), "id": part["id"].to_numpy()[text[each]], "start": start[each] + turn, "own": alone, "n": 2 - alone})

    return texts.mapInPandas(run, "name long, window long, id long, start int, own boolean, n short")


def repeated_windows(docs: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(id, a, b, text, copies, names) of texts that may have windows that stand elsewhere, too, and (id, covered): the words that such windows
    cover, as runs that may overlap, each the number 2 ** 32 * start + end; of texts that have any.

    a and b are two hashes that name the text. Windows of one document count as well as those of several.
    """
    if span < 2:
        raise ValueError("a window has two words at least")
    texts = _candidates(docs, span)
    found = materialize(_shared_spans(texts, span), "anchor-spans")
    place = F.xxhash64("id", "start")
    seen = materialize(found.groupBy("name", "hash").agg(F.sum("copies").alias("n"), F.min(place).alias("one")), "anchor-spans-seen")
    own, one = F.col("n") == 1, place == F.col("one")
    named = materialize(found.join(seen, ["name", "hash"]).select("name", "id", "start", "size", own.alias("own"), one.alias("one")), "anchor-spans-named")
    settled = named.where("NOT own").select("id", "start", (F.col("start") + F.col("size") + (span - 1)).alias("end"))
    mixed = with_rows_of(named.where("one"), named.where("own").select("name"), "name")
    listed = mixed.groupBy("id").agg(*(F.collect_list(c).alias(n) for c, n in (("start", "starts"), ("size", "sizes"), ("name", "names"), ("own", "own"))))
    windows = materialize(_each_window(texts.select("id", "text").join(listed, "id"), span), "anchor-windows")
    twice = materialize(windows.groupBy("name", "window").agg(F.sum("n").alias("n")).where("n > 1").select("name", "window"), "anchor-windows-twice")
    single = windows.where("own").join(twice, ["name", "window"], "left_semi").select("id", "start", (F.col("start") + span).alias("end"))
    run = F.shiftleft(F.col("start").cast("long"), 32) + F.col("end")
    # written, so that what it shuffles is gone before texts are shuffled
    return texts, materialize(settled.unionByName(single).groupBy("id").agg(F.collect_list(run).alias("covered")), "anchor-runs")


def _union(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs joined where they overlap or touch."""
    covered = np.sort(covered)
    start, end = covered >> 32, np.maximum.accumulate(covered & 0xFFFFFFFF)
    head = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return start[head], end[np.append(head[1:], len(start)) - 1]


def _left(docs: DataFrame, span: int) -> DataFrame:
    """(a, b, n_removed, left): the texts that change, without the words that repeated windows cover."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in slices(frame["text"].tolist()):
                part = frame.iloc[a:b]
                runs = [_union(c) for c in part["covered"]]
                left = [cut(t, list(zip(start.tolist(), end.tolist(), strict=True))) for t, (start, end) in zip(part["text"], runs, strict=True)]
                yield part[["a", "b"]].assign(n_removed=[int((end - start).sum()) for start, end in runs], left=left)

    with shuffle_files_removed(docs.sparkSession):
        texts, runs = repeated_windows(docs, span)
        left = texts.select("id", "a", "b", "text").join(runs, "id").select("a", "b", "text", "covered").mapInPandas(run, "a long, b long, n_removed long, left string")
        return materialize(left, "without-repeats")


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """The documents without all words that windows cover which stand in two places or more; no place keeps them."""
    a, b, n, rest = fresh(docs, "a", "b", "n_removed", "left")
    left = _left(docs, span).toDF(a, b, n, rest)
    named = docs.withColumns(dict(zip((a, b), _node(F.coalesce("text", F.lit(""))), strict=True)))
    changed = F.coalesce(rest, "text").cast(docs.schema["text"].dataType).alias("text")
    return named.join(left, [a, b], "left").select(*(changed if c == "text" else F.col(c) for c in docs.columns))


def _digest(text: Column) -> tuple[Column, Column]:
    """Number of words, and a hash of them joined by one space."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.size(words).cast("long"), F.sha2(F.array_join(words, " "), 256)


def query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    n_words, sha = _digest(text)
    rows = docs.select("doc_id", *(h.alias(n) for h, n in zip(_node(text), "ab", strict=True)), n_words.alias("n_words"), sha.alias("sha"))
    left = _left(docs, SPAN).select("a", "b", "n_removed", _digest(F.col("left"))[1].alias("kept"))
    joined = rows.join(left, ["a", "b"], "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"))


ORACLE_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
windows AS (
  SELECT r, i, array_to_string(list_slice(words, i, i + 34), ' ') AS w FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM split)),
hit AS (SELECT r, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + k AS i FROM hit, (SELECT unnest(range(35)) AS k)),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n FROM (SELECT r, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM split)
  ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (r)
"""
