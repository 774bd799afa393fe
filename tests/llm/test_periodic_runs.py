import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanweave.llm import periodic_runs as d
from spanweave.llm import words as W


def brute(words, fold=4, least=6):
    """(start, length, period) by extending every pair of neighbours of every period; the least period of a stretch counts."""
    found = {}
    for p in range(1, len(words) // fold + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, fold * p):
                found.setdefault((i, j + p), p)
            i = j
    return sorted((s, e - s, p) for (s, e), p in found.items())


def digest(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{p}\n" for s, n, p in runs), " ".join(w for i, w in enumerate(words) if i not in dropped))]
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)


def expected(doc_id, text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return (doc_id, *digest(words, brute(words)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 4), st.integers(2, 6))
def test_runs_equal_brute_force(values, fold, least):
    words = [b"abc"[v : v + 1] for v in values]
    hashes = W.words([b" ".join(words).decode()]).hashes
    runs = list(d.runs_of([words], [d.candidates(hashes, fold)], fold, least))[0]
    assert [tuple(r) for r in zip(*(x.tolist() for x in runs), strict=True)] == brute(words, fold, least)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=2, max_size=50))
def test_extensions_equal_direct_comparison(values):
    found = d.Extensions(np.array(values))
    pairs = [(i, j) for i in range(len(values) + 1) for j in range(len(values) + 1) if i != j]
    want = [next((k for k in range(len(values)) if max(i, j) + k >= len(values) or values[i + k] != values[j + k]), 0) for i, j in pairs]
    assert found.of(*(np.array(x) for x in zip(*pairs, strict=True))).tolist() == want


def test_the_grid_in_pieces_is_the_same(monkeypatch):
    whole = [np.concatenate(x) for x in zip(*d.grid(500), strict=True)]
    monkeypatch.setattr(d, "PAIRS", 100)
    parts = list(d.grid(500))
    assert len(parts) > 5 and all((np.concatenate(x) == y).all() for x, y in zip(zip(*parts, strict=True), whole, strict=True))


def test_digests_equal_brute_force(spark):
    rnd = random.Random(3)
    texts = [None, "", " \t\n", "x", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 3 + "a", "ab ab  ab\nab\x0bab ab", "Straße é é é é é é é ü ", "w " * 3000]
    for _ in range(150):
        words = [f"w{rnd.randrange(rnd.choice((2, 5, 1000)))}" for _ in range(rnd.randrange(120))]
        for _ in range(rnd.randrange(3)):
            at, size = rnd.randrange(len(words) + 1), rnd.randrange(1, 9)
            words[at:at] = words[at : at + size] * rnd.randrange(2, 9)
        texts.append(" ".join(words))
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(7, texts[7], "x", 1), (None, "a b " * 5, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, w int").repartition(3)
    out = d.digests(d.with_runs(d.planted(docs)))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, out.collect()), key=key) == sorted((expected(r[0], r[1]) for r in rows), key=key)
    assert sum(r.n_runs for r in out.collect()) > 100
    assert out.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"), ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    kept = d.with_runs(docs)
    assert kept.columns == ["doc_id", "text", "start", "w", "runs", "collapsed"] and kept.where("start = 'x' AND w = 1").count() == len(rows) - 1
    assert d.with_runs(docs.where(F.lit(False))).count() == 0
    with pytest.raises(ValueError, match="collapsed"):
        d.with_runs(docs.withColumn("Collapsed", F.lit(1)))


def test_a_very_long_text(spark):
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(50_000)}" for _ in range(300_000)]
    words[1000:1000] = ["p", "q", "r"] * 50_000
    words[400_000:400_000] = words[:70] * 5
    row = d.with_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [(r.start, r.length, r.period) for r in row.runs] == [(1000, 150_000, 3), (400_000, 350, 70)]
    assert len(row.collapsed.split()) == len(words) - (150_000 - 3) - 280


def test_query_reads_every_document(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    small = {r.doc_id: r.text for r in docs if r.text is None or len(r.text) < 4000}
    got = {r.doc_id: tuple(r) for r in d.query(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    assert all(got[i] == expected(i, t) for i, t in small.items())
