import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanweave.llm import line_dedup as d
from spanweave.llm import words as W


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=120), st.integers(1, 20))
def test_every_window_holds_a_fingerprint(values, window):
    h = W.mix(np.array(values, np.uint64) + np.uint64(7))
    places = d.winnow(h, window)
    for a in range(len(h) - window + 1):
        span = set(range(max(0, a - window), a + 2 * window))  # in a stretch of equal hashes the neighbour stands in
        assert span & set(places.tolist())
    if len(set(values)) == len(values):
        assert all(set(range(a, a + window)) & set(places.tolist()) for a in range(len(h) - window + 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab é\n\tÜ.", max_size=30), max_size=6))
def test_words_equal_split(texts):
    found = W.words(texts)
    for text, a in zip(texts, np.split(np.arange(len(found.hashes)), np.cumsum(found.counts)[:-1]) if texts else [], strict=True):
        raw = text.encode()
        assert [raw[found.starts[i] : found.ends[i]] for i in a] == raw.split()
    every = [w for t in texts for w in t.encode().split()]
    assert len(set(found.hashes.tolist())) == len(set(every))


def make(rnd, n):
    return [f"w{rnd.randrange(100_000)}" for _ in range(n)]


def test_later_repeated_runs_are_deleted(spark):
    rnd = random.Random(5)
    passage, short, top = make(rnd, 60), make(rnd, 49), make(rnd, 51)
    a, b = make(rnd, 80) + passage + make(rnd, 40) + short, make(rnd, 33) + passage + make(rnd, 5) + short + make(rnd, 3)
    texts = [" ".join(a), " ".join(b), " ".join(top + make(rnd, 30)), " ".join(make(rnd, 30)) + "\n" + " ".join(top), " ".join(a), None, "", "x", "same word " * 100, "same word " * 120 + " ".join(make(rnd, 9))]
    docs = spark.createDataFrame([(i, t, 0 if t is None else len(t), "r") for i, t in enumerate(texts)] + [(1, texts[1], 0, "r"), (None, "z", 1, "r")], "doc_id long, text string, n_chars long, runs string")
    left = {r.doc_id: r.text for r in d.drop_repeated(docs).collect()}
    assert left[0] == texts[0] and left[2] == texts[2] and left[5] is None and left[6] == "" and left[8].split() == ["same", "word"] and left[None] == "z"
    assert left[1].split() == b[:33] + b[93:]
    assert left[3].split() == texts[3].split()[:30]
    assert 4 not in left  # a copy has nothing left
    assert left[9].split() == texts[9].split()[-9:] or "same" not in left[9]
    out = d.drop_repeated(docs)
    assert out.columns == docs.columns and out.where("doc_id = 1").count() == 2
    assert out.where("n_chars <> length(text) AND doc_id > 1").count() == 0
    assert d.drop_repeated(docs.where(F.lit(False))).count() == 0


def test_runs_equal_brute_force(spark):
    rnd = random.Random(9)
    passages = [make(rnd, n) for n in (50, 55, 70, 120, 49, 30)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            parts += make(rnd, rnd.randint(0, 60)) + (rnd.choice(passages) if rnd.random() < 0.7 else [])
        if rnd.random() < 0.3:  # a passage that no other text has, twice
            own = make(rnd, 60)
            parts = own + parts + own
        texts.append(parts)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    key = {r.key: r.doc_id for r in docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key")).collect()}
    got = {key[r.key]: {i for x in r.runs for i in range(x.start, x.end)} for r in d.repeated_runs(docs).collect()}
    seen, inside = set(), 0
    for i, t in enumerate(texts):
        want, before = set(), set(seen)
        for a in range(len(t) - 49):
            passage = tuple(t[a : a + 50])
            if passage in seen:
                want |= set(range(a, a + 50))
                inside += passage not in before
            seen.add(passage)
        assert got.get(i, set()) == want, i
    assert inside > 10  # passages that only stood in the same document before


def test_a_short_line_of_an_earlier_document_hides_no_longer_passage(spark, monkeypatch):
    monkeypatch.setattr(d, "PLENTY", 4)
    rnd = random.Random(3)
    lines = [make(rnd, 30) for _ in range(6)]
    texts = [make(rnd, 60) + line + make(rnd, 60) + line + make(rnd, 40) for line in lines]  # each alone, and twice
    for line in lines:
        shared = make(rnd, 12) + line + make(rnd, 12)  # 54 words, hardly more than the line
        other = make(rnd, 30) + line + make(rnd, 30)
        texts += [make(rnd, 40) + shared + make(rnd, 9), make(rnd, 7) + other, make(rnd, 25) + shared + make(rnd, 33), other + shared, make(rnd, 3) + other]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    key = {r.key: r.doc_id for r in docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key")).collect()}
    got = {key[r.key]: {i for x in r.runs for i in range(x.start, x.end)} for r in d.repeated_runs(docs).collect()}
    seen, found = set(), 0
    for i, t in enumerate(texts):
        own = [tuple(t[a : a + 50]) for a in range(len(t) - 49)]
        want = {j for a, w in enumerate(own) if w in seen for j in range(a, a + 50)}
        assert got.get(i, set()) == want, i
        found += bool(want)
        seen |= set(own)
    assert found == 18
