import hashlib
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanweave.llm import substring_dedup as d
from spanweave.llm import words as W

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import oracle  # noqa: E402


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def brute(texts, span):
    """Words of each text that stay."""
    own = [split(t) for t in texts]
    seen = Counter(tuple(w[i : i + span]) for w in own for i in range(len(w) - span + 1))
    out = []
    for w in own:
        gone = {i + k for i in range(len(w) - span + 1) if seen[tuple(w[i : i + span])] > 1 for k in range(span)}
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def named(values):
    return W.mix(np.array(values, np.uint64) + np.uint64(11))


def anchors(values, span):
    """Of each window its anchor's name."""
    found = d.spans([named(values)], span)
    at = np.concatenate([np.arange(a, a + n) for a, n in zip(found.start, found.size, strict=True)]) if len(found.start) else []
    assert list(at) == list(range(max(0, len(values) - span + 1)))
    return np.repeat(found.names, found.size).tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=35, max_size=90), st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=40), st.integers(4, 35))
def test_equal_windows_have_equal_anchors_whatever_stands_around(core, before, after, span):
    alone = anchors(core, span)
    inside = anchors(before + core + after, span)[len(before) : len(before) + len(alone)]
    assert alone == inside


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=120))
def test_symbols_stand_for_their_words_and_are_decided_in_order(values):
    for level in d.levels(named(values), np.zeros(len(values), np.int64), 12):
        assert level.starts.tolist() == [0, *level.ends.tolist()][:-1] if values else True
        content = {}
        for name, a, b in zip(level.names.tolist(), level.starts.tolist(), level.ends.tolist(), strict=True):
            assert content.setdefault(name, values[a:b]) == values[a:b]
        assert (np.diff(level.left) >= 0).all() and (np.diff(level.right) >= 0).all()
        assert (level.left <= level.starts).all() and (level.right >= level.ends).all()


def test_levels_rise():
    rnd = random.Random(1)
    found = d.levels(named([rnd.randrange(1000) for _ in range(20_000)]), np.zeros(20_000, np.int64))
    assert len(found) > 6 and len(found[-1].names) < 4000


def test_a_stretch_has_the_same_hash_wherever_it_stands():
    of = d._hash_of(named([1, 2, 3, 9, 1, 2, 3, 3]))
    at = lambda *x: of(*(np.array([v]) for v in x))[0]
    assert at(0, 3) == at(4, 7) != at(5, 8) and at(2, 3) == at(7, 8) and at(0, 2) != at(0, 3)


def test_pieces_of_a_long_text_give_the_same(monkeypatch):
    rnd = random.Random(2)
    values = [rnd.randrange(30) for _ in range(3000)]
    whole = anchors(values, 35)
    monkeypatch.setattr(d, "PIECE", 100)
    assert anchors(values, 35) == whole


def corpus(rnd):
    def make(n, of=5000):
        return [f"w{rnd.randrange(of)}" for _ in range(n)]

    passages = [make(n) for n in (35, 36, 40, 60, 200, 34, 30)]
    texts = [None, "", "x", " ".join(make(34)), "same " * 300, "a b " * 60, "a b c " * 11 + "a b", "Same  " * 35, "same\n" * 34]
    for _ in range(120):
        words = make(rnd.randrange(150), rnd.choice((3, 5000)))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choice(passages)
        texts.append(" ".join(words))
    near = make(300)
    texts += [" ".join(near)] * 7 + [" ".join(near[:k] + ["other"] + near[k + 1 :]) for k in range(0, 300, 20)]
    texts.append("\n".join(texts[20].split()))  # the same words, another text
    own = make(50)
    texts.append(" ".join(own + make(20) + own + make(20) + own[:34]))
    return texts


@pytest.mark.parametrize("span", [35, 8])
def test_equals_brute_force(spark, span):
    texts = corpus(random.Random(6))
    docs = spark.createDataFrame([(i, t, "q", 1) for i, t in enumerate(texts)], "doc_id long, text string, a string, left int").repartition(3)
    got = {r.doc_id: r for r in d.without_repeats(docs, span).collect()}
    want = brute(texts, span)
    assert [split(got[i].text) for i in range(len(texts))] == want
    assert all(got[i].text == t for i, t in enumerate(texts) if want[i] == split(t))
    assert sum(len(w) < len(split(t)) for w, t in zip(want, texts, strict=True)) > 30
    out = d.without_repeats(docs, span)
    assert out.columns == docs.columns and out.where("a = 'q' AND left = 1").count() == len(texts)


def test_repeated_rows_and_missing_ids(spark):
    rnd = random.Random(7)
    long, other = (" ".join(f"w{rnd.randrange(900)}" for _ in range(40)) for _ in range(2))
    docs = spark.createDataFrame([(1, long), (1, long), (None, other), (2, other + " x"), (None, None), (None, None), (3, "x")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text or "") for r in d.without_repeats(docs).collect()) == [(0, ""), (0, ""), (0, ""), (1, ""), (1, ""), (2, "x"), (3, "x")]
    assert d.without_repeats(docs.where(F.lit(False))).count() == 0
    with pytest.raises(ValueError, match="two words"):
        d.repeated_windows(docs, 1)


def test_a_very_long_text(spark):
    rnd = random.Random(8)
    words = [f"w{rnd.randrange(100_000)}" for _ in range(250_000)]
    words[200_000:200_000] = words[99_970:100_030]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "y " + " ".join(words[5:45]))], "doc_id long, text string")
    got = {r.doc_id: split(r.text) for r in d.without_repeats(docs).collect()}
    assert got[2] == ["y"] and len(got[1]) == len(words) - 120 - 40


def test_query_equals_duckdb(spark):
    sf_dir = "/root/testdata/sf0.001"
    mine, theirs = oracle.both(spark, oracle.connect(sf_dir), d.query, d.ORACLE_SQL, sf_dir)
    assert mine == theirs and len(mine) > 100
    kept = {tuple(sorted(r.asDict().items())) for r in d.query(spark, sf_dir).collect()}
    assert any(dict(r)["n_removed"] > 0 for r in kept)
    assert any(dict(r)["kept_sha256"] == hashlib.sha256(b"").hexdigest() for r in kept)
