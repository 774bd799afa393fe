import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanweave.llm import importance as d

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import oracle  # noqa: E402


def features(text, orders, buckets):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    grams = [" ".join(words[i : i + k]) for k in range(1, orders + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def brute(rows, target, orders=1, buckets=10_000, min_words=20, percent=10):
    own = [(doc_id, *features(text, orders, buckets)) for doc_id, text in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for text in target for b in features(text, orders, buckets)[1])
    size, goal = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (size + buckets) / ((n + 1) * (goal + buckets)))) for b, n in s.items()}
    out = []
    for doc_id, n_words, found in own:
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n_words])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return [tuple(r[:5]) for r in out]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)] + ["Straße", "ÉTÉ", "été", "x_y", "don't", "日本"]
    out = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(60)))) for i in range(200)]
    return out + [(900, None), (901, ""), (902, "?! \x00 ..."), (903, "Word " * 5000), (5, out[5][1]), (5, out[5][1]), (None, out[6][1]), (None, "a " * 30)]


@pytest.mark.parametrize("orders", [1, 2, 3])
def test_equals_brute_force(spark, rows, orders):
    target = ["w1 w2 w3 straße", "w1 w2 w9", None, "", "w1 w1 w1 w2 w2"]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, row string, n int").repartition(5)
    goal = spark.createDataFrame([(t, 7) for t in target], "text string, row int")
    out = d.resample(docs, goal, orders=orders, percent=30)
    want = brute(rows, target, orders, percent=30)
    assert order(out.collect()) == order(want)
    assert sum(r[4] is not None for r in want) > 20
    assert [t for _, t in out.dtypes] == ["bigint"] * 5


def test_one_order_needs_no_window_and_several_one_sort(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t in rows], "row long, text string")
    plans = [d.features(d.positions(docs), n)._jdf.queryExecution().executedPlan().toString() for n in (1, 3)]
    assert "Window" not in plans[0] and "Exchange" not in plans[0]
    assert plans[1].count("+- Window") == 1 and "Python" not in plans[1]


def test_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = docs.where(F.lit(False))
    assert d.resample(none, docs).count() == 0
    assert order(d.resample(docs, none).collect()) == order(brute(rows, []))


def test_ties_are_ranked_without_gaps(spark):
    rows = spark.range(5000).select(F.col("id").alias("row"), (F.col("id") % 7).alias("doc_id"), (F.col("id") % 3).alias("score")).repartition(9)
    got = d.ranked(rows, 50).join(rows, "row").orderBy("rank").collect()
    want = sorted(rows.collect(), key=lambda r: (-r.score, r.doc_id, r.row))[:2500]
    assert [r["rank"] for r in got] == list(range(1, 2501)) and [r.row for r in got] == [r.row for r in want]


def test_query_equals_duckdb(spark):
    sf_dir = "/root/testdata/sf0.001"
    mine, theirs = oracle.both(spark, oracle.connect(sf_dir), d.query, d.ORACLE_SQL, sf_dir)
    assert mine == theirs and len(mine) > 100
