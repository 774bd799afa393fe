import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spanweave.llm import simhash as s
from spanweave.llm.graph import components


def brute_fingerprint(text):
    tokens = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    grams = [b" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] or ([b" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_masks_cover_every_pair_of_places():
    own = s.masks(2, np.arange(64))
    assert len(own) == 7
    for a, b in itertools.combinations(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in own)
    rnd = random.Random(8)
    for radius, n in ((6, 64), (6, 32), (4, 31), (5, 20)):
        own = s.masks(radius, np.arange(n))
        for _ in range(2000):
            places = rnd.sample(range(n), radius)
            assert any(all(not m >> p & 1 for p in places) for m in own)
        assert min(m.bit_count() for m in own) >= n // 8
    for places in itertools.combinations(range(0, 64, 3), 3):
        assert any(all(not m >> p & 1 for p in places) for m in s.masks(3, np.arange(64)))


@pytest.mark.parametrize("radius", [2, 4, 6])
def test_classes_equal_brute_force_in_crowded_buckets(spark, radius):
    rnd = random.Random(radius)
    fps = [rnd.getrandbits(64) for _ in range(60)]
    for center in fps[:3]:
        fps += [center ^ sum(1 << p for p in rnd.sample(range(64), rnd.randint(1, 6))) for _ in range(150)]
    fps += [fps[0] ^ (i << 20) for i in range(300)]  # one dense ball
    fps += [0, 0, 1, fps[5], fps[5]]
    want = brute_components(fps, radius)
    rows = spark.createDataFrame([(i, int(np.array([f], np.uint64).view(np.int64)[0])) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in s.classes(rows, radius).collect()}
    assert [got[i] for i in range(len(fps))] == want


def test_query_columns_follow_the_contract(spark):
    texts = ["The cat sat on the mat", None, "", "the CAT  sat\ton the mat", "É one", "a", "a b", "É ONE", "x " * 700, "one two three four five " * 90, " \n "]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(0, texts[0], "z"), (None, "a", "z")], "doc_id long, text string, fp string")
    rows = s.classes(s.materialize(s.fingerprints(docs).select("doc_id", "fp"), "t"))
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in rows.collect()]
    assert len(got) == len(texts) + 2
    want = brute_components([brute_fingerprint(t) for t in texts], 2)
    for doc_id, fp, component in got:
        i = 5 if doc_id is None else doc_id
        assert fp == brute_fingerprint(texts[i]) and component == want[i]
    assert s.classes(s.materialize(s.fingerprints(docs.where(F.lit(False))), "t")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200}


def test_one_document_of_each_near_copy_stays(spark):
    rnd = random.Random(1)
    base = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(150)) for _ in range(30)]
    texts = list(base)
    for t in base[:10]:
        tokens = t.split()
        tokens[rnd.randrange(150)] = "other"
        texts.append(" ".join(tokens))
    texts += [base[20], base[20].upper(), None, "", "few", "few"]
    docs = spark.createDataFrame([(i, t, i % 3) for i, t in enumerate(texts)] + [(3, texts[3], 0)], "doc_id long, text string, _root int")
    kept = s.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert set(range(30)) <= set(ids) and len(ids) == len(set(ids))
    assert len([i for i in ids if 30 <= i < 40]) == 0
    assert [i for i in ids if i >= 40] == [42, 44]
    assert s.drop_near_duplicates(docs.where(F.lit(False))).count() == 0


def test_near_duplicates_equal_brute_force_over_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(s, "COMMON_SAMPLE", 1)
    rnd = random.Random(12)
    make = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    line, texts = make(14), []
    for _ in range(25):
        base = make(rnd.choice([6, 12, 25, 90, 200])) + (line if rnd.random() < 0.5 else [])
        texts.append(" ".join(base))
        for _ in range(6):  # from one changed word to a tenth of them, cut or longer
            t = list(base)
            for j in rnd.sample(range(len(t)), rnd.randint(1, max(1, len(t) // 25))):
                t[j] = "other"
            texts.append(" ".join(t[: rnd.choice([len(t), len(t) - 1, int(len(t) * 0.9)])] + make(rnd.choice([0, 0, 1, 5]))))
    texts = sorted({*texts, "", " ", "a b", "A b", "few", *(" ".join([*make(100), *line]) for _ in range(30))})
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in texts)]
    root = list(range(len(texts)))
    linked = 0
    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
            linked += 1
            root = [root[a] if x == root[b] else x for x in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    node = {r.node: r.doc_id for r in docs.select("doc_id", F.xxhash64("text").alias("node")).collect()}
    got = list(range(len(texts)))
    for r in s.near_duplicates(docs).collect():
        got[node[r.node]] = node[r.root]
    same = lambda x: {frozenset(i for i in range(len(x)) if x[i] == v) for v in set(x)}
    assert same(got) == same(root) and linked > 30


def test_near_duplicates_come_by_fingerprints_first(spark, monkeypatch):
    rnd = random.Random(2)
    long = [[f"w{rnd.randrange(9000)}" for _ in range(3000)] for _ in range(6)]
    texts = [" ".join(t) for t in long] + [" ".join([*t[:-1], "other"]) for t in long] + ["", "few words", "FEW words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    linked = []
    plain = s._by_fingerprint
    monkeypatch.setattr(s, "_by_fingerprint", lambda keyed: linked.append(plain(keyed)) or linked[0])
    monkeypatch.setattr(s, "ROUNDS", -1)  # no join by prefixes
    node = {r.node: r.doc_id for r in docs.select("doc_id", F.xxhash64("text").alias("node")).collect()}
    got = {frozenset((node[r.node], node[r.root])) for r in s.near_duplicates(docs).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    want = {frozenset((i, i + 6)) for i in range(6) if (fps[i] ^ fps[i + 6]).bit_count() <= 2} | {frozenset((13, 14))}
    assert got == want and len(want) > 3 and linked
