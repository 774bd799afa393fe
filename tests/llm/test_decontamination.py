import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanweave.llm import decontamination as d


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=40), st.lists(st.integers(0, 4), max_size=60))
def test_lcs_equals_the_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    assert d.lcs(a, b) == row[-1]


def test_svd_equals_numpy(spark):
    rnd = np.random.default_rng(1)
    bench = [rnd.integers(0, 3000, 40).astype(np.uint32) for _ in range(5)]
    texts = [rnd.integers(0, 3000, rnd.integers(1, 200)).astype(np.uint32) for _ in range(40)]
    weight = rnd.random(d.FEATURES).astype(np.float32)
    useful = np.zeros(d.FEATURES, bool)
    for w in bench:
        useful[w] = True
    columns = np.flatnonzero(useful)
    rows = []
    for t in texts + bench:
        for a, b in zip(*d._spans(len(t)), strict=True):
            v = np.zeros(d.FEATURES)
            np.add.at(v, t[a:b], weight[t[a:b]])
            if useful[t[a:b]].any():
                rows.append(v[columns] / np.sqrt((weight[t[a:b]] ** 2).sum()))
    place = np.full(d.FEATURES, -1, np.int32)
    place[columns] = np.arange(len(columns))
    p = d._passages(texts + bench, weight, place)
    assert len(p.low) == len(rows)
    m = rnd.standard_normal((len(columns), 7)).astype(np.float32)
    a = np.array(rows)
    assert np.allclose(d._project(p, m), a @ m, atol=1e-3)
    assert np.allclose(d._normal_product(p, m), a.T @ (a @ m), atol=1e-2)


def test_copies_and_paraphrases_are_found_and_clean_texts_left(spark):
    rnd = random.Random(4)
    make = lambda n: [f"w{int(rnd.paretovariate(0.25)) % 20_000}" for _ in range(n)]
    items = [make(rnd.randint(18, 70)) for _ in range(30)]
    texts, leaks = [], set()
    for i in range(300):
        t = make(rnd.randint(0, 400))
        if i % 10 == 0:
            own = list(items[i // 10])
            if i % 20 == 0:  # a paraphrase: a fifth of the words before the answer are others
                for j in rnd.sample(range(len(own) - 6), len(own) // 5):
                    own[j] = "other"
            at = rnd.randint(0, len(t))
            t[at:at] = own
            leaks.add((i, i // 10))
        texts.append(" ".join(t).capitalize() + ".")
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(900, None, "c"), (901, "", "c"), (0, texts[0], "c"), (None, " ".join(items[1]), "c")], "doc_id long, text string, words string")
    bench = spark.createDataFrame([(i, " ".join(t), 1) for i, t in enumerate(items)] + [(50, None, 1), (51, "!", 1)], "item_id long, text string, cosine int")
    rows = d.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == leaks | {(None, 1)} and len(rows) == 31
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == 270 + 2
    for a, b in ((docs.where(F.lit(False)), bench), (docs, bench.where(F.lit(False)))):
        assert d.contaminated(a, b).count() == 0


def test_an_item_in_a_third_of_all_documents_is_found(spark):
    rnd = random.Random(6)
    make = lambda n: [f"w{rnd.randrange(20_000)}" for _ in range(n)]
    item = make(30)
    docs = spark.createDataFrame([(i, " ".join(make(50) + (item if i % 3 == 0 else make(30)) + make(20))) for i in range(300)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(make(30)))], "item_id long, text string")
    assert sorted(r.doc_id for r in d.contaminated(docs, bench).collect()) == list(range(0, 300, 3))


def test_copies_are_found_whatever_the_size_of_the_benchmark(spark):
    rnd = random.Random(7)
    make = lambda n: [f"w{rnd.randrange(20_000)}" for _ in range(n)]
    items = [make(rnd.randint(15, 59)) for _ in range(3000)]
    docs = spark.createDataFrame([(i, " ".join(make(rnd.randint(0, 90)) + items[i * 10] + make(60))) for i in range(300)], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()} == {(i, i * 10) for i in range(300)}


def test_a_paraphrase_of_the_rare_words_is_found(spark):
    rnd = random.Random(8)
    common, rare = [f"c{i}" for i in range(25)], iter(f"r{i}" for i in range(10_000))
    items, texts = [], []
    for i in range(10):
        item = [w for _ in range(12) for w in (rnd.choice(common), next(rare))] + [next(rare) for _ in range(3)] + rnd.choices(common, k=3)
        swapped = list(item)
        for j in range(1, 14, 2):
            swapped[j] = rnd.choice(common)
        items.append(item)
        texts += [rnd.choices(common, k=30) + swapped + rnd.choices(common, k=30), *([*rnd.choices(common, k=60), next(rare), next(rare)] for _ in range(20))]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()} == {(i * 21, i) for i in range(10)}


def test_the_words_in_order_decide():
    assert d.overlap(d._Item(1, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10], [1.0] * 9 + [9.0]), [0, 1, 2, 3, 0, 5, 6, 7, 8, 9, 0, 4]) == (0.8, 5 / 6)
    assert d.is_found(0.6, 5 / 6) and d.is_found(0.8, 0.0) and not d.is_found(0.79, 0.7) and not d.is_found(0.59, 1.0)


def brute(texts, items, df, total):
    """Pairs found by the stated rule around every passage of every document, without retrieval."""
    idf = np.log((1 + total) / (1 + df))
    listed = [d._Item(i, w.tolist(), idf[d._feature(w)].tolist()) for i, w in items]
    out = set()
    for doc_id, words in texts:
        every = set(words.tolist())
        for item in listed:
            if sum(w in every for w in item.words) >= d.MOST * len(item.words):
                size = len(item.words)
                if any(d.is_found(*d.overlap(item, words[max(0, a - size) : a + d.PASSAGE + size].tolist())) for a in d._spans(len(words))[0].tolist()):
                    out.add((doc_id, item.item_id))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_findings_equal_brute_force_over_all_passages(spark, monkeypatch, small):
    sf_dir = "/root/testdata/sf0.01"
    if small:  # many blocks, of which a few share a pass
        monkeypatch.setattr(d, "BLOCK_PASSAGES", 20)
        monkeypatch.setattr(d, "BLOCKS", 4)
    docs = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if r.text is not None]
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    texts = d._tokens([r.text for r in docs])
    df = np.zeros(d.FEATURES, np.int64)
    for words in texts:
        df[np.unique(d._feature(words))] += 1
    want = brute(zip([r.doc_id for r in docs], texts, strict=True), list(zip([r.item_id for r in items], d._tokens([r.text for r in items]), strict=True)), df, len(docs))
    got = {(r.doc_id, r.item_id) for r in d.query(spark, sf_dir).collect()}
    assert len(want) > 20 and got == want


def test_an_answer_with_a_rare_word_needs_no_floor():
    worth = [0.1] * 6 + [5.0] * 8 + [1.0, 1.0, 1.0, 1.0, 1.0, 4.0]
    item = d._Item(1, list(range(20)), worth)
    swapped = [*range(6), *[99] * 8, *range(14, 20)]  # 0.6 of the words, a fifth of their IDF
    assert d.is_found(*d.overlap(item, swapped))
    common = item._replace(worth=[*worth[:-1], 1.0])
    assert not d.is_found(*d.overlap(common, swapped))
    assert not d.is_found(*d.overlap(item, swapped[:-2]))
