import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanweave.llm import lm_scoring as m


def brute(texts, order, alpha=0.4):
    """Scores of all texts, each under the counts of all others."""
    tokens = [(t or "").split() for t in texts]

    def count(t):
        return Counter(tuple(t[i : i + n]) for n in range(1, order + 1) for i in range(len(t) - n + 1))

    every, total, out = Counter(), sum(map(len, tokens)), []
    for t in tokens:
        every.update(count(t))
    for t in tokens:
        own, s = count(t), 0.0
        for i in range(len(t)):
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(t[i - n + 1 : i + 1])
                seen = every[gram] - own[gram]
                if n == 1:
                    s += math.log(max(seen, 1) / max(total - len(t), 1)) + (order - 1) * math.log(alpha)
                elif seen:
                    s += math.log(seen / (every[gram[:-1]] - own[gram[:-1]])) + (order - n) * math.log(alpha)
                    break
        out.append(s)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_direct_counts(spark, order):
    rnd = random.Random(order)
    texts = [" ".join(rnd.choice("a b c dd ee the of É x1 x2 x3".split()) for _ in range(rnd.randint(0, 80))) for _ in range(150)]
    texts += [None, "", "once", "the the the " * 900, texts[3], " \n "]
    rows = [(i, t, 0.5, 1) for i, t in enumerate(texts)] + [(3, texts[3], 0.5, 1), (None, "zz a", 0.5, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_score double, batch long").repartition(3)
    got = m.score(docs, order=order, batch_chars=3000).collect()
    assert len(got) == len(texts) + 2
    want = brute([*texts, texts[3], "zz a"], order)
    for r in got:
        i = len(texts) + 1 if r.doc_id is None else r.doc_id
        assert r.log_score == pytest.approx(want[i], abs=1e-6)
        assert r.n_words == len(([*texts, "", "zz a"][i] or "").split()) and (r.mean_log_score is None) == (r.n_words == 0)


def test_an_empty_table_gives_no_scores(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert m.score(docs.where(F.lit(False))).count() == 0


def test_the_registered_query_counts_trigrams_seen_once(spark, tmp_path):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("a b c d e f g h".split()) for _ in range(rnd.randint(1, 30))) for _ in range(30)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(texts, 3)
    assert want != pytest.approx(brute(texts, 2))
    for r in m.query(spark, str(tmp_path)).collect():
        assert r.log_score == pytest.approx(want[r.doc_id], abs=1e-6)


def test_a_copy_scores_above_a_text_alone(spark):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choices("a b c d e f g h i j k l m n o p".split(), k=40)) for _ in range(20)]
    got = {r.doc_id: r.mean_log_score for r in m.score(spark.createDataFrame(list(enumerate([*texts, texts[7]])), "doc_id long, text string")).collect()}
    assert min(got[7], got[20]) > max(v for k, v in got.items() if k not in (7, 20))


def test_shorter_ngrams_decide_what_is_counted_and_shuffle_files_go(spark, tmp_path):
    rnd = random.Random(7)
    shared = [" ".join(rnd.choice("a b c d".split()) for _ in range(30)) for _ in range(20)]
    texts = [*shared, *(" ".join(f"w{i}x{j}" for j in range(200)) for i in range(20))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = m.batched(docs, 500)
    known = None
    for turn in range(m.ROUNDS):
        found = m.listed(m.with_totals(m.ngrams(rows, None, range(1, 3), turn)), turn)
        known = found if known is None else known.unionByName(found)
    # triples of which one document alone has a pair are not counted; all others are, in one round each
    triples = [{r.gram for r in m.ngrams(rows, known, range(3, 4), turn).collect()} for turn in range(m.ROUNDS)]
    every = [set(zip(t.split(), t.split()[1:], t.split()[2:])) for t in shared]
    assert len(set.union(*every)) == sum(map(len, triples)) and not set.intersection(*triples)
    before = spark.conf.get(m._CLEANUP)
    want = brute(texts, 3)
    for r in m.score(docs, batch_chars=500).collect():
        assert r.log_score == pytest.approx(want[r.doc_id], abs=1e-6)
    assert spark.conf.get(m._CLEANUP) == before


def test_counts_go_in_lists_not_in_a_row_for_each_ngram(spark):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("a b c d e f g h i j".split()) for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, parts = m.batched(docs, 500), 3
    every = Counter(tuple(w[i : i + n]) for w in map(str.split, texts) for n in (1, 2) for i in range(len(w) - n + 1))
    totals, single, lists = [], 0, 0
    for turn in range(m.ROUNDS):
        sent = m.ngrams(rows, None, range(1, 3), turn, parts)
        # a row for each batch, order and part at most, ordered by hashes; the same n-grams as one by one
        got = sent.collect()
        assert len({(r.batch, r.n, r.part) for r in got}) == len(got)
        flat = {(r.batch, r.n, g, h, r["first"] + i) for r in got for i, (g, h) in enumerate(zip(r.gram, r.here))}
        assert flat == {(r.batch, r.n, r.gram, r.here, r.nth) for r in m.ngrams(rows, None, range(1, 3), turn).collect()}
        by_hash = {}
        for _, _, g, h, _ in flat:
            by_hash[g] = by_hash.get(g, 0) + h
        totals += by_hash.values()
        back = {(r.batch, r.n, r["first"]): r.totals for r in m.with_totals(sent).collect()}
        assert back == {(r.batch, r.n, r["first"]): [by_hash[g] for g in r.gram] for r in got}
        single, lists = single + len(flat), lists + len(got)
    assert sorted(totals) == sorted(every.values())
    assert lists * 5 < single
