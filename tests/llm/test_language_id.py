import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from spanweave.llm import language_id as g


def make(rnd, parts, n):
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(n))


SPEECH = {"aa": ["ba", "lo", "mi", "ru"], "bb": ["sch", "ein", "ung", "ü"], "cc": ["ció", "que", "ñe", "ar"]}


def test_held_out_accuracy_and_defined_cases(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(240):
        lang = rnd.choice(list(SPEECH))
        rows.append((i, make(rnd, SPEECH[lang], rnd.randint(3, 60)), None if i % 17 == 0 else lang, "x"))
    rows += [(1000, None, "aa", "x"), (1001, "", "bb", "x"), (1002, "12 !? 3", "aa", "x"), (None, "ungein schein", "bb", "x"), (1003, "ungein schein", "bb", "x"), (1003, "ungein schein", "bb", "x"),
             (1004, "-" * 300 + " balomi", "aa", "x"), (1005, make(rnd, SPEECH["cc"], 30_000), None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = g.train(g.learning_rows(docs))
    got = g.identify(docs, model).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.doc_id is not None and r.doc_id < 1000 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and truth[r.doc_id]]
    assert len(held) > 50 and np.mean([r._pred == truth[r.doc_id] for r in held]) > 0.97
    by_id = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by_id[i]._pred, by_id[i]._score) == ("und", 0.0)
    assert by_id[None]._pred == by_id[1003]._pred == "bb" and by_id[1004]._pred == "aa" and by_id[1005]._pred == "cc"
    assert all(0 <= r._score <= 1 for r in got)
    assert (model.weights == 0).mean() > 0.5  # the elastic net leaves few
    kept = g.keep_identified(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {1000, 1001, 1002} and len(ids) > 230
    empty = docs.where(F.lit(False))
    assert g.identify(empty, g.train(empty)).count() == 0 and g.identify(docs, g.train(empty)).where("_pred <> 'und'").count() == 0


def test_a_grams_feature_is_that_of_its_text_alone():
    texts = ["abc", "", "c", "ab", "éü"]
    both = g.counts(texts)
    for t, row in zip(texts, both, strict=True):
        assert (g.counts([t])[0] == row).all() and row.sum() == sum(max(0, len(t) - n + 1) for n in (1, 2, 3))
