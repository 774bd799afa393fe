"""The pipeline on a small corpus with planted cases, against a direct reading of what each stage is to do."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from spanweave.llm.common import tokenizer_path

PARTS = {"en": ["th", "ing", "er", "wh", "ly", "nd"], "de": ["sch", "ung", "ein", "ü", "lich"], "fr": ["é", "eau", "tre", "oi", "que"]}


def make(rnd, lang, n):
    return ["".join(rnd.choice(PARTS[lang]) for _ in range(rnd.randint(3, 6))) for _ in range(n)]


def test_planted_cases_go_and_clean_documents_stay(spark, tmp_path):
    rnd = random.Random(11)
    clean = {i: " ".join(make(rnd, lang := rnd.choice(list(PARTS)), rnd.randint(40, 200))) for i in range(180)}
    language = {i: max(PARTS, key=lambda k: sum(clean[i].count(p) for p in PARTS[k])) for i in clean}
    items = [make(rnd, "en", 30) for _ in range(5)]
    passage = make(rnd, "en", 60)
    rows = [(i, t, language[i], "s", len(t)) for i, t in clean.items()]
    short = make(rnd, "en", 45)
    rows += [(200, clean[7], language[7], "s", 0), (201, "123 456 !!", "en", "s", 0), (202, None, "en", "s", 0)]  # a copy; no letters
    rows += [(203 + k, " ".join(make(rnd, "en", 50) + item + make(rnd, "en", 20)), "en", "s", 0) for k, item in enumerate(items)]
    rows += [(210, " ".join(make(rnd, "en", 20) + passage), "en", "s", 0), (211, " ".join(passage + make(rnd, "en", 30)), "en", "s", 0)]
    rows += [(220, " ".join(short), "en", "s", 0), (221, " ".join(short).upper(), "en", "s", 0)]
    d = tmp_path / "sf"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(d))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
            out.write.parquet(f"{tmp_path}/{k}")
            docs = spark.read.parquet(f"{tmp_path}/{k}")
    left = {r.doc_id: r.text for r in docs.collect()}
    gone = {200, 201, 202, 203, 204, 205, 206, 207, 221}
    assert set(left) == {r[0] for r in rows} - gone
    assert all(left[i] == clean[i] for i in clean)
    assert left[211].split() == rows[-3][1].split()[60:]
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    placed = corpus_pipeline.run(spark, str(d)).collect()
    assert {r.doc_id for r in placed} == set(left)
    for r in placed:
        ids = [*library.encode(left[r.doc_id], add_special_tokens=False).ids, 0][r.start : r.start + r.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
    assert corpus_pipeline.STAGES[0][0] == "language_id" and docs.where(F.col("doc_id") == 220).count() == 1


def test_empty_documents_and_clashing_columns(spark, tmp_path):
    rnd = random.Random(12)
    names = ["node", "key", "left", "said", "root", "n_rows", "lost_id", "found_id", "_node", "_key"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    text, twice = (" ".join(make(rnd, "de", 70)) for _ in range(2))
    rows = [(1, text, "de", "s", 0, *names), (2, text, "de", "s", 0, *names), (3, twice, "de", "s", 0, *names), (4, None, None, None, None, *names), (None, "x" * 300_000, "de", "s", 0, *names)]
    full = spark.createDataFrame(rows, schema)
    for kind, docs in (("empty", full.where(F.lit(False))), ("unlabelled", full.withColumn("lang", F.lit(None).cast("string"))), ("full", full)):
        d = tmp_path / kind
        docs.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        now = spark.read.parquet(f"{d}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, str(d))
            assert now.columns == docs.columns, name
        got = now.collect()
        assert sorted(r.doc_id or 0 for r in got) == ([] if kind == "empty" else [0, 1, 3])
        assert all([r[n] for n in names] == names for r in got)
        assert corpus_pipeline.run(spark, str(d)).where("doc_id = 1").count() == (kind != "empty")
