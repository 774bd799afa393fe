import re
from collections import Counter

from pyspark.sql import functions as F

from spanweave.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", "a b c a b c", "x " * 60, "one two three four " * 20, "line\nline\n \nline two", "##$% | <>", "é ü x\x1cy", "IDIOT scum " + "word " * 60,
         "a\nb\na\nb", " ".join(f"w{i}" for i in range(80)), "UPPER CASE TEXT " * 4]


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_measurements_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int")
    rows = {r.doc_id: r for r in q.ledger(docs).collect()}
    for i, t in enumerate(TEXTS):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t), t


def test_policies_and_ablation_read_the_ledger(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    ledger = q.ledger(docs)
    kept = {r.doc_id for r in q.apply_policy(ledger).where("kept").collect()}
    assert kept == {10}
    assert {r.doc_id for r in q.apply_policy(ledger, "base-1").where("kept").collect()} >= kept
    report = {r.rule: r for r in q.ablation(ledger).collect()}
    bits = [r.failed for r in ledger.collect()]
    for name, bit in q.BIT.items():
        assert report[name].n_failed == sum(b & bit > 0 for b in bits)
        assert report[name].n_failed_alone == sum(b == bit for b in bits)
        assert report[name].n_kept_without == sum(b & ~bit == 0 for b in bits)
    assert q.ledger(docs.where(F.lit(False))).count() == 0


def test_stems_are_learned_from_labels(spark):
    words = [f"{c}{d}mono" for c in "bdfgklm" for d in "aeiou"]
    rows = [(i, " ".join(words[(i * 7 + j * 3) % 35] for j in range(60)) + (" zurga Zurgle" if i % 5 == 0 else ""), 1) for i in range(100)]
    rows += [(200, None, 1), (201, "zurgon " * 30 + "plain " * 40, 1), (202, "azurg " * 60, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 100)] + [(500, 1), (None, 1), (3, None), (200, 1)], "doc_id long, toxic int")
    stems = q.toxic_stems(docs, labels)
    assert stems == ["zur"]
    got = {r.doc_id: r.failed & q.BIT["toxic_stems"] > 0 for r in q.ledger(docs, stems).collect()}
    assert got[0] and got[5] and got[201] and not got[1] and not got[202] and not got[200]
    assert q.toxic_stems(docs, labels.where("toxic = 0")) == [] and q.toxic_stems(docs.where(F.lit(False)), labels) == []


def test_query_equals_its_sql(spark):
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
    import oracle

    sf_dir = "/root/testdata/sf0.001"
    mine, theirs = oracle.both(spark, oracle.connect(sf_dir), q.query, q.ORACLE_SQL, sf_dir)
    assert mine == theirs
