import random
import re
import time

import pytest

from spanweave.llm import substring_dedup as m
from spanweave.llm.common import CLEANUP


@pytest.fixture
def docs(spark):
    rnd = random.Random(5)
    draw = lambda n: " ".join(rnd.choice("abcdefghij") * rnd.randrange(1, 9) for _ in range(n))
    shared = [draw(60) for _ in range(5)]
    return spark.createDataFrame([(i, f"{draw(40)} {rnd.choice(shared)} {draw(40)}") for i in range(60)], "doc_id long, text string")


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_no_table_leaves_shuffle_files(spark, docs, monkeypatch):
    left, write, set_before = {}, m.materialize, spark.conf.get(CLEANUP)
    known = shuffle_files(spark)

    def written(df, name):
        out = write(df, name)
        for _ in range(50):
            left[name] = shuffle_files(spark) - known
            if not left[name]:
                break
            time.sleep(0.1)
        return out

    monkeypatch.setattr(m, "materialize", written)
    assert m._left(docs, m.SPAN).count() == 60
    assert {"anchor-texts", "anchor-windows", "anchor-runs", "without-repeats"} <= set(left)
    assert not any(left.values()), left
    assert spark.conf.get(CLEANUP) == set_before


def test_texts_are_dealt_once_to_meet_their_anchors(spark, docs, monkeypatch):
    plans, write, before = {}, m.materialize, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def written(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(m, "materialize", written)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m.repeated_windows(docs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plans["anchor-texts"])
    assert [re.sub(r"#\d+L?", "", x) for x in dealt] == ["a, b", "a, b"]  # texts and names, once each
