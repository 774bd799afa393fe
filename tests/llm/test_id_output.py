import tempfile

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanweave.llm import id_output
from spanweave.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1))))
def test_code_round_trip(values):
    values = np.array(values, np.uint32)
    control, data = id_output.encode_values(values)
    assert len(control) == -(-len(values) // 4)
    assert id_output.decode_values(control, data, len(values)).tolist() == values.tolist()


def test_files_hold_all_ids_in_order(spark):
    texts = ["the cat", None, "", "Ünïcode  text\n\n x", "the the the <|endoftext|> the", "word " * 500]
    docs = spark.createDataFrame([(9 - i, t, "c") for i, t in enumerate(texts)] + [(None, "z", "c"), (7, "", "c")], "doc_id long, text string, shard string")
    target = tempfile.mkdtemp()
    id_output.write_ids(docs, PATH, f"{target}/out")
    rows, id_of = id_output.read_ids(spark, f"{target}/out")
    got = sorted(id_output.decode_ids(rows, id_of).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(PATH)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys) and len(got) == 8
    at = 0
    for r in got:
        text = "z" if r.doc_id is None else (texts[9 - r.doc_id] or "")
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert r.start == at and np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)
    counts = np.bincount(np.concatenate([np.frombuffer(r.ids, "<u4") for r in got]))
    assert (np.diff(counts[id_of]) <= 0).all()
    id_output.write_ids(docs.where(F.lit(False)), PATH, f"{target}/empty")
    assert id_output.decode_ids(*id_output.read_ids(spark, f"{target}/empty")).count() == 0
