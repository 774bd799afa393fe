import random

import pytest
from pyspark.sql import functions as F

from spanweave.llm import token_counts
from spanweave.llm.common import tokenizer_path
from spanweave.llm.pieces import PieceEncoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = ["", " ", "  a", "a  ", "a\n\n b", "a \n b", "\t", "é́ ́x", "a  b", "a  b", "x<|endoftext|>y", "a  <|endoftext|>  b",
       "<|startoftext|>", "I'm 's they're", "12 345", "!!?? ..", "a\x1cb \x1f c", "日本 語", "👍🏽 ok", "a\r\nb", "ß SS ΑΣ ΑΣ.", " x", "a\x0bb\x0c"]


def mixed(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(["the", " ", " ", "\n", "Été", ".", ",", "12", "'s", "  ", "\t", "xq", "|", "ñandú"]) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_pieces_equal_whole_texts(name):
    own = PieceEncoder(tokenizer_path(name))
    texts = ODD + mixed(400)
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in own.encode(texts)] == want
    assert own.count(texts).tolist() == [len(x) for x in want]


def library(name, text):
    from tokenizers import Tokenizer

    return len(Tokenizer.from_file(tokenizer_path(name)).encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("name", FILES)
def test_chunks_are_spliced_exactly(spark, name):
    texts = ["".join(mixed(40, s)) for s in range(6)] + ["word " * 300, "x" * 700, "  \n" * 300, "ab " + "y" * 400 + " cd" * 50, None, "", "a b <|endoftext|> " * 60]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = token_counts.count_tokens(docs, tokenizer_path(name), limit=100, chunk_chars=100, overlap_chars=30)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    for i, t in enumerate(texts):
        n = library(name, t)
        assert rows[i].n_tokens == n, (i, t)
        assert rows[i].n_bytes == len((t or "").encode()) and rows[i].over_limit == (n > 100)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (2, "long " * 50), (2, "long " * 50)], "doc_id long, text string")
    got = token_counts.count_tokens(docs, tokenizer_path(FILES[0]), chunk_chars=60, overlap_chars=20)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == [(0, 1), (1, 2), (1, 2), (2, 50), (2, 50)]
    assert token_counts.count_tokens(docs.where(F.lit(False)), tokenizer_path(FILES[0])).count() == 0
