import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spanweave.llm.common import tokenizer_path
from spanweave.llm.pieces import PieceEncoder, piece_of, spaced

ENCODER = PieceEncoder(tokenizer_path("byte_bpe_50k.json"))
BITS = ["a", "The", "é", "Ĝ", "Ё", "中", "ª", "×", "ɐ", "1", "_", "'", "'s", ".", "!", "###", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x1d", "\xa0", "<|endoftext|>"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.sampled_from(BITS), max_size=14).map("".join), max_size=5))
def test_ids_are_those_of_the_library_for_whole_texts(texts):
    want = [e.ids for e in ENCODER.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in ENCODER.encode(texts)] == want
    assert ENCODER.count(texts).tolist() == [len(ids) for ids in want]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b for b in BITS if b not in "\x1c\x1d"]), max_size=14).map("".join))
def test_pieces_make_the_text(text):
    assert "".join(map(piece_of, spaced(text).split(" "))) == text


def test_latin_words_go_straight_to_the_model(monkeypatch):
    own = PieceEncoder(tokenizer_path("byte_bpe_50k.json"))
    text = " ".join(f"w{a}{b}é{'...' if a == b else ''}" for a in "abcdefg" for b in "abcdefg")
    want = own.tokenizer.encode(text, add_special_tokens=False).ids
    sent = []
    for name in ("_encode_alone", "_encode_together"):
        monkeypatch.setattr(own, name, lambda pieces, *a, f=getattr(own, name): sent.extend(pieces) or f(pieces, *a))
    assert own.encode([text])[0].tolist() == want
    assert sent == ["waaé..."]  # the first word has no space before it
    assert np.all(own.lengths[: own.known] > 0)
