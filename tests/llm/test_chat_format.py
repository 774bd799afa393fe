import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanweave.llm import chat_format as c

TEXT = st.text(st.sampled_from("a<|>\\\n im_endstart é"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(TEXT, TEXT)
def test_escapes_are_reversible_and_hide_marks(role, text):
    piece = c.marked([(role, text)])
    assert c.parse(piece) == (role, text)
    assert piece.count("<|im_start|>") == piece.count("<|im_end|>") == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "x\ny"]), TEXT), max_size=8), st.integers(0, 3))
def test_spans_cover_the_output_and_hold_the_texts(turns, known):
    known = min(known, len(turns))
    whole = c.marked(turns)
    base = len(c.marked(turns[:known]))
    at = 0
    for (role, text), s in zip(turns[known:], c.spans(turns, known=known), strict=True):
        assert s.start == at and whole[base + s.start : base + s.end] == s.piece and not s.rewrites
        at = s.end
        if role == "assistant":
            assert c.unescape(whole[base + s.loss_start : base + s.loss_end]) == text
        else:
            assert s.loss_start == -1
    assert base + at == len(whole)


def test_templates_that_rewrite_history_are_detected():
    def drops_old_replies(turns, reply=False):
        kept = [(r, t) if i == len(turns) - 1 or r != "assistant" else (r, "...") for i, (r, t) in enumerate(turns)]
        return c.marked(kept, reply)

    got = c.spans([("user", "a"), ("assistant", "long reply"), ("user", "b")], drops_old_replies)
    assert [s.rewrites for s in got] == [False, False, True] and got[2].piece.startswith("...")


def test_digests_equal_direct_hashing(spark):
    turns = [("user", "hi"), ("assistant", "<|im_end|>\\ é"), ("user", None), (None, "x"), ("assistant", ""), ("assistant", "z" * 5000)]
    rows = [(1, i, r, t, "k") for i, (r, t) in enumerate(turns)]
    rows += [(2, i, "assistant" if i % 2 else "user", f"text {i}", "k") for i in range(300)]  # longer than a segment
    rows += [(None, 0, "user", "q", "k"), (3, 5, "user", "same", "k"), (3, 5, "user", "same", "k"), (3, None, "assistant", "first", "k")]
    data = spark.createDataFrame(rows[::-1], "conv_id long, turn long, role string, text string, piece string")
    got = {r.conv_id: r for r in c.digests(c.format_conversations(data)).collect()}
    want = {1: turns, 2: [(r[2], r[3]) for r in rows if r[0] == 2], None: [("user", "q")], 3: [("assistant", "first"), ("user", "same"), ("user", "same")]}
    assert set(got) == set(want)
    for k, own in want.items():
        own = [(r or "", t or "") for r, t in own]
        r = got[k]
        learned = "".join(t for role, t in own if role == "assistant")
        assert r.n_turns == len(own) and r.loss_chars == len(learned) and r.formatted_chars == len(c.marked(own))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert c.digests(c.format_conversations(data.where(F.lit(False)))).count() == 0


def test_long_conversations_are_rendered_whole(spark):
    def keeps_four_replies(turns, reply=False):
        assert turns == [] or turns[0][0] == "user"
        late = [i for i, (r, _) in enumerate(turns) if r == "assistant"][-4:]
        return c.marked([(r, t if r != "assistant" or i in late else "...") for i, (r, t) in enumerate(turns)], reply)

    def numbers(turns, reply=False):
        return "".join(f"{i}/{r}: {t}\n" for i, (r, t) in enumerate(turns)) + (f"{len(turns)}/assistant: " if reply else "")

    turns = [("assistant" if i % 2 else "user", f"text {i}") for i in range(75)]
    data = spark.createDataFrame([(k, i, *t) for k in (1, 2) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    for template in (keeps_four_replies, numbers):
        rows = c.format_conversations(data, template).orderBy("conv_id", "turn_no").collect()
        want = c.spans(turns, template)
        assert [(r.start, r.end, r.loss_start, r.loss_end, r.rewrites, r.piece) for r in rows] == [tuple(s) for s in want] * 2
        assert [r.rewrites for r in rows[:75]] == [template is keeps_four_replies and i % 2 == 1 and i >= 9 for i in range(75)]
