"""Whole-text encoding by a BPE tokenizer, with the library called once per distinct piece.

Both vocabularies cut a text into pre-tokens before merging, and never merge across white space. So a text
can be cut at white space, each distinct piece encoded by the library, and the ids put together again. Texts
for which this can't be shown (rare white space or separator characters, special strings) go to the library whole.

Where white space is kept, Arrow cuts the texts and numbers their pieces, so that Python sees the distinct ones of a call only. Of these, a Latin
word with punctuation after it goes straight to the library's BPE model, in the model's alphabet: its pre-tokenizer would cut it there, too, but takes
several times as long as the model.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from spanweave.llm.common import single_threaded

#: Characters that Python and the tokenizers may class differently as white space.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
#: Of a tokenizer that keeps white space the pieces are words with one space before them, and the rest of a run of white space. What is not a word with a
#: space before it is marked so by BARE, its own spaces by HELD; texts with these characters go to the library whole.
BARE, HELD = "\x1c", "\x1d"
SPACES = " \t\n\x0b\x0c\r"
#: White space other than single spaces, and strings without which it is single newlines only.
GAP = re.compile("[ \t-\r]{2,}|[\t-\r]")
GAPS = ("  ", "\n\n", " \n", "\n ", "\t", "\x0b", "\x0c", "\r")
#: A Latin word and ASCII punctuation after it: two words of the byte-level pre-tokenizer for certain, apostrophes apart.
LATIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)")
#: The characters that stand for bytes in a byte-level vocabulary, by byte.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
ALPHABET = {b: b if b in _SHOWN else 0x100 + i for i, b in enumerate([b for b in range(256) if b not in _SHOWN])} | {b: b for b in _SHOWN}
#: Runs of letters, and of what is neither letter, digit, apostrophe nor underscore: each is a word of its own for a tokenizer that drops white space.
RUNS = re.compile(r"[^\W\d_]+|[^\w']+")
RUNS_ONLY = re.compile(r"(?:[^\W\d_]+|[^\w'])+")
#: A worker forgets its pieces beyond this count, so its memory stays bounded; frequent ones are soon back.
MAX_PIECES = 500_000


def _bare(piece: str) -> str:
    return BARE + piece.replace(" ", HELD)


def _gap(found: re.Match) -> str:
    space = found.group()
    if space[-1] == " ":
        return f" {_bare(space[:-1])} "
    parts = (space[:-1], space[-1]) if len(space) > 1 else (space,)
    return "".join(f" {_bare(p)}" for p in parts) + f" {BARE}"


def spaced(text: str) -> str:
    """A text as its pieces with a space between any two; a piece without BARE has lost the space before it."""
    body = text.rstrip(SPACES)
    cut = GAP.sub(_gap, body) if any(s in body for s in GAPS) else body.replace("\n", f" {BARE}\n {BARE}")
    return BARE + cut + (f" {_bare(text[len(body) :])}" if len(body) < len(text) else "")


def piece_of(key: str) -> str:
    """The piece that stands for ``key`` in ``spaced``."""
    return key[1:].replace(HELD, " ") if key.startswith(BARE) else f" {key}"


class _Codes(dict):
    """Numbers pieces in the order they are first met."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        code = self[piece] = len(self)
        self.new.append(piece)
        return code


class PieceEncoder:
    """ids of whole texts; the tokenizer file's kind decides how texts are cut."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        single_threaded()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [token["content"] for token in spec["added_tokens"]]
        drops_space = spec["normalizer"] is not None and "Replace" in json.dumps(spec["normalizer"])
        self.lowers = "Lowercase" in json.dumps(spec["normalizer"])
        self.keeps_space = not drops_space
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.straight = spec["normalizer"] is None and spec["model"]["type"] == "BPE" and plain.items() <= (spec["pre_tokenizer"] or {}).items()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        #: ids that begin a piece (with its space), or that end a word
        self.marks = np.array([t.startswith("\u0120") for t in tokens] if self.keeps_space else [bool(suffix) and t.endswith(suffix) for t in tokens])
        self.forget()

    def forget(self) -> None:
        """Drop the pieces learned; a task does so at its end, as its worker goes on to other work."""
        self.codes = _Codes()
        self.tails: dict[str, list[int]] = {"": []}
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.empty(1 << 14, np.int64)
        self.lengths = np.empty(1 << 14, np.int64)
        self.known = 0

    def _learn(self) -> None:
        new, self.codes.new = self.codes.new, []
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            n = len(part)
            self._reserve(n)
            rest = np.arange(n)
            if self.straight:
                found = [LATIN.fullmatch(key) for key in part]
                rest = np.flatnonzero([m is None for m in found])
                self._keep(np.delete(np.arange(n), rest), *self._encode_words([m.groups() for m in found if m]))
            part = [piece_of(part[k]) for k in rest.tolist()] if self.keeps_space else part
            marks = np.array([self._count_marks(p) for p in part])
            together, alone = np.flatnonzero(marks), np.flatnonzero(marks == 0)
            for i in range(0, len(together), 1000):
                chosen = together[i : i + 1000]
                self._keep(rest[chosen], *self._encode_together([part[k] for k in chosen.tolist()], marks[chosen]))
            self._keep(rest[alone], *self._encode_alone([part[k] for k in alone.tolist()]))
            self.known += n

    def _reserve(self, n: int) -> None:
        short = self.known + n - len(self.starts)
        if short > 0:
            more = np.empty(max(short, len(self.starts)), np.int64)
            self.starts, self.lengths = np.concatenate([self.starts, more]), np.concatenate([self.lengths, more])

    def _keep(self, places: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of pieces, one after the other, for places among those that are being learned."""
        end = self.used + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(self.flat), len(ids)), np.uint32)])
        self.flat[self.used : end] = ids
        self.starts[self.known + places] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.known + places] = lengths
        self.used = end

    def _count_marks(self, piece: str) -> int:
        """Marked ids that a piece is sure to have when it is encoded among others; 0 if that isn't sure."""
        if self.keeps_space:
            return int(len(piece) > 1 and piece[0] == " ")
        if piece.isascii() and piece.isalpha():
            return 1
        return len(RUNS.findall(piece)) if RUNS_ONLY.fullmatch(piece) and RUNS_ONLY.fullmatch(piece.lower()) else 0

    def _encode_words(self, words: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, with a space before and punctuation after them, from the library's model, and how many each has."""
        model = self.tokenizer.model.tokenize
        shown = "\n".join(w for w, _ in words).encode().decode("latin-1").translate(ALPHABET | {10: 10}).split("\n")
        found = []
        for word, (_, tail) in zip(shown, words, strict=False):
            if tail not in self.tails:
                self.tails[tail] = [t.id for t in model(tail)]
            found.append([t.id for t in model("\u0120" + word)] + self.tails[tail])
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _encode_alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _encode_together(self, pieces: list[str], marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces and how many each has, from one text of all of them: a call for each piece costs several times as much."""
        text = "".join(pieces) if self.keeps_space else " ".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        where = np.flatnonzero(self.marks[ids])
        if len(where) != marks.sum():
            return self._encode_alone(pieces)
        bounds = np.append(where, len(ids)) if self.keeps_space else np.concatenate([[0], (where + 1)[np.cumsum(marks)[:-1] - 1], [len(ids)]])
        return ids, np.diff(bounds)

    def _plain(self, text: str) -> bool:
        if not text.isascii() or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            if ODD_SPACE.search(text):
                return False
        return not (self.keeps_space and any(s in text for s in self.special))

    def _lower(self, text: str) -> str:
        """In lower case where that is what the tokenizer does in any case, so that fewer pieces are distinct."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower() if self.lowers else text

    def _codes_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
        """Codes of all pieces, their count by text, and the ids of texts that went to the library whole."""
        if len(self.codes) > MAX_PIECES:
            self.forget()
        whole = {i: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for i, t in enumerate(texts) if not self._plain(t)}
        if self.keeps_space:
            own = pc.split_pattern(pa.array([None if i in whole else spaced(t) for i, t in enumerate(texts)], pa.large_string()), " ")
            counts = pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False)
            keys = own.flatten().dictionary_encode()
            distinct = keys.dictionary.to_numpy(zero_copy_only=False)
            codes = np.fromiter(map(self.codes.__getitem__, distinct), np.int64, len(distinct))[keys.indices.to_numpy()]
        else:
            pieces: list[str] = []
            counts = np.zeros(len(texts), np.int64)
            for i, text in enumerate(texts):
                if i not in whole:
                    own = self._lower(text).split()
                    counts[i] = len(own)
                    pieces += own
            codes = np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces))
        self._learn()
        return codes, counts, whole

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        codes, counts, whole = self._codes_of(texts)
        sums = np.concatenate([[0], np.cumsum(self.lengths[codes])])
        ends = np.cumsum(counts)
        totals = sums[ends] - sums[ends - counts]
        for i, ids in whole.items():
            totals[i] = len(ids)
        return totals

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text as uint32."""
        codes, counts, whole = self._codes_of(texts)
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.starts[codes] - (ends - lengths), lengths) + np.arange(total)]
        sums = np.concatenate([[0], ends])
        last = np.cumsum(counts)
        bounds = sums[last]
        out = np.split(flat, bounds[:-1]) if len(texts) else []
        for i, ids in whole.items():
            out[i] = ids
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
