"""Words of whole texts as numpy arrays of 64-bit hashes, many texts at a time."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: A longer text is cut at white space, so that the tables of powers stay small.
PART = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: For matching across punctuation: everything in ASCII but letters and digits parts words.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[128:] = False
for _low, _high in ("09", "az", "AZ"):
    PUNCTUATION[ord(_low) : ord(_high) + 1] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


class Words(NamedTuple):
    """Of n words in all: hashes; first and last-but-one byte in their text; and words of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    def of_texts(self):
        """The hashes of each text."""
        return np.split(self.hashes, np.cumsum(self.counts)[:-1]) if len(self.counts) else []


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of uint64 values."""
    h = (h ^ (h >> np.uint64(33))) * _MIX_1
    h = (h ^ (h >> np.uint64(33))) * _MIX_2
    return h ^ (h >> np.uint64(33))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n words in a row, len(hashes) - n + 1 of them."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:size].copy()
    for i in range(1, n):
        out *= np.uint64(_BASE)
        out += hashes[i : i + size]
    return mix(out)


def _tables(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16, min(2 * len(_powers), PART))
        _powers, _inverses = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        _powers[0] = _inverses[0] = 1
        _powers, _inverses = np.cumprod(_powers, dtype=np.uint64), np.cumprod(_inverses, dtype=np.uint64)


def _hash(data: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gap = np.ones(len(data) + 2, np.int8)
    gap[1:-1] = part[data]
    edges = np.flatnonzero(np.diff(gap))
    starts, ends = edges[::2], edges[1::2]
    _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverses[starts]), starts, ends


def _cuts(data: np.ndarray, part: np.ndarray) -> list[int]:
    """Places at white space, about PART bytes apart."""
    cuts, at = [0], PART
    while at < len(data):
        ahead = np.flatnonzero(part[data[at : at + PART]])
        while not len(ahead) and at < len(data):
            at += PART
            ahead = np.flatnonzero(part[data[at : at + PART]])
        if at < len(data):
            cuts.append(at + int(ahead[0]))
            at = cuts[-1] + PART
    return [*cuts, len(data)]


def words(texts: list[str], lower: bool = False, part: np.ndarray = SPACE) -> Words:
    """Words of texts, parted at the bytes that ``part`` marks; ``lower`` lower-cases A-Z."""
    raw = [text.encode(errors="surrogatepass") for text in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    if lower:
        data = _LOWER[data]
    found = []
    cuts = _cuts(data, part)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        h, starts, ends = _hash(data[a:b], part)
        found.append((h, starts + a, ends + a))
    h, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.uint64), *2 * [np.empty(0, np.int64)])
    last = np.cumsum(sizes)
    bounds = np.searchsorted(starts, last)
    counts = np.diff(bounds, prepend=0)
    shift = np.repeat(last - sizes, counts)
    return Words(h, starts - shift, ends - shift, counts)
