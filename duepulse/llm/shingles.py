"""Sets of word shingles of texts as sorted 64-bit hashes, by numpy over a batch's bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RATIO = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
#: Bytes of text that are put through the arrays at once; a longer text goes alone.
SPAN = 1 << 17


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: What each byte counts in a word's hash: A to Z as a to z.
_CODES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _RATIO)
_CODES[65:91] = _CODES[97:123]


def _blocks(texts: list[str | None]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1]) + 1
        if size >= SPAN:
            yield held
            held, size = [], 0
    if held:
        yield held


def word_hashes(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and for each text where its words begin and end."""
    b = np.frombuffer(b" " + b" ".join(held) + b" ", dtype=np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    stops = np.flatnonzero(~space[:-1] & space[1:]) + 1
    power = np.cumprod(np.full(len(b), _ODD))
    total = np.concatenate(([np.uint64(0)], np.cumsum(_CODES[b] * power)))
    inverse = np.cumprod(np.full(len(b), _INVERSE))
    words = mixed((total[stops] - total[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
    ends = np.cumsum([len(x) + 1 for x in held])
    bounds = np.searchsorted(starts, np.concatenate(([0], ends)), side="right")
    return words, bounds


def sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``width`` words.

    A text with fewer words has its whole sequence as its one shingle; one without words, or a
    null one, has none.
    """
    for held in _blocks(texts):
        words, bounds = word_hashes(held)
        rolled = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
        for i in range(width):
            rolled = rolled * _ODD + words[i : i + len(rolled)]
        rolled = mixed(rolled)
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if high - low >= width:
                yield np.unique(rolled[low : high - width + 1])
            elif high > low:
                whole = np.uint64(high - low)
                whole = np.array([whole])
                for w in range(low, high):
                    whole = mixed(whole * _RATIO + words[w])
                yield whole
            else:
                yield np.zeros(0, dtype=np.uint64)
