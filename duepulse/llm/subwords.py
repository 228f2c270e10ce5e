"""Hashed words and character n-grams of texts, by numpy over whole batches.

White space is one character here and marks where words start and end: a window that has
it inside is no n-gram, one that has it at an end is a prefix or suffix. Every feature is a
bucket number; a text is its buckets with their counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Code points that are put through the arrays at once.
SPAN = 1 << 17
_RATIO = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.uint32(32)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces cut at white space, near SPAN long; a word is never cut."""
    at = 0
    while len(text) - at > SPAN:
        end = at + SPAN
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def _spans(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Pieces of about SPAN code points together, with the number of each one's text."""
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            held.append(piece)
            owners.append(i)
            size += len(piece) + 1
            if size >= SPAN:
                yield held, np.array(owners)
                held, owners, size = [], [], 0
    if held:
        yield held, np.array(owners)


def features(
    texts: list[str], buckets: int, widths: tuple[int, ...], lower: bool, pairs: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (text number, bucket), one for each word and n-gram, in blocks of bounded size.

    With ``pairs`` also one for each two neighbouring words, hashed by the difference of their
    hashes: all repetitions of a word share one bucket, whatever the word.
    """
    shift = np.uint64(64 - (buckets - 1).bit_length())
    for pieces, owners in _spans(texts):
        joined = " " + " ".join(pieces) + " "
        if lower:
            lowered = joined.lower()
            joined = lowered if len(lowered) == len(joined) else "".join(c.lower()[:1] for c in joined)
        c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").copy()
        ends = np.cumsum([len(p) + 1 for p in pieces])  # a piece and the space after it
        owner = np.repeat(owners, np.diff(ends, prepend=0))
        c[(c < 33) | (c == 0x85) | (c == 0xA0) | (c == 0x2028) | (c == 0x2029)] = _SPACE
        space = c == _SPACE
        blanks = np.concatenate(([0], np.cumsum(space)))
        code = (c.astype(np.uint64) + np.uint64(1)) * _RATIO
        code ^= code >> np.uint64(32)
        h = code.copy()
        for n in range(2, max(widths) + 1):
            h = h[:-1] * np.uint64(0x100000001B3) + code[n - 1 :]
            if n in widths and len(h):
                inner = blanks[n - 1 : n - 1 + len(h)] - blanks[1 : 1 + len(h)]
                at = np.flatnonzero((inner == 0) & ~(space[: len(h)] & space[n - 1 :]))
                yield owner[np.minimum(at, len(owner) - 1)], (_mixed(h[at] + np.uint64(n)) >> shift).astype(np.int64)
        starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        if len(starts):
            stops = np.flatnonzero(~space[:-1] & space[1:]) + 1
            power = np.cumprod(np.full(len(c), _RATIO | np.uint64(1)))
            total = np.concatenate(([np.uint64(0)], np.cumsum(code * power)))
            # The same word has the same sum wherever it stands once its place is divided out.
            inverse = np.cumprod(np.full(len(c), np.uint64(pow(int(_RATIO | np.uint64(1)), -1, 1 << 64))))
            word = (total[stops] - total[starts]) * inverse[starts]
            owned = owner[np.minimum(starts - 1, len(owner) - 1)]
            yield owned, (_mixed(word + np.uint64(99)) >> shift).astype(np.int64)
            if pairs and len(starts) > 1:
                same = owned[1:] == owned[:-1]
                gap = (word[1:] - word[:-1])[same]
                yield owned[1:][same], (_mixed(gap + np.uint64(7)) >> shift).astype(np.int64)


def counted(
    text: str, buckets: int, widths: tuple[int, ...], lower: bool, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of one text and how often each occurs."""
    total = np.zeros(buckets, dtype=np.int64)
    for _, b in features([text], buckets, widths, lower, pairs):
        total += np.bincount(b, minlength=buckets)
    at = np.flatnonzero(total)
    return at, total[at]


def mean_weights(
    texts: list[str], table: np.ndarray, widths: tuple[int, ...], lower: bool,
    pairs: bool = False, prior: float = 0.0,
) -> np.ndarray:
    """For each text the mean over its features of the rows of table (buckets × classes).

    ``prior`` features of weight zero are counted in, so that few features say little.
    """
    sums = np.zeros((len(texts), table.shape[1]))
    counts = np.zeros(len(texts))
    for owner, b in features(texts, len(table), widths, lower, pairs):
        counts += np.bincount(owner, minlength=len(texts))
        for k in range(table.shape[1]):
            sums[:, k] += np.bincount(owner, weights=table[b, k], minlength=len(texts))
    return sums / np.maximum(counts + prior, 1)[:, None]
