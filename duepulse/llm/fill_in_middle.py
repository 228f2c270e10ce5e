"""Fill-in-the-middle: a text is cut in three, and the parts are put in another order.

Cuts are counted in units: code points, words or lines. A text is split into fixed blocks of
bytes, and a Fenwick tree over them stores how many units and code points begin in each. A cut
behind k units is found by descending that tree by powers of two to the block in which unit k
begins, then within that block. Counting takes one pass over the text, a cut touches one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables

#: Bytes of a block.
BLOCK = 4096
#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of output that are sent on at once.
HELD = 8 << 20


@dataclass(frozen=True)
class Rates:
    """Out of 100: texts from ``plain_from`` on stay plain, transformed ones below ``spm_below`` begin with the suffix."""

    plain_from: int = 90
    spm_below: int = 20


def _code_points(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 begin a code point."""
    return (raw & 0xC0) != 0x80


def _words(raw: np.ndarray) -> np.ndarray:
    """Which bytes begin a word, a run without white space; white space behind belongs to it."""
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    return ~blank & np.concatenate(([True], blank[:-1]))[: len(raw)]


def _lines(raw: np.ndarray) -> np.ndarray:
    """Which bytes begin a line; the line feed belongs to the line it ends."""
    return np.concatenate(([True], raw[:-1] == 0x0A))[: len(raw)]


UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"code point": _code_points, "word": _words, "line": _lines}


class BlockTree:
    """A Fenwick tree over blocks of a UTF-8 text, with counts of units and code points."""

    def __init__(self, text: bytes, unit: str = "code point", block: int = BLOCK) -> None:
        self.raw = np.frombuffer(text, dtype=np.uint8)
        self.begins, self.block = UNITS[unit], block
        edges = np.arange(0, len(self.raw), block)
        chars, units = self._counts(_code_points, edges), self._counts(self.begins, edges)
        self.units, self.chars = int(units.sum()), int(chars.sum())
        self.tree_units, self.tree_chars = self._tree(units), self._tree(chars)

    def _marks(self, begins: Callable[[np.ndarray], np.ndarray], start: int, end: int) -> np.ndarray:
        """Marks of the bytes from start to end; what a byte begins may depend on the byte before."""
        before = min(start, 1)
        return begins(self.raw[start - before : end])[before:]

    def _counts(self, begins: Callable[[np.ndarray], np.ndarray], edges: np.ndarray) -> np.ndarray:
        return np.array([np.count_nonzero(self._marks(begins, e, e + self.block)) for e in edges.tolist()], dtype=np.int64)

    @staticmethod
    def _tree(counts: np.ndarray) -> list[int]:
        """Node i (from 1) sums as many counts up to i as its lowest bit says."""
        sums = np.concatenate(([0], np.cumsum(counts)))
        i = np.arange(1, len(counts) + 1)
        return [0, *(sums[i] - sums[i - (i & -i)]).tolist()]

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points before unit k begins; all of them for k units or more, none for 0."""
        if k <= 0:
            return 0, 0
        if k >= self.units:
            return len(self.raw), self.chars
        at, units, chars = 0, 0, 0
        step = 1 << (len(self.tree_units) - 1).bit_length()
        while step:
            to = at + step
            if to < len(self.tree_units) and units + self.tree_units[to] <= k:
                at, units, chars = to, units + self.tree_units[to], chars + self.tree_chars[to]
            step >>= 1
        start = at * self.block
        place = int(np.flatnonzero(self._marks(self.begins, start, start + self.block))[k - units])
        return start + place, chars + int(np.count_nonzero(_code_points(self.raw[start : start + place])))


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that depend on the seed and the id alone; a null id counts as no digits."""
    told = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(told[i : i + 4], "big") for i in (0, 4, 8, 12))


def transformed(text: bytes, drawn: tuple[int, int, int, int], unit: str, rates: Rates) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle (none if plain), and the output."""
    tree = BlockTree(text, unit)
    n = tree.units
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or any(m in text for m in marks) or drawn[2] % 100 >= rates.plain_from:
        return n, "plain", None, None, text
    (one, one_chars), (two, two_chars) = (tree.cut(k) for k in sorted(h % (n + 1) for h in drawn[:2]))
    parts = text[:one], text[two:], text[one:two]
    told = [mark + part for mark, part in zip(marks, parts, strict=True)]
    form = "spm" if drawn[3] % 100 < rates.spm_below else "psm"
    order = (1, 0, 2) if form == "spm" else (0, 1, 2)
    return n, form, one_chars, two_chars - one_chars, b"".join(told[i] for i in order)


def fill_in_middle(documents: DataFrame, *, unit: str = "code point", seed: int = 1, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output for every row of documents.

    n is the number of units. Form plain: the text as it is, prefix_chars and middle_chars null.
    Form psm: prefix, suffix, middle, each behind its mark; spm: suffix, prefix, middle. The two
    cuts, and whether and how a text is transformed, are drawn from the seed and doc_id, so
    reruns and repeated rows agree. A text that is empty or holds a mark stays plain.

    Null text: an empty one. Null doc_id: kept, drawn as an id without digits. White space before
    the first word belongs to it. Extra columns are ignored; no rows give no rows.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def told(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([*columns[:-1], columns[-1].cast(pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for ids, texts in tables.slices(batches):
            for doc, text in zip(ids.to_pylist(), texts.cast(pa.binary()), strict=True):
                got = transformed(text.as_py() or b"", draws(doc, seed), unit, rates)
                rows.append((doc, *got))
                size += len(got[-1])
                if size >= HELD:
                    yield told(rows)
                    rows, size = [], 0
        if rows:
            yield told(rows)

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The exact text that an output was made from. Null if either is null.

    A transformed text holds no mark itself, and none arises where a mark follows it, so each
    mark is where it is found.
    """

    def between(first: str, last: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(first), F.lit(2)), F.lit(last), F.lit(1))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
