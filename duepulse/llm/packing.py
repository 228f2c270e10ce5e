"""Token sequences packed by vector best-fit."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tables

#: Distinct words whose ids a worker remembers.
REMEMBERED = 150_000
#: Characters for which lower case, white space and normal form are those of Python's str.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ž]*")

#: How the tokenizer parts a text before its merges (fixed value; white space parts too).
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold: tokens, documents, and attention cost (sum of squared lengths)."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048


class Words(dict[str, bytes]):
    """Ids of texts, word by word: a word's ids don't depend on its neighbours.

    Plain words are parted as the tokenizer parts them and go straight to its merges; any other
    text goes through the whole tokenizer. What was used lately is remembered: the generation in
    use, and the one before it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.before.get(word)
        if found is None:
            parts = [word] if word.isalpha() else _PARTS.findall(word)
            if len(parts) == 1:
                ids = [token.id for token in self.merge(word if word.isascii() else word.translate(_BYTE_LETTERS))]
                found = array("I", ids).tobytes()
            else:
                found = b"".join(map(self.__getitem__, parts))
        self[word] = found
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit numbers, little-endian as the machine is."""
        out = []
        for text in texts:
            if _PLAIN.fullmatch(text) and "<|" not in text:
                out.append(b"".join(map(self.__getitem__, text.lower().split())))
            else:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes())
            if len(self) > REMEMBERED:
                self.before = dict(self)
                self.clear()
        return out


def _byte_letters() -> dict[int, str]:
    """For each plain character above ASCII, the letters that stand for its UTF-8 bytes.

    Byte-level vocabularies write a printable byte as the character of that number and the others
    as characters from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xA1, 0x180)}


_BYTE_LETTERS = _byte_letters()


def tokenized(documents: DataFrame, tokenizer_path: str, tokens: int) -> DataFrame:
    """One row per piece of at most ``tokens`` ids: doc_id, piece, start, length, ids_crc32.

    A document's ids are the tokenizer's, without special tokens, then id 0. Only longer
    documents are cut. Null text counts as empty and so is the one id 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Made for each task: a worker that goes on to other work keeps neither words nor tokenizer.
        words = Words(tokenizer_path)
        for numbers, part in tables.slices(batches):
            docs, pieces, lengths, sums = [], [], [], []
            texts = [t or "" for t in part.to_pylist()]
            for doc, ids in zip(numbers.to_pylist(), words.ids(texts), strict=True):
                ids += b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * tokens)):
                    cut = ids[at : at + 4 * tokens]
                    docs.append(doc)
                    pieces.append(piece)
                    lengths.append(len(cut) // 4)
                    sums.append(zlib.crc32(cut))
            piece = np.array(pieces, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(piece.astype(np.int32)), pa.array(piece * tokens), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        del words
        tables.release()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(
    lengths: np.ndarray, capacity: Capacity, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items go by falling length.

    Among the open bins with room in every dimension, ``norm`` takes the one whose residual
    capacity after the item has the smallest weighted norm, ``dot`` the one whose residual
    capacity has the largest weighted dot product with the item. Dimensions count in shares of
    their capacity. Ties go to the bin opened first.
    """
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=float)
    w = np.array(weights)
    order = np.argsort(-lengths, kind="stable")
    left = np.zeros((3, len(lengths)))
    used = np.zeros(len(lengths), dtype=np.int64)
    open_bins = np.zeros(0, dtype=np.int64)
    bins, offsets, count = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    shortest = lengths.min(initial=1)
    closed = 0
    for item in order:
        n = int(lengths[item])
        need = np.array([n, 1, n * n]) / full
        if (need > 1).any():
            raise ValueError("an item exceeds the capacity of an empty sequence")
        room = left[:, open_bins]
        fits = np.flatnonzero((room >= need[:, None]).all(axis=0))
        if len(fits):
            rest = room[:, fits]
            if rule == "norm":
                best = fits[np.argmin(w @ (rest - need[:, None]) ** 2)]
            elif rule == "dot":
                best = fits[np.argmax((w * need) @ rest)]
            else:
                raise ValueError("rule must be norm or dot")
            target = open_bins[best]
        else:
            target, count = count, count + 1
            left[:, target] = 1
            open_bins = np.append(open_bins, target)
        bins[item], offsets[item] = target, used[target]
        used[target] += n
        left[:, target] -= need
        left[0, target] = (capacity.tokens - used[target]) / capacity.tokens  # exact in whole tokens
        closed += left[0, target] * capacity.tokens < shortest
        if closed > 64:
            open_bins = open_bins[left[0, open_bins] * capacity.tokens >= shortest]
            closed = 0
    return bins, offsets


def pack(
    documents: DataFrame, *, tokenizer_path: str, capacity: Capacity = Capacity(), rule: str = "norm",
    shard_pieces: int = 8192,
) -> DataFrame:
    """Every piece of every document with the sequence it is in and its place there.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset. Pieces of the full
    length are sequences of their own. The others are dealt by hash into shards of about
    ``shard_pieces``, and each shard is packed by :func:`best_fit`; a shard loses at most its last
    few sequences against one packing of all.

    Null or empty text: one piece of length 1. Null and repeated doc_ids: every row is packed by
    itself. Ties between bins go to the one opened first. No rows give no rows; extra columns are
    ignored.
    """
    pieces = tables.stored(tokenized(documents, tokenizer_path, capacity.tokens))
    whole = pieces.where(F.col("length") == capacity.tokens)
    rest = pieces.where(F.col("length") < capacity.tokens)
    shards = max(1, -(-rest.count() // shard_pieces))

    def packed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("ids_crc32", "ascending"), ("piece", "ascending")])
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity, rule)
        ids = bins + (key[0].as_py() << 32)
        return rows.drop_columns(["shard"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(shards).cast("long")))
    fitted = dealt.groupBy("shard").applyInArrow(
        packed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    alone = whole.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return fitted.unionByName(alone)
