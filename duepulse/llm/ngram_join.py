"""Exact Jaccard self-join of word shingle sets: size-aware, with a light and a heavy side.

Sets up to a boundary size are light: they emit all their subsets of every size that the
intersection with a partner can have, and meet partners in an equal subset. Larger sets are
heavy: listing subsets would cost too much, so they meet in inverted lists. A list of one shingle
would be as long as the shingle is frequent; a list here is that of a block, all of a set's
shingles in one of m fixed ranges of the hash space. A pair that is similar enough differs in at
most k shingles, which spoil at most k blocks, so with m > k blocks one is equal in both. With
m = k + 1 + s, s + 1 are, and each set can leave out the s blocks that hold the least: of the
equal ones that with the most is kept in both. Blocks of a single shingle, which any two texts with
a sentence in common share, are mostly left out by that. The boundary is the largest size at which
subsets cost less than blocks and verification.

Keys only propose. Documents that share a key, directly or through others, form a candidate
group; within it all pairs of near sizes are verified on the whole sets, in blocks of bounded
size that tasks take independently. Only the links' spanning forests leave a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import ceil, comb, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shingles, tables
from .components import components, contracting

#: Sets of one candidate group and size class that are verified together.
CHUNK = 1024
#: Candidates (two longs each) are broadcast up to this count, else joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: Keys that are combined in a task before they are sent.
HELD_KEYS = 1 << 18
_CLASS_RATIO = 1.25


class Scheme:
    """Which keys a set emits so that every pair with Jaccard >= percent/100 shares one."""

    def __init__(self, percent: int) -> None:
        if not 50 <= percent <= 100:
            raise ValueError("percent must be from 50 to 100")
        self.percent = percent
        self.boundary = next(s for s in range(1, 10_000) if self.subset_cost(s + 1) > self.block_cost(s + 1))
        self._edges: dict[int, tuple[np.ndarray, int]] = {}

    def least(self, size: int) -> int:
        """The smallest intersection, and partner, that a set of this size can link with."""
        return -(-self.percent * size // 100)

    def subset_cost(self, size: int) -> int:
        return sum(comb(size, f) for f in range(self.least(size), size + 1))

    def block_cost(self, size: int) -> int:
        """Blocks that are kept of the set's own class and the one below, and the set itself for verification."""
        return 2 * (self._differing(size) + 3) + size

    def _differing(self, size: int) -> int:
        """Shingles in which a set of this size and a partner as large or larger can differ."""
        return (100 - self.percent) * size // self.percent

    def _class(self, size: int) -> int:
        return int(log(size / (self.boundary + 1)) / log(_CLASS_RATIO) + 1e-9)

    def _blocks(self, number: int) -> tuple[np.ndarray, int]:
        """Inner limits of a size class's blocks, and how many of them are left out or may be empty."""
        if number not in self._edges:
            low = max(1, int((self.boundary + 1) * _CLASS_RATIO**number))
            high = int((self.boundary + 1) * _CLASS_RATIO ** (number + 1)) + 1
            needed = self._differing(high) + 1
            spare = 2 + max(needed // 2, ceil(1.5 * needed * exp(-low / needed)))
            m = needed + spare
            self._edges[number] = np.array([(i << 64) // m for i in range(1, m)], dtype=np.uint64), spare
        return self._edges[number]

    def keys(self, h: np.ndarray) -> np.ndarray:
        """Keys of a set given as sorted distinct hashes."""
        size = len(h)
        if not size:
            return h
        out = []
        if size <= 100 * self.boundary // self.percent:
            whole, each = h.sum(dtype=np.uint64), h
            for f in range(self.least(size), min(size, self.boundary) + 1):
                left_out = np.array(list(combinations(range(size), size - f)), dtype=np.int64).reshape(comb(size, f), size - f)
                out.append(shingles.mixed(whole - each[left_out].sum(axis=1, dtype=np.uint64) + np.uint64(f)))
        if size > self.boundary:
            sums = np.concatenate(([np.uint64(0)], np.cumsum(shingles.mixed(h))))
            sparse = False
            for number in range(self._class(max(self.boundary + 1, self.least(size))), self._class(size) + 1):
                limits, spare = self._blocks(number)
                at = np.concatenate(([0], np.searchsorted(h, limits, side="left"), [size]))
                held = np.diff(at)
                filled = np.flatnonzero(held)
                salt = (filled + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(number)
                blocks = shingles.mixed((sums[at[filled + 1]] - sums[at[filled]]) ^ salt)
                # The least go, empty ones first; in the same order in every set.
                empty = len(held) - len(filled)
                out.append(blocks[np.lexsort((blocks, held[filled]))[max(0, spare - empty) :]])
                sparse |= empty > spare
            if sparse:  # two such sets might agree in empty blocks only: lists of their first shingles
                out.append(shingles.mixed(h[: size - self.least(size) + 1] ^ np.uint64(0xA0761D6478BD642F)))
        return np.unique(np.concatenate(out))


def _combined(keys: np.ndarray, marks: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    """One row per key and mark with its smallest document, and at their mark, its pairs with the others.

    A document's mark is its smallest key. Documents with equal marks meet in that key's list,
    so no other list needs more than one of them.
    """
    order = np.lexsort((docs, marks, keys))
    keys, marks, docs = keys[order], marks[order], docs[order]
    first = np.concatenate(([True], (keys[1:] != keys[:-1]) | (marks[1:] != marks[:-1]))) if len(keys) else np.zeros(0, bool)
    heads = docs[first][np.cumsum(first) - 1] if len(keys) else docs
    pairs = np.unique(np.column_stack((heads, docs))[(heads != docs) & (keys == marks)], axis=0)
    links = shingles.mixed(pairs[:, 0].astype(np.uint64) * np.uint64(31) + pairs[:, 1].astype(np.uint64)).view(np.int64)
    n, m = int(first.sum()), len(pairs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((keys[first].view(np.int64), links))),
            pa.array(np.concatenate((marks[first].view(np.int64), links))),
            pa.array(np.concatenate((docs[first], pairs[:, 0]))),
            pa.array(np.concatenate((np.zeros(n, np.int64), pairs[:, 1])), mask=np.arange(n + m) < n),
        ],
        names=["key", "mark", "low", "high"],
    )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and mark: the pairs that come with them, and each key's first document
    with the first of its other marks; at a key's own mark, with all."""
    last_key, last_mark, head = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        paired = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
        keys, marks, low = (batch.column(i).to_numpy() for i in range(3))
        pairs = [np.column_stack((low[paired], batch.column(3).filter(pa.array(paired)).to_numpy()))]
        keys, marks, low = keys[~paired], marks[~paired], low[~paired]
        if len(keys):
            new_key = np.concatenate(([keys[0] != last_key], keys[1:] != keys[:-1]))
            new_mark = new_key | np.concatenate(([marks[0] != last_mark], marks[1:] != marks[:-1]))
            # The first row of a key leads it; without one here, the key goes on from the last batch.
            led = np.cumsum(new_key)
            heads = np.concatenate(([head], low[new_key]))[led]
            meets = ~new_key & (new_mark | (keys == marks))
            pairs.append(np.column_stack((heads, low))[meets])
            last_key, last_mark, head = keys[-1], marks[-1], heads[-1]
        both = np.concatenate(pairs).astype(np.int64)
        both = np.unique(np.sort(both[both[:, 0] != both[:, 1]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _count_common(sets: list[np.ndarray], overlap: np.ndarray) -> None:
    """Adds to ``overlap`` how many values each two of the sets have in common."""
    n = len(sets)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    column = (np.cumsum(shared) - 1)[inverse]
    row = np.repeat(np.arange(n), [len(x) for x in sets])
    keep = shared[inverse]
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(64, (1 << 21) // n)
    for start in range(0, int(shared.sum()), width):
        at = slice(*np.searchsorted(column, (start, start + width)))
        part = np.zeros((n, min(width, int(shared.sum()) - start)), dtype=np.float32)
        part[row[at], column[at] - start] = 1
        overlap += part @ part.T


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the number of the first one that it is linked with, directly or through others."""
    n, sizes = len(sets), np.array([len(x) for x in sets])
    overlap = np.zeros((n, n), dtype=np.float32)
    # The hash space in ranges, so that few shingles are numbered at once.
    ranges = max(1, -(-int(sizes.sum()) // HELD_KEYS))
    limits = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)
    cuts = np.stack([np.concatenate(([0], np.searchsorted(x, limits), [len(x)])) for x in sets])
    for i in range(ranges):
        _count_common([x[c[i] : c[i + 1]] for x, c in zip(sets, cuts, strict=True)], overlap)
    links = np.empty((n, n), dtype=bool)
    rows = [slice(i, i + 128) for i in range(0, n, 128)]  # few wide numbers at once
    for r in rows:
        common = overlap[r].astype(np.int64)
        links[r] = 100 * common >= percent * (sizes[r, None] + sizes[None, :] - common)
    np.fill_diagonal(links, True)
    label = np.arange(n)
    while True:
        after = np.concatenate([np.where(links[r], label[None, :], n).min(axis=1) for r in rows])
        after = after[after]
        if (after == label).all():
            return label
        label = after


def streamed_groups(
    names: list[str], work: Callable[[list[tuple]], tuple[np.ndarray, np.ndarray]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows sorted by their first column: calls work with each group's rows, gives pairs (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        out_a, out_b, size = [], [], 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if row[0] != group:
                    if len(held) > 1:
                        a, b = work(held)
                        out_a.append(a)
                        out_b.append(b)
                        size += len(a)
                    group, held = row[0], []
                held.append(row)
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])
                out_a, out_b, size = [], [], 0
        if len(held) > 1:
            a, b = work(held)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def join_ngrams(documents: DataFrame, *, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of documents.

    Words are runs without white space, A to Z lower-cased; a set has the distinct shingles of
    ``width`` words, or the whole sequence where there are fewer. Two documents link when
    100 * |intersection| >= percent * |union|. component_id is the smallest doc_id reachable by
    links, itself included.

    Null or empty text, or no words: an empty set, linked with nothing. Null doc_id: kept with a
    null component. Rows with equal doc_id are one node, with the links of all its texts. Equal
    sets link. Extra columns are ignored; an empty table gives no rows.
    """
    scheme = Scheme(percent)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, marks, docs, size = [], [], [], 0
        for ids, part in tables.slices(batches):
            for doc, h in zip(ids.to_pylist(), shingles.sets(part.to_pylist(), width), strict=True):
                k = scheme.keys(h)
                keys.append(k)
                marks.append(np.full(len(k), k[0] if len(k) else 0, dtype=np.uint64))
                docs.append(np.full(len(k), doc, dtype=np.int64))
                size += len(k)
                if size >= HELD_KEYS:
                    yield _combined(np.concatenate(keys), np.concatenate(marks), np.concatenate(docs))
                    keys, marks, docs, size = [], [], [], 0
        if size:
            yield _combined(np.concatenate(keys), np.concatenate(marks), np.concatenate(docs))

    proposed = (
        texts.where("doc_id is not null").mapInArrow(keyed, "key long, mark long, low long, high long")
        .repartition("key").sortWithinPartitions("key", "mark").mapInArrow(contracting(_stars), "a long, b long")
    )
    groups = components(proposed, contracted=True)
    few = groups.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    groups = groups.select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, part, of in tables.slices(batches):
            sizes, prints, blobs = [], [], []
            for group, h in zip(of.to_pylist(), shingles.sets(part.to_pylist(), width), strict=True):
                sizes.append(len(h))
                some = group is not None
                blobs.append(h.tobytes() if some else None)
                prints.append(int(shingles.mixed(h).sum(dtype=np.uint64).view(np.int64)) if some else None)
            yield pa.RecordBatch.from_arrays(
                [ids, of, pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), pa.array(blobs, pa.binary())],
                names=["doc_id", "grp", "n_shingles", "print", "elements"],
            )

    scratch = tables.Scratch(documents.sparkSession)
    rows = scratch.stored(
        texts.join(F.broadcast(groups) if few else groups, "doc_id", "left").select("doc_id", "text", "grp")
        .mapInArrow(sized, "doc_id long, grp long, n_shingles long, print long, elements binary")
    )
    candidates = rows.where("grp is not null")
    same = ["grp", "n_shingles", "print"]
    distinct = candidates.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    copies = candidates.select("doc_id", *same).join(distinct, same)
    copies = copies.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    dealt = scratch.stored(_dealt(distinct, percent))
    dealt_few = dealt.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    sets = candidates.select(F.col("doc_id").alias("rep"), "n_shingles", "print", "elements")
    parts = sets.join(F.broadcast(dealt) if dealt_few else dealt, ["rep", "n_shingles", "print"]).select("part", "rep", "elements")

    def verified(held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array([row[1] for row in held], dtype=np.int64)
        order = np.argsort(ids, kind="stable")
        label = _linked([np.frombuffer(held[i][2], dtype=np.uint64) for i in order], percent)
        ids = ids[order]
        moved = np.flatnonzero(ids[label] != ids)
        return ids[moved], ids[label[moved]]

    links = (
        parts.repartition("part").sortWithinPartitions("part")
        .mapInArrow(contracting(streamed_groups(["part", "rep", "elements"], verified)), "a long, b long")
    )
    found = components(links.unionByName(copies), contracted=True).select(F.col("node").alias("doc_id"), "component")
    result = rows.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    return scratch.settled(result.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def _dealt(distinct: DataFrame, percent: int) -> DataFrame:
    """Sets with the parts they are verified in; two sets of a group and near sizes share one.

    A small group is one part. A large one is cut by size class and, within a class, by hash
    into chunks; a part is a pair of chunks of the same or neighbouring classes. Only counts are
    gathered by group.
    """
    ratio = 100 / (percent - 0.1)
    sizes = distinct.select("grp", "rep", "n_shingles", "print", F.floor(F.log("n_shingles") / log(ratio)).cast("int").alias("cls"))
    counted = sizes.groupBy("grp", "cls").agg(F.count(F.lit(1)).alias("n"))
    parts = counted.groupBy("grp").agg(
        F.sum("n").alias("members"),
        F.map_from_entries(F.collect_list(F.struct("cls", F.ceil(F.col("n") / CHUNK).cast("int")))).alias("parts"),
    ).where(F.col("members") > CHUNK)
    cut = sizes.join(parts, "grp", "left")

    def chunks(cls: Column) -> Column:
        return F.coalesce(F.try_element_at("parts", cls), F.lit(0))

    own = F.pmod(F.xxhash64("rep"), chunks(F.col("cls"))).cast("int")
    cut = cut.withColumn("own", F.when(F.col("parts").isNotNull(), own))

    def pairs(step: int, name: Callable[[Column], tuple]) -> Column:
        n = chunks(F.col("cls") + step)
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.xxhash64("grp", *name(x)))).otherwise(F.array().cast("array<bigint>"))

    mine = F.col("own")
    several = F.concat(
        pairs(0, lambda x: (F.col("cls"), F.least(mine, x), F.lit(0), F.greatest(mine, x))),
        pairs(1, lambda x: (F.col("cls"), mine, F.lit(1), x)),
        pairs(-1, lambda x: (F.col("cls") - 1, x, F.lit(1), mine)),
    )
    in_parts = F.when(F.col("parts").isNull(), F.array(F.xxhash64("grp"))).otherwise(several)
    return cut.select(F.explode(in_parts).alias("part"), "rep", "n_shingles", "print")
