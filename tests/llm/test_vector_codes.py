"""Vector codes and their tree against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from duepulse.llm import vector_codes
from duepulse.llm.gnat import Gnat, ceil_root, floor_root

SCHEMA = "vec_id long, embedding array<float>, label int, code string, whole long, error string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def brute(rows, entries=256, parts=4, rounds=4):
    """Codes and errors of (vec_id, vector, label) rows, all of one dimension the parts divide."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), e) for e, y in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for _, v, _ in kept:
                of.setdefault(near(p, cut(v)[p])[1], []).append(cut(v)[p])
            for e, xs in of.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    out, sums = [], {}
    for i, v, label in kept:
        found = [near(p, cut(v)[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[label], digest) for i, c, e, label in out), key=repr)


@pytest.mark.parametrize("width,entries,most", [(16, 200, 300), (2, 256, 5), (1, 50, 3), (3, 7, 9), (8, 120, 2**24 - 1), (5, 90, 0)])
def test_the_tree_finds_the_nearest_entry_and_the_lower_of_equals(width, entries, most):
    rng = np.random.default_rng(width)
    points = rng.integers(-most, most + 1, (entries, width))
    rows = np.concatenate([rng.integers(-most, most + 1, (500, width)), points, points[:1] * 0])
    index, squares = Gnat(points).nearest(rows)
    every = ((rows[:, None].astype(object) - points[None].astype(object)) ** 2).sum(axis=2)
    assert squares.tolist() == every.min(axis=1).tolist()
    assert index.tolist() == [int(np.flatnonzero(e == e.min())[0]) for e in every]


def test_the_tree_leaves_subtrees_out_where_entries_cluster():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(-5, 6, (32, 8)) + 1000 * rng.integers(-3, 4, 8) for _ in range(8)])
    tree = Gnat(points)
    tree.nearest(points[rng.integers(0, 256, 400)] + rng.integers(-3, 4, (400, 8)))
    assert tree.visits < 0.35 * 400 * 256


def test_roots_are_exact():
    squares = np.array([0, 1, 2, 3, 4, 8, 9, 10, (1 << 30) ** 2 - 1, (1 << 30) ** 2, (1 << 30) ** 2 + 1, (3037000499 // 2) ** 2 - 1])
    assert floor_root(squares).tolist() == [math.isqrt(int(s)) for s in squares]
    assert ceil_root(squares).tolist() == [math.isqrt(int(s) - 1) + 1 if s else 0 for s in squares]


def test_codes_against_plain_python(spark):
    rng = random.Random(11)
    rows = [(i, [round(rng.gauss(0, 0.2), 3) for _ in range(8)], rng.choice([0, 0, 1, 2, None])) for i in range(320)]
    rows += [(900 + i, rows[i][1], 1) for i in range(20)]  # equal vectors
    rows += [(7, rows[3][1], 0), (7, rows[5][1], 0), (None, rows[9][1], None), (950, None, 1), (951, [None] * 8, 1),
             (952, [float("nan")] + [0.0] * 7, 1), (953, [float("inf")] + [0.0] * 7, 1), (954, [-1e3, 1e-30, -1e-30, 0.0, 1.0, -1.0, 2.0, 3.5], 2)]
    rng.shuffle(rows)
    got = sorted(map(tuple, vector_codes.compress(table(spark, rows).repartition(5)).collect()), key=repr)
    assert got == brute(rows)


def test_few_vectors_and_few_entries(spark):
    rows = [(i, [float(i % 3), float(i)], None) for i in range(9)]
    got = sorted(map(tuple, vector_codes.compress(table(spark, rows), parts=2, entries=4, rounds=2).collect()), key=repr)
    assert got == brute(rows, entries=4, parts=2, rounds=2)
    assert {r[3] for r in got} == {sum(r[2] for r in got)}  # null labels together


def test_other_dimensions_have_no_code(spark):
    rows = [(1, [1.0, 2.0, 3.0], 0), (2, [1.0, 2.0, 4.0], 0), (3, [], 0), (4, [1.0], 0), (0, [], 1)]
    got = {r["vec_id"]: r for r in vector_codes.compress(table(spark, rows)).collect()}
    assert (got[1]["code"], got[1]["error"], got[1]["label_error"]) == ("00000000", 0, 0)
    assert got[2]["code"] == "00000100"
    for i in (0, 3, 4):
        assert got[i]["code"] is None and got[i]["error"] is None
    assert got[0]["label_error"] is None


def test_empty_tables_and_tables_without_components(spark):
    assert vector_codes.compress(table(spark, [])).count() == 0
    assert vector_codes.compress(table(spark, [(1, None, 1)])).count() == 0
    assert [tuple(r)[:4] for r in vector_codes.compress(table(spark, [(1, [], 1)])).collect()] == [(1, None, None, None)]


def test_a_component_that_is_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(table(spark, [(1, [1e30, 0.0, 0.0, 0.0], 1)])).collect()


def test_decoded_vectors_are_the_entries(spark):
    rows = [(i, [i / 8, -i / 8, i / 4, 0.5], 0) for i in range(6)]
    whole = vector_codes.whole_vectors(table(spark, rows))
    books = vector_codes.learn(whole)
    got = {r["vec_id"]: r["approximate"] for r in vector_codes.decode(vector_codes.encode(whole, books), books).collect()}
    assert got == {i: v for i, v, _ in rows}  # as many entries as vectors: nothing is lost
