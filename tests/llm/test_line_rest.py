"""Line dedup: short lines, bounds that grow with the line, rows without an id or with equal ones."""

from __future__ import annotations

import random

from corpus_rows import texts
from duepulse.llm import line_dedup


def left(df, **how):
    return {r.doc_id: r.text for r in line_dedup.dedup_lines(df, **how).collect()}


def test_copies_of_short_lines_go(spark):
    rows = texts(spark, (1, "Read more\n}\n\nfirst of all"), (2, "read  MORE\n\n}\nTop\nFirst of all"), (3, "Top"))
    assert left(rows) == {1: "Read more\n}\n\nfirst of all", 2: "\nTop", 3: ""}
    floor = left(rows, least_words=3)
    assert floor == {1: "Read more\n}\n\nfirst of all", 2: "read  MORE\n\n}\nTop", 3: "Top"}


def test_rows_that_share_an_id_or_have_none_lose_their_own_lines(spark):
    again, own = "the same line again", "only here {}"
    rows = texts(spark, (1, again), (None, f"{again}\n{own.format('a b')}"), (None, f"{own.format('c d')}\nx y z"),
                 (7, f"{own.format('e f')}\n{own.format('g h')}"), (7, f"{again}\n{own.format('i j')}"), (7, f"{own.format('k l')}\nx y z"),
                 (None, "twice without id"), (None, "twice without id"))
    got = sorted(((r.doc_id, r.text) for r in line_dedup.dedup_lines(rows, drop_emptied=True).collect()), key=repr)
    assert [x for x in got if x[0] is None] == [(None, t) for t in ("only here a b", "only here c d", "twice without id")]
    assert sorted(x for x in got if x[0]) == [(1, again), (7, own.format("e f") + "\n" + own.format("g h")),
                                              (7, own.format("i j")), (7, own.format("k l") + "\nx y z")]
    report = line_dedup.line_report(rows)
    assert report.count() == 8 and report.agg({"n_removed": "sum"}).first()[0] == 4


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bound_grows_with_the_line(spark):
    rng = random.Random(5)
    bases = [[f"{rng.choice('abcdefghij')}{rng.randrange(30)}" for _ in range(n)] for n in (4, 6, 11, 15, 20, 31, 32, 33, 47, 48, 64, 100)]
    passage = [f"p{k}" for k in range(12)]
    lines = []
    for _ in range(180):
        w = list(rng.choice(bases))
        for _ in range(rng.choice((0, 1, 1, 2, 3, 4, 6, 8))):
            at = rng.randrange(len(w))
            kind = rng.randrange(3)
            w[at : at + (kind != 1)] = [] if kind == 2 and len(w) > 3 else [rng.choice("xyz")]
        lines.append(w)
    for _ in range(20):  # a run that unlike lines share
        lines.append([f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(12, 30))] + passage + [f"r{rng.randrange(10**6)}"] * 12)
    for per, near in ((line_dedup.WORDS_PER_EDIT, line_dedup.LEAST_NEAR_WORDS), (6, 5), (None, 4)):
        gone = set()
        for j, w in enumerate(lines):
            for v in lines[:j]:
                short = min(len(v), len(w))
                bound = (max(1, short // per) if per else 1) if short >= near else 0
                if v == w or abs(len(v) - len(w)) <= bound and edits(v, w) <= bound:
                    gone.add(j)
                    break
        got = left(texts(spark, *[(j, " ".join(w)) for j, w in enumerate(lines)]), words_per_edit=per, least_near_words=near)
        assert {j for j, t in got.items() if not t} == gone
