"""Line dedup over lines that repeat few words: near ones go, unlike ones aren't compared pair by pair."""

from __future__ import annotations

import random

from corpus_rows import texts
from duepulse.llm import line_dedup, tables
from test_line_rest import edits, left


def repeats(rng, mine, times):
    """Few words, each so many times, one after another or over and over."""
    words = [f"{rng.choice('abcdefghij')}{rng.randrange(1000)}" for _ in range(mine)]
    return [w for w in words for _ in range(times)] if rng.random() < 0.5 else words * times


def candidates(monkeypatch):
    """The number of rows of each table of pairs that the operator writes, once it has run."""
    counts, write = [], tables.Scratch.stored

    def stored(self, df):
        result = write(self, df)
        if result.columns == ["at", "n", "fat", "fn"]:
            counts.append(result.count())
        return result

    monkeypatch.setattr(tables.Scratch, "stored", stored)
    return counts


def test_unlike_lines_of_few_words_are_no_candidates(spark, monkeypatch):
    rng, counts = random.Random(3), candidates(monkeypatch)
    lines = [repeats(rng, 8, 30) for _ in range(160)]
    got = left(texts(spark, *[(j, " ".join(w)) for j, w in enumerate(lines)]), words_per_edit=line_dedup.WORDS_PER_EDIT)
    assert all(got.values())
    assert counts and sum(counts) <= 160


def test_near_lines_of_few_words_go(spark):
    rng = random.Random(8)
    bases = [repeats(rng, mine, times) for mine, times in ((1, 40), (2, 16), (2, 50), (3, 12), (6, 10), (16, 3), (30, 2), (50, 1))]
    lines = []
    for _ in range(120):
        w = list(rng.choice(bases))
        for _ in range(rng.choice((0, 1, 2, 3, 5, 7))):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w[at : at + (kind != 1)] = [] if kind == 2 else [rng.choice([*w, "x", f"y{rng.randrange(99)}"])]
        lines.append(w)
    for per in (line_dedup.WORDS_PER_EDIT, 7):
        gone = set()
        for j, w in enumerate(lines):
            bounds = [(v, max(1, min(len(v), len(w)) // per)) for v in lines[:j]]
            if any(abs(len(v) - len(w)) <= bound and edits(v, w) <= bound for v, bound in bounds):
                gone.add(j)
        got = left(texts(spark, *[(j, " ".join(w)) for j, w in enumerate(lines)]), words_per_edit=per)
        assert {j for j, t in got.items() if not t} == gone
        assert 20 < len(gone) < 110
