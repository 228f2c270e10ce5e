"""Fill-in-the-middle against plain string cuts, and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from corpus_rows import texts
from duepulse.llm import fill_in_middle as fim
from pyspark.sql import functions as F

PATTERNS = {"code point": r"(?s).", "word": r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "line": r"[^\n]*\n|[^\n]+"}


def plain(doc_id, text, unit="code point", seed=1):
    text = text or ""
    told = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(told[i : i + 8], 16) for i in (0, 8, 16, 24)]
    begins = [m.start() for m in re.finditer(PATTERNS[unit], text)]
    n = len(begins)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    at = [0 if k == 0 else begins[k] if k < n else len(text) for k in sorted(x % (n + 1) for x in h[:2])]
    prefix, middle, suffix = text[: at[0]], text[at[0] : at[1]], text[at[1] :]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", at[0], at[1] - at[0], f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", at[0], at[1] - at[0], f"<P>{prefix}<S>{suffix}<M>{middle}")


def rows():
    rng = random.Random(3)
    pieces = ["a", "é", "😀", " ", "\n", "<", "<S", "P>", "word ", "\t", "\r\n", "　", "ß", "<M"]
    made = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 40)))) for i in range(300)]
    made += [(1000 + i, "".join(rng.choices(pieces, k=20_000))) for i in range(6)]
    made += [(2000, None), (2001, ""), (2002, "x<M>y"), (2003, "<P>"), (2004, " "), (2005, "\n\n"), (2006, "é" * 2048 + "a" * 4096),
             (2007, "w" * 300_000), (2008, " " * 9000 + "w"), (3, "again"), (3, "again"), (None, "no id"), (None, None)]
    return made


@pytest.mark.parametrize("unit", sorted(PATTERNS))
def test_against_plain_cuts(spark, unit):
    got = fim.fill_in_middle(texts(spark, *rows()), unit=unit).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain(i, t, unit) for i, t in rows()), key=repr)


def test_outputs_give_the_text_back(spark):
    docs = texts(spark, *rows())
    for unit, seed in (("code point", 1), ("word", 2), ("line", 3)):
        made = fim.fill_in_middle(docs, unit=unit, seed=seed)
        got = made.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("t")).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(((i, t or "") for i, t in rows()), key=repr)
        assert {r["form"] for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_the_tree_at_every_cut(block):
    text = "aé😀 \nword  w\n\n é😀😀x" * 3
    for unit, pattern in PATTERNS.items():
        begins = [m.start() for m in re.finditer(pattern, text)]
        tree = fim.BlockTree(text.encode(), unit, block)
        assert (tree.units, tree.chars) == (len(begins), len(text))
        for k in range(len(begins) + 2):
            at = 0 if k == 0 else begins[k] if k < len(begins) else len(text)
            assert tree.cut(k) == (len(text[:at].encode()), at), (unit, k)


def test_rates_and_units_are_parameters(spark):
    docs = texts(spark, *[(i, "one two three") for i in range(60)])
    forms = lambda **x: {r["form"] for r in fim.fill_in_middle(docs, **x).collect()}
    assert forms(rates=fim.Rates(plain_from=0)) == {"plain"}
    assert forms(rates=fim.Rates(plain_from=100, spm_below=100)) == {"spm"}
    assert forms(rates=fim.Rates(plain_from=100, spm_below=0)) == {"psm"}
    with pytest.raises(ValueError, match="unit"):
        fim.fill_in_middle(docs, unit="token")


def test_no_rows(spark):
    assert fim.fill_in_middle(texts(spark)).count() == 0
