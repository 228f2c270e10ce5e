"""Personal data, line dedup and fingerprints against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from corpus_rows import documents, texts
from duepulse.llm import fingerprints, line_dedup, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for order, kind, pattern in ((0, "email", EMAIL), (1, "ip", IP), (2, "card", CARD), (3, "phone", PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def test_personal_data_against_plain_patterns(spark):
    rng = random.Random(8)
    pieces = ["a@b.c", "%d@e.f", "x.y@z-w.org", "1.2.3.4", ".5.6.7.8", "256.1.1.1", "0001.2.3.255", "4111 1111 1111 1111",
              "4111-1111-1111-1112", "+1 (168) 555-5254", "+12", "é😀", " ", "\n", ",", "@", ".", "+49 30 1234567.", "5", "-", "word"]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 25)))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "a." * 20_000 + "@"), (903, "x@" + "a." * 20_000 + "b"), (904, "1 " * 20_000),
             (905, "+1" + " " * 20_000), (906, "7" * 20_000 + ".1.1.1"), (907, "w" * 100_000), (1, "b@c.d"), (None, "d@e.f")]
    got = sorted(map(tuple, pii.find_personal_data(texts(spark, *rows)).collect()), key=repr)
    want = []
    for i, text in rows:
        spans = base_spans(text or "") if i != 906 else []
        told = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        counts = [sum(s[3] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        want.append((i, *counts, hashlib.sha256(told.encode()).hexdigest()))
    assert [r[:6] for r in got] == sorted(want, key=repr)


def test_added_kinds_and_scores(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00."), (2, "DE89 3704 0044 0532 0130 01"), (3, "call 555-123-4567"),
            (4, "part 555-123-4567"), (5, "GB82WEST12345698765432 and a@b.c")]
    got = {r.doc_id: (r.spans, r.scores) for r in pii.find_personal_data(texts(spark, *rows)).collect()}
    assert got[1] == ("iban:5:32", "1.0")
    assert got[2][0] == "" and got[4][0] == ""
    assert got[3] == ("local_phone:5:17", "0.8")
    assert got[5][0] == "iban:0:22,email:27:32"
    assert pii.find_personal_data(texts(spark, (1, "")).limit(0)).collect() == []


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def dedup_plain(rows):
    """Texts left, by checking every line against every earlier one."""
    lines = []
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            w = WORD.findall(line.lower())
            if len(w) >= line_dedup.LEAST_WORDS:
                lines.append((i, k, w))
    first = {}
    for i, k, w in sorted(lines, key=lambda x: x[:2]):
        first.setdefault(tuple(w), (i, k))
    near = line_dedup.LEAST_NEAR_WORDS
    gone = {
        w for w, at in first.items() if len(w) >= near
        and any(v != w and len(v) >= near and first[v] < at and one_edit(v, w) for v in first)
    }
    drop = {(i, k) for i, k, w in lines if first[tuple(w)] != (i, k) or tuple(w) in gone}
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in drop) for i, t in rows}


def test_lines_against_all_pairs(spark):
    rng = random.Random(3)
    lines = [[rng.choice("abcdefgh") for _ in range(rng.choice((3, 5, 12, 13, 14)))] for _ in range(12)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            w = list(rng.choice(lines))
            for _ in range(rng.choice((0, 0, 1, 2))):
                at = rng.randrange(len(w))
                kind = rng.randrange(3)
                w[at : at + (kind != 1)] = [] if kind == 2 else [rng.choice("xyz")]
            text.append(rng.choice((" ", "  ", "\t")).join(w).upper() if rng.random() < 0.2 else " ".join(w))
        rows.append((i, "\n".join(text)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, " ".join("pq" * 700) + "\n" + "x" * 50_000)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(texts(spark, *rows)).collect()}
    assert got == dedup_plain(rows)
    report = {r.doc_id: r for r in line_dedup.line_report(texts(spark, *rows)).collect()}
    for i, text in rows:
        left = got[i]
        assert report[i].text_left == left
        assert report[i].n_lines == (0 if text is None else text.count("\n") + 1)


def test_lines_of_odd_tables(spark):
    assert line_dedup.dedup_lines(texts(spark, (1, "")).limit(0)).collect() == []
    line = "one two three four five"
    docs = documents(spark, [(None, line, None, None), (3, line, "en", "s"), (3, line, "en", "s"), (5, f"{line}\nkept", "en", "s")])
    left = sorted(((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect()), key=repr)
    assert left == sorted([(None, ""), (3, line), (3, line), (5, "kept")], key=repr)
    kept = line_dedup.dedup_lines(docs, drop_emptied=True)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 3, 5]
    assert {r.n_chars for r in kept.where("doc_id = 5").collect()} == {4}


def shingle_set(text):
    w = WORD.findall(text)
    k = fingerprints.WIDTH
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("bucket_rows", [1, 7, 4096])
def test_fingerprints(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", bucket_rows)
    rng = random.Random(9)
    ids = rng.sample(range(-50, 5000), 60)
    rows = [(i, " ".join(rng.choices(["aé", "b", "c😀", "dd"], k=rng.randint(0, 300)))) for i in ids]
    rows[3], rows[4] = (rows[3][0], None), (rows[4][0], "")
    rows.append((9000, rows[10][1]))
    rows.append((9001, rows[10][1]))
    got = {r.doc_id: r for r in fingerprints.fingerprint(texts(spark, *rows)).collect()}
    rows = sorted((i, t or "") for i, t in rows)
    assert got.keys() == dict(rows).keys()
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if text == after:
            assert r.near_next == 1
        kept = [h for h in r.fingerprint.split(",") if h]
        assert all(int(h, 16) >> 1 < (1 << 63) // fingerprints.SCALE for h in kept)
        assert len(kept) <= len(shingle_set(text))
    assert got[9000].fingerprint == got[9001].fingerprint
    # One hash in SCALE stays on the whole.
    total = len(set().union(*(shingle_set(t) for _, t in rows)))
    stayed = len({h for i, _ in rows for h in got[i].fingerprint.split(",") if h})
    assert 0.6 * total / fingerprints.SCALE < stayed < 1.4 * total / fingerprints.SCALE


def test_fingerprints_estimate_containment_of_unequal_texts(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    long = [str(rng.random()) for _ in range(6000)]
    small = long[1000:2200]
    df = spark.createDataFrame([(" ".join(long), " ".join(small), " ".join(long + small))], "a string, b string, both string")
    a, b = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    row = df.select(
        fingerprints.containment(a, b).alias("c"), F.size(a).alias("n"),
        F.size(F.array_except(fingerprints.merged(a, b), fingerprints.sketch(F.col("both")))).alias("lost"),
    ).first()
    assert row.c > 0.97
    assert 600 < row.n < 900 and row.lost == 0


def test_fingerprints_of_odd_tables(spark):
    assert fingerprints.fingerprint(texts(spark, (1, "")).limit(0)).collect() == []
    (alone,) = fingerprints.fingerprint(texts(spark, (1, "abcd"))).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    got = fingerprints.fingerprint(texts(spark, (None, "abcd"), (2, "wxyz"), (2, "wxyz"))).collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(hashlib.sha256(x).hexdigest() for x in (b"ab", b"wxwx", b"wxwx"))
