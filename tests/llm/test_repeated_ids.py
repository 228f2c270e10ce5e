"""Rows that share an id, letters, and spans that stand close: against plain Python."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from corpus_rows import documents, texts
from duepulse.llm import language, pii, samples, vector_dedup


def brute_links(rows, least=0.93):
    """(vec_id, links, component) of every (vec_id, label, vector) row, by all pairs."""
    unit = [np.array(v) / np.linalg.norm(v) for _, _, v in rows]
    near = lambda i, j: i != j and rows[i][1] == rows[j][1] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least
    n = len(rows)
    links = [sum(near(i, j) for j in range(n)) for i in range(n)]
    label = [rows[i][0] for i in range(n)]
    while True:
        after = [min(label[j] for j in range(n) if j == i or near(i, j) or rows[j][0] == rows[i][0]) for i in range(n)]
        if after == label:
            return sorted((rows[i][0], links[i], label[i], label[i] == rows[i][0]) for i in range(n))
        label = after


def test_vectors_that_share_an_id(spark):
    rng = random.Random(6)
    rows = [(1, 1, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 1, [1.0, 0.01]), (3, 2, [1.0, 0.0]), (1, 2, [0.0, 1.0])]
    rows += [(rng.randrange(10, 60), rng.choice([1, 2, 3]), [round(rng.gauss(0, 1), 1) or 0.1 for _ in range(3)]) for _ in range(160)]
    rows += [(70, 2, [1.0, 0.0]), (2, 3, [5.0, 5.0, 5.0]), (2, 3, [5.0, 5.0, 5.0])]
    df = spark.createDataFrame([(i, v, label) for i, label, v in rows], "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in vector_dedup.find_near_vectors(df).collect())
    assert got == brute_links([(i, label, [float(np.float32(x)) for x in v]) for i, label, v in rows])


def test_samples_keep_their_bound_and_their_own_labels(spark):
    rows = [(1, f"alpha beta {i}", "en" if i % 2 else "de", "s") for i in range(50)] + [(i, f"gamma {i}", "en", "s") for i in range(2, 40)]
    docs = documents(spark, rows)
    chosen = docs.select("doc_id", F.lit(1).alias("quality")).where("doc_id = 1").limit(2)
    sample = samples.gather(docs, chosen, "doc_id", "quality", 20, 1 << 10, (2,), True)
    assert 0 < len(sample) <= 20 and set(sample.ids) == {1}
    same = docs.withColumn("text", F.lit("one text")).withColumn("doc_id", F.lit(1).cast("long"))
    assert len(samples.gather(same, chosen, "doc_id", "quality", 20, 1 << 10, (2,), True)) <= 20
    known = docs.select(F.col("doc_id").alias("k"), F.col("text").alias("t"), F.when(F.col("lang") == "en", 1).otherwise(0).alias("y"))
    sample = samples.gathered(known, 1000, 1 << 10, (2,), True)
    assert len(sample) == len(rows)  # one label each
    assert samples.thinned(docs, "doc_id", 1, by="text").count() > 0  # more classes than rows asked for


def test_only_letters_are_letters(spark):
    rows = [(i, t, "en" if i % 2 else "de", "s") for i, t in enumerate(["the words of this text", "die Wörter im Text"] * 40)]
    odd = {900: "½ ² ①", 901: "٣ 4_", 902: "中", 903: "ª", 904: "— … !", 905: "Ⅻ"}
    rows += [(i, t, None, "s") for i, t in odd.items()]
    got = {r.doc_id: r.lang_pred for r in language.identify_language(documents(spark, rows)).collect()}
    assert {i for i in odd if got[i] == "und"} == {900, 901, 904, 905}


def test_context_of_many_close_matches(spark):
    rng = random.Random(9)
    pieces = ["555-123-4567", "a@b.co", "+49 301234567", "1.2.3.4", " call ", " tel: ", ", ", " ", "x" * 50, "é😀", "mail "]
    rows = [(i, "".join(rng.choices(pieces, k=rng.choice((3, 30, 200))))) for i in range(120)]
    rows += [(500, "1.2.3.4 " * 9000), (501, "call " + "555-123-4567 " * 5000)]
    got = {r.doc_id: r for r in pii.find_personal_data(texts(spark, *rows)).collect()}
    words = {k.name: k for k in pii.KINDS}
    import re

    for i, text in rows:
        spans = [s.split(":") for s in got[i].spans.split(",") if s]
        scores = got[i].scores.split(",") if spans else []
        assert len(spans) == len(scores) and got[i].found == bool(spans)
        for (kind, a, b), score in zip(spans[:300], scores[:300], strict=True):
            a, b, k = int(a), int(b), words[kind]
            around = f"{text[max(0, a - pii.NEAR):a]} {text[b:b + pii.NEAR]}".lower()
            assert float(score) == (k.with_context if re.search(k.context, around) else k.alone), (i, kind, a)
    assert got[500].n_ip == 9000 and got[501].n_local_phone == 3  # those within 40 characters of the word


def test_keys_are_told_from_digests_by_words(spark):
    key = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"
    rows = [(1, f'token = "{key}"'), (2, f"digest {key}"), (3, f"API-KEY: {key.upper()}"), (4, f"token x{key}"), (5, f"token {key[:31]}"), (6, f"token {key * 2}")]
    got = {r.doc_id: (r.n_secret, r.spans) for r in pii.find_personal_data(texts(spark, *rows)).collect()}
    assert got == {1: (1, "secret:9:49"), 2: (0, ""), 3: (1, "secret:9:49"), 4: (0, ""), 5: (0, ""), 6: (0, "")}
