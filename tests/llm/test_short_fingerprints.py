"""Fingerprints of short texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpus_rows import texts
from duepulse.llm import fingerprints


def test_few_short_texts_have_no_fingerprint(spark):
    rows = texts(spark, *[(i, " ".join(f"w{i}x{k}" for k in range(12))) for i in range(400)])
    got = fingerprints.fingerprint(rows)
    # Eight shingles: one text in 256 keeps none of them, where one in three did at 1/8.
    assert got.where(F.col("fingerprint") == "").count() <= 10
    assert got.where("near_edited > 0").count() >= 300
