"""Context words of personal data that stands close together."""

from __future__ import annotations

from corpus_rows import texts
from duepulse.llm import pii


def test_context_reaches_over_neighbouring_matches(spark):
    rows = [(1, "call 555-123-4567, 555-765-4321"), (2, "555-123-4567 555-765-4321 tel"), (3, "mail a@b.c, d@e.f"),
            (4, "call " + "x" * 40 + " 555-123-4567"), (5, "call" + " " * 35 + " 555-123-4567, 555-765-4321")]
    got = {r.doc_id: (r.spans, r.scores) for r in pii.find_personal_data(texts(spark, *rows)).collect()}
    assert got[1] == ("local_phone:5:17,local_phone:19:31", "0.8,0.8")
    assert got[2] == ("local_phone:0:12,local_phone:13:25", "0.8,0.8")
    assert got[3] == ("email:5:10,email:12:17", "1.0,1.0")
    assert got[4] == ("", "")
    assert got[5] == ("local_phone:40:52", "0.8")
