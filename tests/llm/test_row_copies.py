"""The pipeline's near-copy stage on rows that share an id or have none."""

from __future__ import annotations

import corpus_pipeline
from corpus_rows import SF_SMALL, texts


def test_one_row_of_each_group_stays(spark):
    words = [f"w{k}" for k in range(80)]
    text, near = " ".join(words), " ".join(words[:-1])
    other = " ".join(reversed(words))
    rows = [(None, text), (5, near), (5, text), (9, text), (None, other), (None, other), (7, "alone"), (7, "another one"),
            (None, "no id"), (3, None), (3, None), (8, "twice given"), (8, "twice given")]
    docs = texts(spark, *rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    of_five = [t for i, t in got if i == 5]
    assert len(of_five) == 1 and of_five[0] in (near, text)
    rest = [(None, other), (None, "no id"), (7, "alone"), (7, "another one"), (3, None), (3, None), (8, "twice given")]
    assert [x for x in got if x[0] != 5] == sorted(rest, key=repr)
    plain = texts(spark, (4, text), (2, near), (6, other))
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, plain, SF_SMALL).collect()) == [2, 6]
