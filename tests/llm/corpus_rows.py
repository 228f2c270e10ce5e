"""What the tests of the training-data operators share: small tables with clashing columns."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"

#: Extra columns whose names the operators use themselves.
CLASHING = "size long, severity string, h string, component_id string, w string, n long"


def documents(spark, rows, clashing=True):
    """Rows (doc_id, text, lang, source) as a documents table, with extra columns of clashing names."""
    full = [(i, t, lang, source, None if t is None else len(t), *([7, "x", "y", "z", "w", 1] if clashing else [])) for i, t, lang, source in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(full, f"{schema}, {CLASHING}" if clashing else schema)


def texts(spark, *rows):
    return documents(spark, [(i, t, "en", "s") for i, t in rows])
