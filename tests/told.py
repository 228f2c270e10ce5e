"""What the report tests share: paths of the tables, dates, and rows in a fixed order."""

from __future__ import annotations

from datetime import date, datetime

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def rows_of(df) -> list[tuple]:
    """Rows as tuples with columns by name, in a fixed order."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def by(df, *keys) -> dict:
    """Rows as dictionaries under the values of the key columns; keys must be unique."""
    result = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]
        assert key not in result, key
        result[key] = row.asDict()
    return result
