"""Rows of both engines in one form."""

from __future__ import annotations

import datetime
import decimal


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    if isinstance(v, dict):
        return {k: norm(x) for k, x in v.items()}
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(names, rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(names), sorted(repr([norm(r[k]) for k in order]) for r in rows)


def assert_same(df, duck, sql: str) -> None:
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    q = duck.execute(sql)
    want = rows_of([d[0] for d in q.description], q.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
