"""Hand-made statement rows (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from finwater.schema import MEASURES, STATEMENT_SCHEMA

ASOF = dt.date(2024, 12, 31)
OLDER = dt.date(2024, 11, 30)
TYPE_OF = {12: "Annual", 3: "Quarterly", 1: "Monthly"}


def month_end(year: int, month: int) -> dt.date:
    nxt = dt.date(year + (month // 12), month % 12 + 1, 1)
    return nxt - dt.timedelta(days=1)


def months_back(n: int, step: int = 1, start=(2024, 12)) -> list[dt.date]:
    y, m = start
    out = []
    for i in range(n):
        k = (y * 12 + (m - 1)) - i * step
        out.append(month_end(k // 12, k % 12 + 1))
    return out


_DEFAULT = object()


def row(entity, stmt, date, months, stype=_DEFAULT, audit="Qualified", asof=ASOF, **measures):
    values = {m: 1.0 for m in MEASURES}
    values.update(measures)
    stype = TYPE_OF.get(months, "Interim") if stype is _DEFAULT else stype
    return (asof, entity, stmt, f"{entity}{stmt}", date, months, audit, stype, *[values[m] for m in MEASURES])


def frame(spark, rows):
    return spark.createDataFrame(rows, STATEMENT_SCHEMA)


def run_of(entity, first_stmt, months, count, step=None, start=(2024, 12), **kw):
    step = step or months
    start = start or (2024, 9)
    return [row(entity, first_stmt + i, d, months, **kw) for i, d in enumerate(months_back(count, step, start))]
