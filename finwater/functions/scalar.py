"""Scalar expressions.

All are built from ``pyspark.sql.functions``: they run in the JVM; none is a
Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from finwater.schema import AUDIT_METHODS, STATEMENT_TYPES


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def key_concat(*cols) -> Column:
    """Text concatenation where NULL counts as ''.

    ``concat`` would turn the whole key NULL when one part is NULL; the
    statement key never is NULL, so ``concat_ws('')`` over text casts is used.
    """
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def sql_round(col, scale: int = 0) -> Column:
    """Round half away from zero (Spark's ``round`` is HALF_UP on both signs)."""
    return F.round(_c(col), scale)


def zero_if_null(col) -> Column:
    return F.coalesce(_c(col), F.lit(0))


def numeric18(col) -> Column:
    """NUMERIC with default precision: DECIMAL(18,0), rounding half away from zero."""
    return _c(col).cast("decimal(18,0)")


def yyyymmdd(col) -> Column:
    return F.date_format(_c(col), "yyyyMMdd")


def try_statement_date(col, text_format: str = "yyyyMMdd") -> Column:
    """A statement date given as DATE, TIMESTAMP or ``yyyymmdd`` text; NULL if
    it cannot be read."""
    c = _c(col)
    return F.coalesce(F.try_to_date(c.cast("string"), text_format), c.cast("string").try_cast("date"))


def to_statement_date(col, text_format: str = "yyyyMMdd") -> Column:
    """The same, failing the job on a value that is given but is no date."""
    c = _c(col)
    date = try_statement_date(col, text_format)
    bad = c.isNotNull() & date.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a statement date: "), c.cast("string"))).cast("date")).otherwise(date)


def _rank_ladder(col, values: list[str], collation: str | None = None) -> Column:
    c = _c(col) if collation is None else F.collate(_c(col), collation)
    expr = None
    for i, v in enumerate(values, start=1):
        expr = F.when(c == v, F.lit(i)) if expr is None else expr.when(c == v, F.lit(i))
    return expr  # no otherwise(): unknown values rank NULL


def audit_rank(col="auditmethod", collation: str | None = None) -> Column:
    return _rank_ladder(col, AUDIT_METHODS, collation)


def statement_type_rank(col="statementtype", collation: str | None = None) -> Column:
    return _rank_ladder(col, STATEMENT_TYPES, collation)
