"""Column expressions with the reference's scalar semantics."""

from finwater.functions.scalar import (  # noqa: F401
    audit_rank,
    key_concat,
    numeric18,
    sql_round,
    statement_type_rank,
    to_statement_date,
    try_statement_date,
    yyyymmdd,
    zero_if_null,
)
