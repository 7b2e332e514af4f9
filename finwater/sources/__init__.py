"""Readers: driver tables, the statement history, customers, CSV drops, metadata."""

from finwater.sources.tables import read_table  # noqa: F401
from finwater.sources.statements import (  # noqa: F401
    customers_from_customer,
    read_statements,
    statements_from_orders,
)
