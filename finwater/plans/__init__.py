"""End-to-end jobs composed from the operators."""

from finwater.plans.client_financials import client_financials, select_statements  # noqa: F401
