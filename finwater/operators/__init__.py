"""Single operators, each a ``DataFrame -> DataFrame`` function."""

from finwater.operators.cohorts import (  # noqa: F401
    assign_cohorts,
    assign_cohorts_by_key,
    cohort_chain,
    cohort_rows,
    coverage_filter,
    entity_cohorts,
    entity_stage,
    place_by_key,
)
from finwater.operators.eligibility import (  # noqa: F401
    dedup_statements,
    dedup_statements_by_key_set,
    distinct_entities,
    eligible,
)
from finwater.operators.metrics import metric_columns, statement_metrics  # noqa: F401
from finwater.operators.periods import assign_period  # noqa: F401
from finwater.operators.ranking import ranked_statements, topn_per_entity  # noqa: F401
from finwater.operators.snapshot import (  # noqa: F401
    latest_asof,
    latest_snapshot,
    latest_statement_per_entity,
    with_statement_ranks,
)
from finwater.operators.totals import period_totals  # noqa: F401
