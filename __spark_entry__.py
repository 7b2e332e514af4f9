"""

``entry(spark)`` runs the flagship report on sf0.001; ``queries()`` maps
``oracle_sql()`` gives, per key, DuckDB SQL over the same tables, written in
the source batch's own (chain / IN / UNION) form.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from finwater import sqlref  # noqa: E402
from finwater.operators import cohorts as co  # noqa: E402
from finwater.operators.eligibility import dedup_statements, distinct_entities, eligible  # noqa: E402
from finwater.operators.metrics import statement_metrics  # noqa: E402
from finwater.operators.periods import assign_period  # noqa: E402
from finwater.operators.ranking import ranked_statements, topn_per_entity  # noqa: E402
from finwater.operators.snapshot import (  # noqa: E402
    latest_snapshot,
    latest_statement_per_entity,
    with_statement_ranks,
)
from finwater.operators.totals import period_totals  # noqa: E402
from finwater.plans.client_financials import client_financials, select_statements  # noqa: E402
from finwater.schema import CSV_FIELDS, KEY_COLUMNS, MEASURES  # noqa: E402
from finwater.sources.statements import (  # noqa: E402
    fixture_customers,
    fixture_latest_asof,
    fixture_statements,
)

try:  # the training-data operators are an optional subpackage
    from finwater.llm import queries as llm_queries  # noqa: E402
except ImportError:
    llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def _doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE at the boundary (values are whole numbers)."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _stmts(spark: SparkSession, sf: str) -> DataFrame:
    return fixture_statements(spark, sf)


def _asof(spark, sf):
    """Newest snapshot from the history's partition folders (no scan)."""
    return fixture_latest_asof(spark, sf)


def _latest(spark, sf):
    return latest_snapshot(_stmts(spark, sf), _asof(spark, sf))


def _keys(spark, sf):
    """Newest snapshot, key columns only: no measure is read or shuffled."""
    return _latest(spark, sf).select(*KEY_COLUMNS)


def _dd(spark, sf):
    return dedup_statements(eligible(_keys(spark, sf)))


def _tagged(spark, sf):
    return select_statements(_stmts(spark, sf), _asof(spark, sf), measures=False)


def _periods(spark, sf, measures=True):
    return assign_period(select_statements(_stmts(spark, sf), _asof(spark, sf), include_residual=False, measures=measures))


def q_scan_statements(spark, sf):
    return _stmts(spark, sf)


def q_latest_snapshot(spark, sf):
    return with_statement_ranks(_latest(spark, sf)).select(
        "asofdate", "pkid_", "entityid", "statementid", "statementdatekey_", "auditmethod",
        "statementmonths", "statementtype", "Audit_Rank", "StatmentType_Rank",
    )


def q_statement_ranks(spark, sf):
    return (
        with_statement_ranks(_stmts(spark, sf))
        .groupBy("auditmethod", "statementtype", "Audit_Rank", "StatmentType_Rank")
        .agg(F.count(F.lit(1)).alias("n_statements"))
    )


def q_latest_statement_per_entity(spark, sf):
    return latest_statement_per_entity(_latest(spark, sf))


def q_eligible_statements(spark, sf):
    return eligible(_latest(spark, sf))


def q_distinct_entities(spark, sf):
    return distinct_entities(_latest(spark, sf))


def q_dedup_statements(spark, sf):
    return dedup_statements(eligible(_latest(spark, sf)))


def q_ranked_statements(spark, sf):
    return ranked_statements(_dd(spark, sf)).select(
        "entityid", "pkid_", "statementdatekey_", "statementtype", "statementmonths", "ranked_order"
    )


def q_topn_per_entity(spark, sf):
    annual = _dd(spark, sf).filter(F.col("statementmonths") == 12)
    return topn_per_entity(annual, 2).select("entityid", "pkid_", "statementdatekey_", "ranked_order")


def q_coverage_filter(spark, sf):
    return co.coverage_filter(_dd(spark, sf), months=1, n=24, target=24, tag="B").select(
        "entityid", "pkid_", "statementdatekey_", "statementmonths", "ranked_order", "CF_Type"
    )


def _cohort(tag):
    def q(spark, sf):
        return co.cohort_rows(_tagged(spark, sf), tag)

    q.__name__ = f"q_cohort_{tag}"
    return q


def q_cohort_waterfall(spark, sf):
    return co.entity_cohorts(_tagged(spark, sf))


def q_cohort_union(spark, sf):
    return co.cohort_rows(_tagged(spark, sf))


def q_period_assignment(spark, sf):
    return _periods(spark, sf, measures=False).select(
        "TimeFrame", "entityid", "pkid_", "statementdatekey_", "statementmonths", "CF_Type", "ranked_order"
    ).distinct()


def q_statement_metrics(spark, sf):
    return _doubles(statement_metrics(_periods(spark, sf)))


def q_period_totals(spark, sf):
    return _doubles(period_totals(statement_metrics(_periods(spark, sf))))


def q_client_financials(spark, sf):
    return client_financials(_stmts(spark, sf), fixture_customers(spark, sf), as_of=_asof(spark, sf))


def q_client_financials_all_snapshots(spark, sf):
    return client_financials(_stmts(spark, sf), fixture_customers(spark, sf), as_of=_asof(spark, sf), snapshots="all")


def q_statement_snapshots(spark, sf):
    from finwater.plans.all_snapshots import select_statements_all, statement_snapshots

    st = _stmts(spark, sf)
    return statement_snapshots(st, assign_period(select_statements_all(st, as_of=_asof(spark, sf))))


def q_cohort_waterfall_by_key(spark, sf):
    from finwater.plans.all_snapshots import select_statements_all

    return co.cohort_rows(select_statements_all(_stmts(spark, sf), as_of=_asof(spark, sf)))


def _validated(spark, sf):
    from finwater.operators.loads import validate_fields
    from finwater.sources.csv_drop import read_drop_text, sales_target_drop

    return validate_fields(read_drop_text(spark, sales_target_drop(spark, sf)))


def q_csv_typed_scan(spark, sf):
    """Every line of the drop: converted values of the good ones, raw text,
    column and kind of error of the others."""
    return _validated(spark, sf).select(
        F.col("_line").alias("raw_line"),
        *[
            F.when(F.col("ErrorColumn").isNull(), F.col(c)).alias(n)
            for n, c in (("FirstName", "FirstName"), ("LastName", "LastName"), ("SalesQuantity", "_typed_SalesQuantity"),
                         ("SalesRevenue ", "_typed_SalesRevenue"), ("Year", "_typed_Year"))
        ],
        "ErrorColumn",
        "ErrorCode",
    )


def q_csv_qualified_scan(spark, sf):
    """A drop with qualified fields over several lines and rows to skip."""
    from finwater.sources.csv_drop import QUALIFIED, qualified_drop, read_drop_text

    return read_drop_text(spark, qualified_drop(spark, sf), QUALIFIED).select(*CSV_FIELDS)


def q_csv_strict_checks(spark, sf):
    return _validated(spark, sf).select(
        F.col("_line").alias("raw_line"), "FirstName_fits", "LastName_fits", "SalesQuantity_converts",
        "SalesRevenue_converts", "Year_converts",
    )


def q_csv_quarantine(spark, sf):
    from finwater.operators.loads import quarantine

    return quarantine(_validated(spark, sf))


def q_csv_empty_defaults(spark, sf):
    text = _validated(spark, sf)
    return text.filter(F.col("_line").contains(",,") | F.col("_line").startswith(",") | F.col("_line").endswith(",")).select(
        F.col("_line").alias("raw_line"), "FirstName", "LastName", F.col("_typed_SalesQuantity").alias("SalesQuantity"),
        F.col("_typed_SalesRevenue").alias("SalesRevenue "), F.col("_typed_Year").alias("Year"),
    )


def q_map_rep_columns(spark, sf):
    from finwater.operators.loads import good_lines, map_rep_columns

    return _doubles(map_rep_columns(good_lines(_validated(spark, sf))))


def q_surrogate_key(spark, sf):
    from finwater.operators.loads import good_lines
    from finwater.plans.rep_load import prepare_targets

    return prepare_targets(good_lines(_validated(spark, sf))).select("ID", "LastName")


def q_sink_errors(spark, sf):
    """Rows of the drop that a target with these limits refuses."""
    from finwater.operators.constraints import with_limits
    from finwater.plans.rep_load import REP_TARGET, checked_lines, sink_errors

    limits = {"LastName": {"width": 6}, "TargetSalesQuantity": {"most": 20000}, "TargetSalesRevenue": {"least": 0, "most": 250000}}
    return sink_errors(checked_lines(_validated(spark, sf), with_limits(REP_TARGET, **limits)))


def q_sink_defaults(spark, sf):
    """Zero-length quantities as 0 (the source's default), and retained as NULL
    and replaced by the DEFAULT that the catalogue declares for the column."""
    import uuid

    from finwater.operators.constraints import declared_columns
    from finwater.operators.loads import validate_fields
    from finwater.plans.rep_load import checked_lines
    from finwater.sources.csv_drop import read_drop_text, sales_target_drop

    table = f"rep_defaults_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} (LastName STRING, TargetSalesQuantity INT DEFAULT -1, TargetYear INT DEFAULT 1900) USING parquet")
    try:
        columns = declared_columns(spark, table)
    finally:
        spark.sql(f"DROP TABLE {table}")
    text = read_drop_text(spark, sales_target_drop(spark, sf))
    both = [checked_lines(validate_fields(text, retain_nulls=retain), columns) for retain in (False, True)]
    names = ("empty_default", "null_default")
    parts = [
        df.filter(F.col("ErrorColumn").isNull()).select(F.lit(name).alias("mode"), F.col("_line").alias("raw_line"), "TargetSalesQuantity")
        for name, df in zip(names, both)
    ]
    return parts[0].unionByName(parts[1])


def q_load_rep_targets(spark, sf):
    from finwater.plans.rep_load import load_rep_targets
    from finwater.session import shared_scratch
    from finwater.sources.csv_drop import sales_target_drop

    target = shared_scratch(spark, "tables/rep_performance_target", unique=True)
    loaded = load_rep_targets(
        spark, sales_target_drop(spark, sf), target, policy="quarantine", quarantine_path=target + "_quarantine"
    )
    return _doubles(loaded)


def q_trailing_window(spark, sf):
    from finwater.operators.extras import newest_statement_date, trailing_window

    elig = eligible(_latest(spark, sf))
    return trailing_window(elig, newest_statement_date(elig), 12).select(
        "entityid", "pkid_", "statementdatekey_", "statementmonths", "statementtype"
    )


def q_months_in_window(spark, sf):
    from finwater.operators.extras import months_in_window, newest_statement_date

    elig = eligible(_keys(spark, sf))
    return months_in_window(elig, 1, newest_statement_date(elig), 24).select("entityid", "pkid_", "statementdatekey_", "statementmonths")


def q_collated_dedup(spark, sf):
    """Groups, greatest keys and ranks of text keys under a collation, with
    the system ids that a collated join finds."""
    from finwater.operators import collated as cl

    latest = cl.text_keys(_keys(spark, sf))
    top = cl.dedup_collated(latest, ["entityid", "statementdatekey_", "statementtype"], "pkid_")
    ranked = cl.ranked_collated(top, ["entityid"], ["statementdatekey_", "pkid_"])
    ids = latest.select("entityid").distinct().select(
        F.lower(F.rtrim("entityid")).alias("entityid"), F.concat(F.lit("SYS"), F.lower(F.rtrim("entityid"))).alias("systemid")
    ).distinct()
    shown = lambda c: F.lower(F.rtrim(c)).alias(c)
    return cl.join_collated(ranked, ids, "entityid").select(
        "systemid", shown("entityid"), "statementdatekey_", shown("statementtype"), shown("pkid_"), "statementid", "ranked_order"
    )


def q_client_financials_from_tables(spark, sf):
    """The report from catalogue tables, found by three-part names; snapshot
    dates from the catalogue's partitions."""
    from finwater.sources.resolve import read_source
    from finwater.sources.statements import customers_from_customer, fixture_history_path, read_statements, snapshot_dates
    from finwater.sources.tables import table_path

    path = fixture_history_path(spark, sf)
    history, customer = (f"fw_{name}_{abs(hash((path, sf))):x}" for name in ("history", "customer"))
    if not spark.catalog.tableExists(history):
        spark.catalog.createTable(history, path=path, source="parquet")
        spark.catalog.recoverPartitions(history)
    if not spark.catalog.tableExists(customer):
        spark.catalog.createTable(customer, path=table_path(sf, "customer"), source="parquet")
    full = lambda t: f"[{spark.catalog.currentCatalog()}].[{spark.catalog.currentDatabase()}].[{t}]"
    dates = snapshot_dates(spark, full(history))
    customers = customers_from_customer(read_source(spark, full(customer)).select("c_custkey", "c_name"))
    return client_financials(read_statements(spark, full(history)), customers, as_of=dates[-1])


def q_contiguous_coverage(spark, sf):
    from finwater.operators.extras import contiguous_coverage

    return contiguous_coverage(_dd(spark, sf))


def q_entity_system_ids(spark, sf):
    from finwater.operators.extras import entity_bridge_from_customer, entity_system_ids
    from finwater.sources.tables import read_table

    latest = _latest(spark, sf).select(*KEY_COLUMNS)
    bridge = entity_bridge_from_customer(read_table(spark, sf, "customer"))
    return entity_system_ids(latest, bridge)


def q_stream_rep_targets(spark, sf):
    """The drop-folder loader (Structured Streaming, availableNow) over the
    derived drop; returns the loaded target."""
    from finwater.session import shared_scratch
    from finwater.sources.csv_drop import sales_target_drop
    from finwater.streaming import start_drop_loader

    base = shared_scratch(spark, "streams/rep_performance_target", unique=True)
    query = start_drop_loader(spark, sales_target_drop(spark, sf), base + "/target", base + "/quarantine", base + "/ckpt")
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return _doubles(spark.read.parquet(base + "/target").drop("epoch"))


COHORT_KEYS = {
    "cohort_annual_24": "A",
    "cohort_monthly_24": "B",
    "cohort_monthly_12": "D",
    "cohort_annual_12": "C",
    "cohort_quarterly_24": "F",
    "cohort_quarterly_12": "G",
    "cohort_residual": "R",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "client_financials": q_client_financials,
        "client_financials_all_snapshots": q_client_financials_all_snapshots,
        "cohort_waterfall_by_key": q_cohort_waterfall_by_key,
        "statement_snapshots": q_statement_snapshots,
        "scan_statements": q_scan_statements,
        "latest_snapshot": q_latest_snapshot,
        "statement_ranks": q_statement_ranks,
        "latest_statement_per_entity": q_latest_statement_per_entity,
        "eligible_statements": q_eligible_statements,
        "distinct_entities": q_distinct_entities,
        "dedup_statements": q_dedup_statements,
        "ranked_statements": q_ranked_statements,
        "topn_per_entity": q_topn_per_entity,
        "coverage_filter": q_coverage_filter,
        "cohort_waterfall": q_cohort_waterfall,
        "cohort_union": q_cohort_union,
        "period_assignment": q_period_assignment,
        "statement_metrics": q_statement_metrics,
        "period_totals": q_period_totals,
    }
    for key, tag in COHORT_KEYS.items():
        qs[key] = _cohort(tag)
    qs.update(
        {
            "csv_typed_scan": q_csv_typed_scan,
            "csv_qualified_scan": q_csv_qualified_scan,
            "csv_strict_checks": q_csv_strict_checks,
            "csv_quarantine": q_csv_quarantine,
            "csv_empty_defaults": q_csv_empty_defaults,
            "map_rep_columns": q_map_rep_columns,
            "surrogate_key": q_surrogate_key,
            "sink_errors": q_sink_errors,
            "sink_defaults": q_sink_defaults,
            "load_rep_targets": q_load_rep_targets,
            "stream_rep_targets": q_stream_rep_targets,
            "trailing_window": q_trailing_window,
            "months_in_window": q_months_in_window,
            "collated_dedup": q_collated_dedup,
            "client_financials_from_tables": q_client_financials_from_tables,
            "contiguous_coverage": q_contiguous_coverage,
            "entity_system_ids": q_entity_system_ids,
        }
    )
    if llm_queries is not None:
        qs.update(llm_queries.queries())
    return qs


# ---------------------------------------------------------------- oracle SQL

_ALL_COLS = ", ".join(KEY_COLUMNS + MEASURES)


def _sql(select: str, extra: list[str] | None = None, dedup: str = "group") -> str:
    return sqlref.with_ctes(sqlref.base_ctes(dedup) + (extra or []), select)


def oracle_sql() -> dict[str, str]:
    s = {
        "scan_statements": _sql(f"SELECT {_ALL_COLS} FROM statements"),
        "latest_snapshot": _sql(
            "SELECT asofdate, pkid_, entityid, statementid, statementdatekey_, auditmethod, statementmonths, "
            f"statementtype, {sqlref.RANK_COLS} FROM latest"
        ),
        "statement_ranks": _sql(
            f"SELECT auditmethod, statementtype, Audit_Rank, StatmentType_Rank, count(*) AS n_statements FROM "
            f"(SELECT *, {sqlref.RANK_COLS} FROM statements) GROUP BY ALL"
        ),
        "latest_statement_per_entity": _sql(
            """SELECT DISTINCT a.entityid, a.pkid_, a.statementdatekey_ AS max_statementdate FROM latest a
  RIGHT JOIN (SELECT max(statementdatekey_) AS mx, entityid FROM latest GROUP BY entityid) b
  ON a.entityid = b.entityid AND a.statementdatekey_ = b.mx WHERE a.asofdate IS NOT NULL"""
        ),
        "eligible_statements": _sql(f"SELECT {_ALL_COLS} FROM elig"),
        "distinct_entities": _sql("SELECT DISTINCT entityid FROM elig"),
        "dedup_statements": _sql(f"SELECT {_ALL_COLS} FROM dd_rows"),
        "ranked_statements": _sql(
            "SELECT entityid, pkid_, statementdatekey_, statementtype, statementmonths, CAST(row_number() OVER "
            "(PARTITION BY entityid ORDER BY statementdatekey_ DESC, pkid_ DESC) AS BIGINT) AS ranked_order FROM dd"
        ),
        "topn_per_entity": _sql(
            "SELECT entityid, pkid_, statementdatekey_, ranked_order FROM (SELECT *, CAST(row_number() OVER "
            "(PARTITION BY entityid ORDER BY statementdatekey_ DESC, pkid_ DESC) AS BIGINT) AS ranked_order "
            "FROM dd WHERE statementmonths = 12) WHERE ranked_order < 3"
        ),
        "coverage_filter": _sql(
            """SELECT entityid, pkid_, statementdatekey_, statementmonths, CAST(ranked_order AS BIGINT) AS ranked_order,
  'B' AS CF_Type FROM (SELECT *, row_number() OVER (PARTITION BY entityid ORDER BY statementdatekey_ DESC, pkid_ DESC)
  AS ranked_order FROM dd WHERE statementmonths = 1) r WHERE ranked_order < 25 AND entityid IN
  (SELECT entityid FROM (SELECT entityid, statementmonths, row_number() OVER (PARTITION BY entityid
   ORDER BY statementdatekey_ DESC, pkid_ DESC) AS rn FROM dd WHERE statementmonths = 1) WHERE rn < 25
   GROUP BY entityid HAVING sum(statementmonths) = 24)"""
        ),
        "cohort_waterfall": _sql("SELECT DISTINCT entityid, CF_Type FROM un"),
        "cohort_union": _sql(
            "SELECT entityid, pkid_, statementdatekey_, statment_date, statementtype, statementmonths, ranked_order, "
            "CF_Type FROM un"
        ),
        "period_assignment": _sql(
            "SELECT TimeFrame, entityid, pkid_, statementdatekey_, statementmonths, CF_Type, ranked_order FROM slices"
        ),
        "statement_metrics": _sql(
            "SELECT * REPLACE (CAST(TotalLiabilities AS DOUBLE) AS TotalLiabilities, "
            "CAST(AccountsReceivableCurrent AS DOUBLE) AS AccountsReceivableCurrent, "
            'CAST("Accounts Receivable (A/R) Prior Year" AS DOUBLE) AS "Accounts Receivable (A/R) Prior Year") FROM stage',
            sqlref.metrics_ctes("latest"),
        ),
        "period_totals": _sql(
            "SELECT entityid, "
            + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in sqlref.REPORT_DOUBLES)
            + ", DateOfFinancials FROM totals",
            sqlref.metrics_ctes("latest") + sqlref.TOTAL_CTES,
        ),
        "client_financials": _sql(sqlref.report_select(), sqlref.metrics_ctes("latest") + sqlref.TOTAL_CTES),
        "client_financials_all_snapshots": _sql(
            sqlref.report_select(), sqlref.metrics_ctes("all") + sqlref.TOTAL_CTES, dedup="keyset"
        ),
        "statement_snapshots": _sql("SELECT * FROM snap", sqlref.metrics_ctes("all"), dedup="keyset"),
        "cohort_waterfall_by_key": _sql(
            "SELECT entityid, pkid_, statementdatekey_, statment_date, statementtype, statementmonths, ranked_order, "
            "CF_Type FROM un",
            dedup="keyset",
        ),
    }
    drop = sqlref.DROP_CTES
    s.update(
        {
            "csv_typed_scan": sqlref.with_ctes(
                drop,
                "SELECT raw_line, CASE WHEN ErrorColumn IS NULL THEN fn END AS FirstName, CASE WHEN ErrorColumn IS NULL THEN ln END AS "
                'LastName, CASE WHEN ErrorColumn IS NULL THEN q END AS SalesQuantity, CASE WHEN ErrorColumn IS NULL THEN r END AS '
                '"SalesRevenue ", CASE WHEN ErrorColumn IS NULL THEN y END AS Year, ErrorColumn, ErrorCode FROM drop_err',
            ),
            "csv_qualified_scan": sqlref.QUALIFIED_SELECT,
            "csv_strict_checks": sqlref.with_ctes(
                drop,
                "SELECT raw_line, FirstName_fits, LastName_fits, SalesQuantity_converts, SalesRevenue_converts, "
                "Year_converts FROM drop_err",
            ),
            "csv_quarantine": sqlref.with_ctes(
                drop, "SELECT raw_line, ErrorColumn, ErrorCode FROM drop_err WHERE ErrorColumn IS NOT NULL"
            ),
            "csv_empty_defaults": sqlref.with_ctes(
                drop,
                'SELECT raw_line, fn AS FirstName, ln AS LastName, q AS SalesQuantity, r AS "SalesRevenue ", y AS Year '
                "FROM drop_err WHERE has_empty",
            ),
            "map_rep_columns": sqlref.with_ctes(
                drop, "SELECT * REPLACE (CAST(TargetSalesRevenue AS DOUBLE) AS TargetSalesRevenue) FROM targets"
            ),
            "sink_errors": sqlref.with_ctes(
                drop,
                "SELECT raw_line, CASE WHEN length(ln) > 6 THEN 2 ELSE 3 END AS ErrorCode, CASE WHEN length(ln) > 6 THEN 3 "
                "WHEN q > 20000 THEN 4 ELSE 5 END AS ErrorColumn FROM drop_err WHERE ErrorColumn IS NULL "
                "AND (length(ln) > 6 OR q > 20000 OR r < 0 OR r > 250000)",
            ),
            "sink_defaults": sqlref.with_ctes(
                drop,
                "SELECT m.mode, raw_line, CASE WHEN m.mode = 'null_default' AND raw_q IS NULL THEN -1 ELSE CAST(q AS INTEGER) END "
                "AS TargetSalesQuantity FROM drop_err, (VALUES ('empty_default'), ('null_default')) m(mode) WHERE ErrorColumn IS NULL",
            ),
            "surrogate_key": sqlref.with_ctes(drop, "SELECT ID, LastName FROM targets_id"),
            "stream_rep_targets": sqlref.with_ctes(
                drop, "SELECT * REPLACE (CAST(TargetSalesRevenue AS DOUBLE) AS TargetSalesRevenue) FROM targets_id"
            ),
            "load_rep_targets": sqlref.with_ctes(
                drop, "SELECT * REPLACE (CAST(TargetSalesRevenue AS DOUBLE) AS TargetSalesRevenue) FROM targets_id"
            ),
        }
    )
    keys = ", ".join(KEY_COLUMNS)
    s.update(
        {
            "trailing_window": _sql(
                "SELECT entityid, pkid_, statementdatekey_, statementmonths, statementtype FROM elig WHERE statementdatekey_ "
                "BETWEEN CAST((SELECT max(statementdatekey_) FROM elig) - INTERVAL 12 MONTH AS DATE) "
                "AND (SELECT max(statementdatekey_) FROM elig)"
            ),
            "months_in_window": _sql(
                "SELECT entityid, pkid_, statementdatekey_, statementmonths FROM elig WHERE statementmonths = 1 AND statementdatekey_ "
                "BETWEEN CAST((SELECT max(statementdatekey_) FROM elig) - INTERVAL 24 MONTH AS DATE) "
                "AND (SELECT max(statementdatekey_) FROM elig)"
            ),
            "collated_dedup": _sql(
                """SELECT 'SYS' || 'ent' || entityid AS systemid, 'ent' || entityid AS entityid, statementdatekey_, t AS statementtype,
  key AS pkid_, statementid, CAST(dense_rank() OVER (PARTITION BY entityid ORDER BY statementdatekey_ DESC, key COLLATE NOCASE DESC)
  AS INTEGER) AS ranked_order FROM (
    SELECT *, max(key) OVER (PARTITION BY entityid, statementdatekey_, t COLLATE NOCASE) AS top FROM (
      SELECT *, lower(rtrim(statementtype)) AS t, 'ent' || entityid || '-' || (statementid % 50) AS key FROM latest))
WHERE top = key"""
            ),
            "client_financials_from_tables": _sql(sqlref.report_select(), sqlref.metrics_ctes("latest") + sqlref.TOTAL_CTES),
            "contiguous_coverage": _sql(
                """SELECT entityid, statementmonths, max(statementdatekey_) AS newest_date, min(statementdatekey_) AS oldest_date,
  count(*) AS run_statements, CAST(count(*) * statementmonths AS BIGINT) AS run_months,
  count(*) * statementmonths >= 24 AS covers_24, count(*) * statementmonths >= 12 AS covers_12
FROM (SELECT *, sum(_breaks) OVER (PARTITION BY entityid, statementmonths ORDER BY statementdatekey_ DESC, pkid_ DESC
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _broken
      FROM (SELECT *, CASE WHEN lag(statementdatekey_) OVER w IS NULL THEN 0
              WHEN statementdatekey_ = last_day(CAST(lag(statementdatekey_) OVER w - to_months(statementmonths) AS DATE))
              THEN 0 ELSE 1 END AS _breaks
            FROM dd WINDOW w AS (PARTITION BY entityid, statementmonths ORDER BY statementdatekey_ DESC, pkid_ DESC)))
WHERE _broken = 0 GROUP BY entityid, statementmonths"""
            ),
            "entity_system_ids": _sql(
                f"SELECT DISTINCT B.systemid, {', '.join('A.' + c for c in KEY_COLUMNS)} FROM latest A LEFT JOIN "
                "(SELECT DISTINCT 'SYS' || CAST(c_nationkey AS VARCHAR) AS systemid, CAST(floor(c_custkey/3) AS BIGINT) "
                "AS entityid FROM customer) B ON A.entityid = B.entityid"
            ),
        }
    )
    for key, tag in COHORT_KEYS.items():
        s[key] = _sql(
            "SELECT entityid, pkid_, statementdatekey_, statment_date, statementtype, statementmonths, ranked_order, "
            f"CF_Type FROM un WHERE CF_Type = '{tag}'"
        )
    if llm_queries is not None:
        s.update(llm_queries.oracle_sql())
    return s


def entry(spark: SparkSession) -> DataFrame:
    return q_client_financials(spark, SMOKE_DIR)
