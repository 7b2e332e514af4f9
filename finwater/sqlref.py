"""Reference SQL (DuckDB dialect) for the oracle check.

These texts restate each job the way the source batch states it -- a
shrinking work list, one ranked table per cohort, IN / NOT IN subqueries,
a UNION of period slices, split-and-join totals -- so that comparing them
with the single-pass Spark plans tests the rewrite, not a copy of it.
They run on the driver's registered tables (``orders``, ``customer``, ...).
"""

from __future__ import annotations

from finwater.schema import AUDIT_METHODS, CURRENT_TOTALS, EXCLUDED_TYPES, MEASURES, PRIOR_TOTALS, REPORT_COLUMNS, STATEMENT_TYPES

# The literals below (names, formulas, ladders of the selection and of the 30
# metrics) are fixed values: they state the batch and must equal it.
SIGNED = ("netopprofit", "retainedearnings", "netprofit")


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(v) for v in values)


def statements_ctes() -> list[str]:
    """Statement history stand-in derived from ``orders`` (FIXTURES.md s.2)."""
    measures = ",\n  ".join(
        f"CASE WHEN (statementid+{i})%7=0 THEN NULL "
        f"ELSE CAST((c*{i + 3})%40009-{10000 if name in SIGNED else 0} AS DOUBLE)/4 END AS {name}"
        for i, name in enumerate(MEASURES)
    )
    return [
        """fx_o AS (SELECT CAST(floor(o_custkey/3) AS BIGINT) AS entityid, o_orderkey AS statementid,
  last_day(CAST(o_orderdate AS DATE)) AS statementdatekey_, substring(o_orderpriority,1,1) AS pr,
  CAST(round(o_totalprice*100,0) AS BIGINT) AS c0 FROM orders)""",
        """fx_s AS (SELECT fx_o.*, DATE '2024-12-31' AS asofdate, c0 AS c FROM fx_o UNION ALL
  SELECT fx_o.*, DATE '2024-11-30' AS asofdate, c0+400 AS c FROM fx_o WHERE statementid%2=0)""",
        """fx_m AS (SELECT *, CAST(CASE entityid%8 WHEN 0 THEN 12 WHEN 1 THEN 1
  WHEN 2 THEN CASE WHEN statementid%3=0 THEN 6 ELSE 1 END
  WHEN 3 THEN CASE WHEN statementid%30=0 THEN 12 ELSE 6 END
  WHEN 4 THEN 3 WHEN 5 THEN CASE WHEN statementid%4=0 THEN 3 ELSE 6 END
  WHEN 6 THEN 6 ELSE CASE statementid%3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 12 END END AS INT) AS statementmonths FROM fx_s)""",
        f"""statements AS (SELECT asofdate, entityid, statementid,
  concat(CAST(entityid AS VARCHAR), CAST(statementid AS VARCHAR)) AS pkid_, statementdatekey_, statementmonths,
  CASE WHEN statementid%17=0 THEN 'Unaudited' WHEN pr='1' THEN 'Unqualif''d' WHEN pr='2' THEN 'Qualified'
       WHEN pr='3' THEN 'Reviewed' WHEN pr='4' THEN 'Compiled' ELSE 'Co.Prep''d' END AS auditmethod,
  CASE WHEN statementid%37=0 THEN 'FY-To-Date' WHEN statementid%41=0 THEN 'Rolling Stmt'
       WHEN statementmonths=12 THEN 'Annual' WHEN statementmonths=3 THEN 'Quarterly'
       WHEN statementmonths=1 THEN 'Monthly' ELSE 'Interim' END AS statementtype,
  {measures}
  FROM fx_m)""",
        """customers AS (SELECT CAST(floor(c_custkey/3) AS BIGINT) AS customerid, c_name AS customername FROM customer)""",
    ]


def _ladder(column: str, values: list[str], name: str) -> str:
    whens = " ".join(f"WHEN {column} = {_q(v)} THEN {i}" for i, v in enumerate(values, 1))
    return f"CASE {whens} END AS {name}"


RANK_COLS = _ladder("auditmethod", AUDIT_METHODS, "Audit_Rank") + ", " + _ladder("statementtype", STATEMENT_TYPES, "StatmentType_Rank")

#: newest first, then key text, then the other key columns (a total order)
NEWEST = "statementdatekey_ DESC, pkid_ DESC, statementmonths, statementtype, auditmethod, statementid"
KEYS = "asofdate, entityid, statementid, pkid_, statementdatekey_, statementmonths, auditmethod, statementtype"

ELIGIBLE_WHERE = (
    f"auditmethod IN ({_in_list(AUDIT_METHODS)}) AND statementtype NOT IN ({_in_list(EXCLUDED_TYPES)})"
)


def _ranked(name: str, src: str, months: int, worklist: str) -> str:
    return (
        f"{name} AS (SELECT *, row_number() OVER (PARTITION BY entityid ORDER BY {NEWEST})"
        f" AS ranked_order FROM {src} WHERE statementmonths = {months} AND entityid IN (SELECT entityid FROM {worklist}))"
    )


def _covered(name: str, ranked: str, top: int, target: int, tag: str) -> str:
    return (
        f"{name} AS (SELECT *, '{tag}' AS CF_Type FROM {ranked} WHERE ranked_order <= {top} AND entityid IN "
        f"(SELECT entityid FROM {ranked} WHERE ranked_order <= {top} GROUP BY entityid "
        f"HAVING sum(CAST(statementmonths AS INTEGER)) = {target}))"
    )


def _shrink(name: str, prev: str, cohort: str, having: str = "HAVING count(*) > 1") -> str:
    return (
        f"{name} AS (SELECT entityid FROM {prev} WHERE entityid NOT IN "
        f"(SELECT entityid FROM {cohort} GROUP BY entityid {having}))"
    )


def selection_ctes(dedup: str = "group") -> list[str]:
    """latest -> eligible -> dedup -> the cohort chain -> union -> slices."""
    if dedup == "group":
        dd = f"""dd_rows AS (SELECT DISTINCT e.* FROM elig e JOIN (SELECT entityid, statementdatekey_, statementtype, max(pkid_) AS mx
  FROM elig GROUP BY entityid, statementdatekey_, statementtype) g
  ON e.entityid = g.entityid AND e.statementdatekey_ = g.statementdatekey_ AND e.statementtype = g.statementtype
  AND e.pkid_ = g.mx),
dd AS (SELECT DISTINCT {KEYS} FROM dd_rows)"""
    else:  # the key-set form: IN over every group's max key; DISTINCT on key columns
        dd = """dd AS (SELECT DISTINCT asofdate, entityid, statementid, pkid_, statementdatekey_, statementmonths,
  auditmethod, statementtype FROM elig WHERE pkid_ IN (SELECT max(pkid_) FROM elig
  GROUP BY entityid, statementdatekey_, statementtype))"""
    if dedup == "group":
        c_sel = """c_sel AS (SELECT c.*, CAST(1 AS BIGINT) AS ranked_order, 'C' AS CF_Type FROM c_src c
  JOIN (SELECT entityid, pkid_ FROM c_src WHERE statementmonths = 12 GROUP BY entityid, pkid_
        HAVING sum(CAST(statementmonths AS INTEGER)) = 12) k ON c.entityid = k.entityid AND c.pkid_ = k.pkid_)"""
    else:
        c_sel = """c_sel AS (SELECT c.*, CAST(1 AS BIGINT) AS ranked_order, 'C' AS CF_Type FROM c_src c
  WHERE pkid_ IN (SELECT pkid_ FROM c_src WHERE statementmonths = 12 GROUP BY entityid, pkid_
        HAVING sum(CAST(statementmonths AS INTEGER)) = 12))"""
    ctes = [
        "latest AS (SELECT * FROM statements WHERE asofdate = (SELECT max(CAST(asofdate AS DATE)) FROM statements))",
        f"elig AS (SELECT * FROM latest WHERE {ELIGIBLE_WHERE} AND entityid IS NOT NULL)",
        dd,
        "wl0 AS (SELECT DISTINCT entityid FROM elig)",
        _ranked("a_rk", "dd", 12, "wl0"),
        _covered("a_sel", "a_rk", 2, 24, "A"),
        _shrink("wl1", "wl0", "a_sel"),
        _ranked("b_rk", "dd", 1, "wl1"),
        _covered("b_sel", "b_rk", 24, 24, "B"),
        _shrink("wl2", "wl1", "b_sel"),
        _ranked("d_rk", "dd", 1, "wl2"),
        _covered("d_sel", "d_rk", 12, 12, "D"),
        _shrink("wl3", "wl2", "d_sel"),
        "c_src AS (SELECT * FROM dd WHERE entityid IN (SELECT entityid FROM wl3))",
        c_sel,
        _shrink("wl4", "wl3", "c_sel", having=""),
        _ranked("f_rk", "dd", 3, "wl4"),
        _covered("f_sel", "f_rk", 8, 24, "F"),
        _shrink("wl5", "wl4", "f_sel"),
        _ranked("g_rk", "dd", 3, "wl5"),
        _covered("g_sel", "g_rk", 4, 12, "G"),
        _shrink("wl6", "wl5", "g_sel"),
        f"""r_sel AS (SELECT *, row_number() OVER (PARTITION BY entityid ORDER BY {NEWEST})
  AS ranked_order, 'R' AS CF_Type FROM dd WHERE entityid IN (SELECT entityid FROM wl6))""",
        """tagged AS (SELECT * FROM a_sel UNION ALL SELECT * FROM b_sel UNION ALL SELECT * FROM d_sel
  UNION ALL SELECT * FROM c_sel UNION ALL SELECT * FROM f_sel UNION ALL SELECT * FROM g_sel
  UNION ALL SELECT * FROM r_sel)""",
        """un AS (SELECT DISTINCT entityid, pkid_, statementdatekey_, CAST(statementdatekey_ AS DATE) AS statment_date,
  statementtype, statementmonths, CAST(ranked_order AS BIGINT) AS ranked_order, CF_Type FROM tagged)""",
        """slices AS (
  SELECT 'C' AS TimeFrame, * FROM un WHERE ranked_order = 1 AND CF_Type IN ('A','C')
  UNION ALL SELECT 'P' AS TimeFrame, * FROM un WHERE ranked_order = 2 AND CF_Type = 'A'
  UNION ALL SELECT 'C' AS TimeFrame, * FROM un WHERE ranked_order <= 12 AND CF_Type = 'B'
  UNION ALL SELECT 'P' AS TimeFrame, * FROM un WHERE ranked_order > 12 AND CF_Type = 'B'
  UNION ALL SELECT 'C' AS TimeFrame, * FROM un WHERE CF_Type = 'D'
  UNION ALL SELECT 'C' AS TimeFrame, * FROM un WHERE ranked_order <= 4 AND CF_Type = 'F'
  UNION ALL SELECT 'P' AS TimeFrame, * FROM un WHERE ranked_order > 4 AND CF_Type = 'F'
  UNION ALL SELECT 'C' AS TimeFrame, * FROM un WHERE CF_Type = 'G')""",
    ]
    return ctes


def metric_select(b: str = "B", a: str = "A") -> str:
    """The 30 metric expressions; ``b`` is the measures row, ``a`` the slice row."""
    n = "CAST({} AS DECIMAL(18,0))"
    rec = f"round(coalesce({n.format(b + '.acctsrectrade')}, 0) - coalesce({n.format(b + '.baddebtreserve')}, 0), 0)"
    lines = [
        f"round(coalesce({b}.netfixedassets,0),0) + round(coalesce({b}.amortexpense,0),0) + round(coalesce({b}.deprecexpense,0),0) AS CapitalExpenditures",
        f"round(coalesce({b}.cash,0),0) + round(coalesce({b}.marketablesec,0),0) AS CashMarketableSecurities",
        f"CASE WHEN {b}.cpltd IS NOT NULL THEN round(round({b}.cpltd,0) / round({a}.statementmonths,0),0) END AS CurrentMaturitiesLongTermDebt",
        f"strftime(CAST({a}.statementdatekey_ AS DATE), '%Y%m%d') AS DateOfFinancials",
        f"round({b}.amortexpense,0) AS DepreciationAmortization",
        f"CASE WHEN {b}.fixedassets IS NOT NULL THEN round({b}.fixedassets,0) WHEN {b}.netfixedassets IS NOT NULL THEN round({b}.netfixedassets,0) END AS FixedAssets",
        f"round({b}.interestexpense,0) AS InterestExpense",
        f"round({b}.longtermdebt,0) AS LongTermDebt",
        f"CASE WHEN {b}.minorityinterest IS NULL THEN round({b}.minintequity,0) ELSE round({b}.minorityinterest,0) END AS MinorityInterest",
        f"round({b}.netopprofit,0) AS OperatingIncome",
        f"round({b}.retainedearnings,0) AS RetainedEarnings",
        f"round({b}.stloanspayable,0) AS ShortTermDebt",
        f"round({b}.totalnoncurasts,0) + round({b}.amortexpense,0) + round({b}.intangibles,0) AS TangibleAssets",
        f"coalesce({n.format(b + '.totalnoncurliabs')},0) + coalesce({n.format(b + '.totalcurliabs')},0) AS TotalLiabilities",
        f"round({b}.acctspaytrade,0) AS AccountsPayableCurrent",
        f'round({b}.acctspaytrade,0) AS "Accounts Payable (A/P) Prior Year"',
        f"{rec} AS AccountsReceivableCurrent",
        f'{rec} AS "Accounts Receivable (A/R) Prior Year"',
        f"round({b}.totalcurassets,0) AS CurrentAssetsCurrent",
        f'round({b}.totalcurassets,0) AS "Current Assets Prior Year"',
        f"round({b}.totalcurliabs,0) AS CurrentLiabilitiesCurrent",
        f'round({b}.totalcurliabs,0) AS "Current Liabilities Prior Year"',
        f'round({b}.totalinventory,0) AS "Inventory Current"',
        f'round({b}.totalinventory,0) AS "Inventory Prior Year"',
        f"round({b}.netprofit,0) AS NetIncomeCurrent",
        f'round({b}.netprofit,0) AS "Net Income Prior Year"',
        f"round({b}.netsales,0) AS NetSalesCurrent",
        f'round({b}.netsales,0) AS "Net Sales Prior Year"',
        f"round({b}.totalassets,0) AS TotalAssetsCurrent",
        f'round({b}.totalassets,0) AS "Total Assets Prior Year"',
    ]
    return ",\n  ".join(lines)


def metrics_ctes(snapshots: str = "latest") -> list[str]:
    """Slice rows -> snapshot lookup -> measures lookup -> stage union."""
    if snapshots == "latest":
        return [
            f"""stage AS (SELECT DISTINCT A.TimeFrame, A.entityid, A.statementdatekey_, A.statementmonths, A.pkid_,
  A.CF_Type, B.asofdate AS AOD,
  {metric_select()}
  FROM slices A LEFT JOIN latest B ON A.entityid = B.entityid AND A.pkid_ = B.pkid_)"""
        ]
    return [
        """snap AS (SELECT DISTINCT A.TimeFrame, A.entityid, A.statementdatekey_, A.statementmonths, A.pkid_, A.CF_Type,
  MS.asofdate AS AOD FROM slices A
  LEFT JOIN statements MS ON A.pkid_ = concat(CAST(MS.entityid AS VARCHAR), CAST(MS.statementid AS VARCHAR)))""",
        f"""stage AS (SELECT DISTINCT A.*,
  {metric_select()}
  FROM snap A LEFT JOIN statements B
  ON A.pkid_ = concat(CAST(B.entityid AS VARCHAR), CAST(B.statementid AS VARCHAR)))""",
    ]


def _sums(totals: list[tuple[str, str]], whole: tuple[str, ...] = ()) -> str:
    value = lambda out, src: f'CAST("{src}" AS DECIMAL(18,0))' if out in whole else f'"{src}"'
    return ", ".join(f'sum({value(out, src)}) AS "{out}"' for out, src in totals)


CURRENT_SUMS = _sums(CURRENT_TOTALS, whole=("CapitalExpenditures",))
PRIOR_SUMS = _sums(PRIOR_TOTALS)

TOTAL_CTES = [
    f"ipe_c AS (SELECT entityid, {CURRENT_SUMS} FROM stage WHERE TimeFrame = 'C' GROUP BY entityid)",
    f"ipe_p AS (SELECT entityid, {PRIOR_SUMS} FROM stage WHERE TimeFrame = 'P' GROUP BY entityid)",
    "maxd AS (SELECT entityid, max(CAST(statementdatekey_ AS DATE)) AS DateOfFinancials FROM stage GROUP BY entityid)",
    "totals AS (SELECT C.*, P.* EXCLUDE (entityid), D.DateOfFinancials FROM ipe_c C LEFT JOIN ipe_p P ON C.entityid = P.entityid LEFT JOIN maxd D ON C.entityid = D.entityid)",
]

NOT_SUMMED = ("ENTITYID", "Internal ID", "Original Internal ID", "ObligorName", "DateOfFinancials", "DateLastAudit")
REPORT_DOUBLES = [c for c in REPORT_COLUMNS if c not in NOT_SUMMED]


def report_select(src: str = "A", with_customers: bool = True) -> str:
    doubles = ",\n  ".join(f'CAST({src}."{c}" AS DOUBLE) AS "{c}"' for c in REPORT_DOUBLES)
    join = "LEFT JOIN customers CU ON A.entityid = CU.customerid" if with_customers else ""
    return f"""SELECT {src}.entityid AS ENTITYID, '' AS "Internal ID", '' AS "Original Internal ID", '' AS ObligorName,
  {src}.DateOfFinancials, '12/31/9999' AS DateLastAudit,
  {doubles}
  FROM totals {src} {join}"""


def with_ctes(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def base_ctes(dedup: str = "group") -> list[str]:
    return statements_ctes() + selection_ctes(dedup)


# ------------------------------------------------------------ sales-target drop

QUALIFIED_SELECT = """SELECT replace(n_name, '_', '') AS FirstName,
  CASE c_custkey % 3 WHEN 0 THEN 'of "' || c_custkey || '",' || chr(13) || chr(10)
    WHEN 1 THEN c_custkey || chr(13) || chr(10) || chr(13) || chr(10) ELSE CAST(c_custkey AS VARCHAR) END AS LastName,
  CASE WHEN c_acctbal >= 0 THEN CAST(CAST(floor(c_acctbal*5) AS BIGINT) AS VARCHAR) END AS SalesQuantity,
  CAST(CAST(floor(c_acctbal*100) AS BIGINT) AS VARCHAR) AS "SalesRevenue ",
  CAST(2000 + n_regionkey AS VARCHAR) AS Year
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""

DROP_CTES = [
    """drop_text AS (SELECT replace(n_name, '_', '') AS FirstName, 'Rep' || CASE WHEN c_custkey % 40 = 0 THEN '€œ' WHEN c_custkey % 40 = 7 THEN chr(10) ELSE '' END || CAST(c_custkey AS VARCHAR) AS LastName,
  CASE WHEN c_acctbal >= 0 THEN CAST(CAST(floor(c_acctbal*5) AS BIGINT) AS VARCHAR) END AS SalesQuantity,
  CAST(CAST(floor(c_acctbal*100) AS BIGINT) AS VARCHAR) AS "SalesRevenue ",
  CAST(2000 + n_regionkey AS VARCHAR) AS Year
  FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    """drop_checked AS (SELECT concat_ws(',', coalesce(FirstName,''), coalesce(LastName,''), coalesce(SalesQuantity,''),
    coalesce("SalesRevenue ",''), coalesce(Year,'')) AS raw_line,
  coalesce(FirstName,'') AS fn, coalesce(LastName,'') AS ln, SalesQuantity AS raw_q,
  SalesQuantity IS NULL OR "SalesRevenue " IS NULL OR Year IS NULL OR FirstName IS NULL OR LastName IS NULL AS has_empty,
  TRY_CAST(coalesce(SalesQuantity,'0') AS SMALLINT) AS q, TRY_CAST(coalesce("SalesRevenue ",'0') AS INTEGER) AS r,
  TRY_CAST(coalesce(Year,'0') AS SMALLINT) AS y FROM drop_text)""",
    """drop_flags AS (SELECT *, length(fn) <= 7 AS FirstName_fits, length(ln) <= 17 AS LastName_fits,
  q IS NOT NULL AS SalesQuantity_converts, r IS NOT NULL AS SalesRevenue_converts, y IS NOT NULL AS Year_converts
  FROM drop_checked)""",
    """drop_err AS (SELECT *,
  CASE WHEN NOT FirstName_fits THEN 'FirstName' WHEN NOT LastName_fits THEN 'LastName'
       WHEN NOT SalesQuantity_converts THEN 'SalesQuantity' WHEN NOT SalesRevenue_converts THEN 'SalesRevenue'
       WHEN NOT Year_converts THEN 'Year' END AS ErrorColumn,
  CASE WHEN NOT FirstName_fits OR NOT LastName_fits THEN 'truncation'
       WHEN NOT (SalesQuantity_converts AND SalesRevenue_converts AND Year_converts) THEN 'conversion' END AS ErrorCode
  FROM drop_flags)""",
    """targets AS (SELECT fn AS FirstName, ln AS LastName, CAST(q AS INTEGER) AS TargetSalesQuantity,
  CAST(r AS DECIMAL(19,4)) AS TargetSalesRevenue, CAST(y AS INTEGER) AS TargetYear FROM drop_err WHERE ErrorColumn IS NULL)""",
    """targets_id AS (SELECT CAST(row_number() OVER (ORDER BY LastName, FirstName, TargetYear, TargetSalesQuantity,
  TargetSalesRevenue) AS INTEGER) AS ID, * FROM targets)""",
]
