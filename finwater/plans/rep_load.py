"""Sales-target load: the target's content is replaced by the CSV drop.

Policies: ``strict`` fails the whole load on one bad line (the package's
behaviour); ``quarantine`` loads the good lines, writes the lines that the
source cannot read, with their raw text and error, to a quarantine folder,
which must be named, and the rows that the target's declaration refuses to the
sink's own error folder beside it.

The drop is read and parsed once: every line is stored with its checks, and
what is loaded, set aside or refused is taken from that copy. Rows are
accounted for on the way (lines in = source errors + sink errors + rows
loaded); a load whose accounts do not agree is not committed. The new content
is a version of its own, published in one step (``finwater.sinks.versioned``;
a catalogue table gets a new location), so a load that fails or is killed
leaves the old content, and readers never miss the target.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finwater.operators import constraints as con
from finwater.operators.loads import dense_ids, map_rep_columns, validate_fields
from finwater.schema import TARGET_COLUMNS, TARGET_NAME_WIDTH
from finwater.session import delete_path, shared_scratch
from finwater.sinks import versioned
from finwater.sources.csv_drop import DEFAULT_FORMAT, DropFormat, read_drop_text

ID_ORDER = ["LastName", "FirstName", "TargetYear", "TargetSalesQuantity", "TargetSalesRevenue"]
log = logging.getLogger(__name__)

# --- fixed values: declaration of the target table (types, NOT NULL, widths) ---
REP_TARGET = [
    con.TargetColumn("ID", "int", 1),
    con.TargetColumn("FirstName", "string", 2, width=TARGET_NAME_WIDTH),
    con.TargetColumn("LastName", "string", 3, width=TARGET_NAME_WIDTH),
    con.TargetColumn("TargetSalesQuantity", "int", 4),
    con.TargetColumn("TargetSalesRevenue", "decimal(19,4)", 5),
    con.TargetColumn("TargetYear", "int", 6),
]


class LoadError(RuntimeError):
    """A load that is not committed."""


@dataclass(frozen=True)
class Accounts:
    """Rows of a load: lines in, refused by the source, by the sink, loaded."""

    lines: int
    source_errors: int
    sink_errors: int
    loaded: int

    def agree(self) -> bool:
        return self.lines == self.source_errors + self.sink_errors + self.loaded


def target_columns(name_width: int = TARGET_NAME_WIDTH) -> list[con.TargetColumn]:
    """The declaration of the sales-target table, with its names' width."""
    names = {c.name: {"width": name_width} for c in REP_TARGET if c.width}
    return con.with_limits(REP_TARGET, **names)


def prepare_targets(validated: DataFrame, name_width: int = TARGET_NAME_WIDTH) -> DataFrame:
    return dense_ids(map_rep_columns(validated, name_width), ID_ORDER).select(*TARGET_COLUMNS)


def check_policy(policy: str, quarantine_path: str | None) -> None:
    """A load that sets bad lines aside must be told where to put them."""
    if policy not in ("strict", "quarantine"):
        raise ValueError(f"policy must be 'strict' or 'quarantine', not {policy!r}")
    if policy == "quarantine" and not quarantine_path:
        raise ValueError("the quarantine policy needs a quarantine path")


def checked_lines(validated: DataFrame, columns: list[con.TargetColumn]) -> DataFrame:
    """Every line with its source error, the target's columns (mapped, with
    the declared defaults for NULL) and the sink's error."""
    mapped = map_rep_columns(validated, None, keep=["_line", "ErrorColumn", "ErrorCode"])
    return con.check_constraints(con.apply_defaults(mapped, columns), columns, only=F.col("ErrorColumn").isNull())


def store_checked(checked: DataFrame, path: str) -> tuple[DataFrame, Accounts]:
    """Stores the checked lines once; the accounts are counted on the way."""
    good = F.col("ErrorColumn").isNull()
    seen = Observation()
    counted = checked.observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count_if(~good).alias("source_errors"),
        F.count_if(F.col(con.CODE).isNotNull()).alias("sink_errors"), F.count_if(good & F.col(con.CODE).isNull()).alias("loaded"),
    )
    counted.write.parquet(path)
    accounts = Accounts(**seen.get)
    stored = checked.sparkSession.read.schema(checked.schema).parquet(path)
    if not accounts.agree() or stored.count() != accounts.lines:
        raise LoadError(f"accounts do not agree: {accounts}, {stored.count()} lines stored")
    return stored, accounts


def accepted(stored: DataFrame) -> DataFrame:
    """Rows to load, in the target's columns but the identity."""
    return stored.filter(F.col("ErrorColumn").isNull() & F.col(con.CODE).isNull()).select(*[c for c in TARGET_COLUMNS if c != "ID"])


def source_errors(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("ErrorColumn").isNotNull()).select(F.col("_line").alias("raw_line"), "ErrorColumn", "ErrorCode")


def sink_errors(stored: DataFrame) -> DataFrame:
    """Rows that the target refuses, with code and position of the column."""
    rows = stored.filter(F.col(con.CODE).isNotNull())
    return rows.select(F.col("_line").alias("raw_line"), F.col(con.CODE).alias("ErrorCode"), F.col(con.COLUMN).alias("ErrorColumn"))


def sink_error_path(quarantine_path: str) -> str:
    return f"{quarantine_path.rstrip('/')}_sink"


def _first_error(stored: DataFrame, columns: list[con.TargetColumn]) -> str:
    if row := source_errors(stored).first():
        return f"bad line ({row['ErrorCode']} in {row['ErrorColumn']}): {row['raw_line']}"
    row, names = sink_errors(stored).first(), {c.id: c.name for c in columns}
    return f"refused line (code {row['ErrorCode']} in {names[row['ErrorColumn']]}): {row['raw_line']}"


def _load(
    spark: SparkSession, drop_path: str, base: str, policy: str, quarantine_path: str | None, columns: list[con.TargetColumn], fmt: DropFormat,
) -> tuple[DataFrame, str, Accounts]:
    """Stages the new content under ``base``; returns it, its folder and the
    accounts. Nothing is published yet."""
    check_policy(policy, quarantine_path)
    path = shared_scratch(spark, "staging/checked", unique=True)
    validated = validate_fields(read_drop_text(spark, drop_path, fmt))
    stored, accounts = store_checked(checked_lines(validated, columns), path)
    if policy == "strict" and accounts.loaded < accounts.lines:
        raise LoadError(_first_error(stored, columns))
    seen = Observation()
    rows = dense_ids(accepted(stored), ID_ORDER).select(*TARGET_COLUMNS).observe(seen, F.count(F.lit(1)).alias("rows"))
    folder = versioned.stage(rows, base)
    if seen.get["rows"] != accounts.loaded:
        raise LoadError(f"{seen.get['rows']} rows staged, {accounts.loaded} expected")
    if policy == "quarantine":
        source_errors(stored).write.mode("overwrite").parquet(quarantine_path)
        sink_errors(stored).write.mode("overwrite").parquet(sink_error_path(quarantine_path))
    delete_path(spark, path)
    log.info("staged %s: %s", base, accounts)
    return rows, folder, accounts


def load_rep_target_table(
    spark: SparkSession,
    drop_path: str,
    table: str,
    policy: str = "strict",
    quarantine_path: str | None = None,
    name_width: int = TARGET_NAME_WIDTH,
    fmt: DropFormat = DEFAULT_FORMAT,
    columns: list[con.TargetColumn] | None = None,
) -> DataFrame:
    """Same load into a catalogue table of Parquet files. Each load writes a
    folder of its own beside the warehouse's tables and the table is pointed at
    it: one change in the catalogue, before which a reader sees the old content
    and after which the new one."""
    base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions/{table.replace('`', '').replace('.', '/')}"
    rows, folder, _ = _load(spark, drop_path, base, policy, quarantine_path, columns or target_columns(name_width), fmt)
    if spark.catalog.tableExists(table):
        there = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        if there != [(f.name, f.dataType) for f in rows.schema.fields]:
            raise LoadError(f"{table} has other columns: {there}")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{base}/{folder}'")
    else:
        spark.catalog.createTable(table, path=f"{base}/{folder}", source="parquet", schema=rows.schema)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def load_rep_targets(
    spark: SparkSession,
    drop_path: str,
    target_path: str,
    policy: str = "strict",
    quarantine_path: str | None = None,
    name_width: int = TARGET_NAME_WIDTH,
    fmt: DropFormat = DEFAULT_FORMAT,
    columns: list[con.TargetColumn] | None = None,
) -> DataFrame:
    """Loads a versioned target; ``versioned.read_version`` reads it later."""
    log.info("loading %s into %s (policy %s)", drop_path, target_path, policy)
    before = versioned.current(spark, target_path)
    rows, folder, accounts = _load(spark, drop_path, target_path, policy, quarantine_path, columns or target_columns(name_width), fmt)
    versioned.commit(spark, target_path, folder, rows.schema, vars(accounts), base=before["version"] if before else 0)
    return versioned.read_version(spark, target_path)
