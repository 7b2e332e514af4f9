"""Load steps of the sales-target package: checks, defaults, mapping, IDs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finwater.schema import CSV_WIDTHS, TARGET_NAME_WIDTH
from finwater.session import shared_scratch

TEXT_FIELDS = ["FirstName", "LastName"]
# (field, target type of the parse)
NUMERIC_FIELDS = [("SalesQuantity", "smallint"), ("SalesRevenue ", "int"), ("Year", "smallint")]


def _c(name: str):
    return F.col(f"`{name}`")


CORRUPT = "_corrupt_record"


def raw_line(df: DataFrame) -> F.Column:
    """The delimited line as delivered (no qualifier, empty for NULL)."""
    joined = F.concat_ws(",", *[F.coalesce(_c(c), F.lit("")) for c in df.columns if not c.startswith("_")])
    return F.coalesce(F.col(CORRUPT), joined) if CORRUPT in df.columns else joined


def empty_defaults(df: DataFrame) -> DataFrame:
    """Zero-length fields: '' for text, 0 for numbers (RetainNulls = false)."""
    out = df
    for name in TEXT_FIELDS:
        out = out.withColumn(name, F.coalesce(_c(name), F.lit("")))
    for name, _ in NUMERIC_FIELDS:
        out = out.withColumn(name, F.coalesce(_c(name), F.lit("0")))
    return out


def validate_fields(text_df: DataFrame, retain_nulls: bool = False) -> DataFrame:
    """Per-field checks on the text layout. ``retain_nulls`` leaves zero-length
    fields NULL, for the target's own defaults.

    Adds the typed values (NULL where a field does not convert), one flag per
    check, and the first failing field (``ErrorColumn``) with its kind
    (``ErrorCode``: 'truncation' or 'conversion').
    """
    df = text_df.withColumn("_line", raw_line(text_df))
    df = df if retain_nulls else empty_defaults(df)
    checks = []
    for name in TEXT_FIELDS:
        flag = f"{name}_fits"
        df = df.withColumn(flag, F.coalesce(F.length(_c(name)), F.lit(0)) <= CSV_WIDTHS[name])
        checks.append((name, flag, "truncation"))
    for name, typ in NUMERIC_FIELDS:
        flag = f"{name.strip()}_converts"
        df = df.withColumn(f"_typed_{name.strip()}", _c(name).try_cast(typ))
        df = df.withColumn(flag, F.col(f"_typed_{name.strip()}").isNotNull() | _c(name).isNull())
        checks.append((name, flag, "conversion"))
    if CORRUPT in df.columns:  # wrong number of fields: the line's layout is bad
        df = df.withColumn("_layout_ok", F.col(CORRUPT).isNull())
        checks.insert(0, ("line", "_layout_ok", "layout"))
    err_col = None
    err_code = None
    for name, flag, code in checks:
        bad = ~F.col(flag)
        err_col = F.when(bad, F.lit(name.strip())) if err_col is None else err_col.when(bad, F.lit(name.strip()))
        err_code = F.when(bad, F.lit(code)) if err_code is None else err_code.when(bad, F.lit(code))
    out = df.withColumn("ErrorColumn", err_col).withColumn("ErrorCode", err_code)
    return out.drop(CORRUPT, "_layout_ok") if CORRUPT in df.columns else out


def strict(validated: DataFrame) -> DataFrame:
    """Fail the job on the first bad line (the package's FailComponent)."""
    msg = F.concat(F.lit("bad line ("), F.col("ErrorCode"), F.lit(" in "), F.col("ErrorColumn"), F.lit("): "), F.col("_line"))
    # a filter, not a dropped column: Catalyst would prune an unused check
    return validated.filter(F.when(F.col("ErrorColumn").isNull(), F.lit(True)).otherwise(F.raise_error(msg)))


def good_lines(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("ErrorColumn").isNull())


def quarantine(validated: DataFrame) -> DataFrame:
    """Bad lines with the raw text and the error (the unused error output)."""
    return validated.filter(F.col("ErrorColumn").isNotNull()).select(
        F.col("_line").alias("raw_line"), "ErrorColumn", "ErrorCode"
    )


def map_rep_columns(validated: DataFrame, name_width: int | None = TARGET_NAME_WIDTH, keep: list[str] = ()) -> DataFrame:
    """Source -> target names and widened types.

    SalesQuantity -> TargetSalesQuantity (int), "SalesRevenue " ->
    TargetSalesRevenue (decimal(19,4), currency), Year -> TargetYear (int);
    names keep their text. A name wider than the target's width (50; an older
    target build had 255) fails the job; with None it is left to the target's
    declaration.
    """
    names = {n: F.col(n) for n in TEXT_FIELDS}
    if name_width is not None:
        width = F.lit(name_width)
        names = {n: F.when(F.length(n) > width, F.raise_error(F.lit(f"{n} too long"))).otherwise(F.col(n)) for n in TEXT_FIELDS}
    return validated.select(
        *keep,
        *[c.alias(n) for n, c in names.items()],
        F.col("_typed_SalesQuantity").cast("int").alias("TargetSalesQuantity"),
        F.col("_typed_SalesRevenue").cast("decimal(19,4)").alias("TargetSalesRevenue"),
        F.col("_typed_Year").cast("int").alias("TargetYear"),
    )


def range_sorted(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """Rows in ``order_cols`` order with their partition and position in it
    (one range exchange and a sort per partition)."""
    # a unique last sort key: rows equal on ``order_cols`` (a file delivered
    # twice) still spread over range partitions instead of one
    ordered = df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*order_cols, "_tie")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumns({"_pid": F.spark_partition_id(), "_pos": position}).drop("_tie")


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str = "ID") -> DataFrame:
    """Dense 1..n IDs in ``order_cols`` order without a single-partition window.

    The rows are range-sorted (distributed) and stored once under the shared
    checkpoint folder with their partition number and their position in it;
    counts and rows are both taken from that stored copy, so they cannot
    disagree.  A running sum over the counts (one row per partition: bounded
    by the partition count, not the data) gives each partition its first ID.
    The number of rows and the largest ID are checked against each other.
    """
    spark = df.sparkSession
    path = shared_scratch(spark, "sorted_ids", unique=True)
    range_sorted(df, order_cols).write.parquet(path)
    stored = spark.read.parquet(path)
    counts = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.max("_pos").alias("last")).orderBy("_pid").collect()
    if any(r["n"] != r["last"] + 1 for r in counts):
        raise RuntimeError("positions in the stored copy are not dense")
    starts, total = [], 0
    for r in counts:
        starts.append((r["_pid"], total))
        total += r["n"]
    offsets = spark.createDataFrame(starts, "_pid int, _offset long")
    number = (F.col("_offset") + F.col("_pos") + 1).cast("int" if total < 2**31 else "long")
    return stored.join(F.broadcast(offsets), "_pid").withColumn(id_col, number).drop("_pid", "_pos", "_offset")
