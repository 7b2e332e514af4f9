"""Typed CSV drop (header row, comma, CRLF, no text qualifier by default).

The drop is read with every field as text first: that keeps the raw value
for the quarantine, lets each field's conversion be tested on its own
(``try_cast``), and still checks the header names against the declared
layout (``enforceSchema=False``).  Everything runs in the CSV scan's tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finwater.schema import CSV_FIELDS, CSV_SCHEMA, CSV_WIDTHS
from finwater.session import path_exists, publish_once, shared_scratch, source_tag
from finwater.sources.records import MAX_BLOCKS, lines_of, records
from finwater.sources.tables import read_table, table_path

CORRUPT = "_corrupt_record"
CODE_PAGE_1252 = {"windows-1252", "cp1252", "1252"}


@dataclass(frozen=True)
class DropFormat:
    """The reader parameters of a drop.

    ``skip_header_rows`` rows are left out before the header, ``skip_rows``
    data rows after it, in every file. ``quote`` is the text qualifier (none by
    default); between qualifiers, row and column delimiters are text.
    ``line_sep`` alone ends a row (default: CR LF; a bare CR or LF is text).
    """

    encoding: str = "windows-1252"
    sep: str = ","
    header: bool = True
    quote: str | None = None
    line_sep: str = "\r\n"
    skip_header_rows: int = 0
    skip_rows: int = 0

    @property
    def charset(self) -> str:
        """Code page 1252 is read as ISO-8859-1, which keeps every byte, and
        its bytes 0x80-0x9F are mapped afterwards (``decoded``)."""
        return "ISO-8859-1" if self.encoding.lower() in CODE_PAGE_1252 else self.encoding

    def options(self) -> dict:
        own = {
            "header": self.header, "sep": self.sep, "quote": self.quote or "\u0000", "encoding": self.charset,
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "lineSep": self.line_sep,
        }
        return own | ({"escape": self.quote} if self.quote else {})  # a doubled qualifier stands for itself


DEFAULT_FORMAT = DropFormat()

TEXT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in CSV_FIELDS] + [T.StructField(CORRUPT, T.StringType())]
)


def _map_1252() -> tuple[str, str]:
    """Characters that code page 1252 gives to the bytes 0x80-0x9F (the few
    bytes it leaves undefined stay control characters)."""
    read = [chr(b) for b in range(0x80, 0xA0)]
    meant = [bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)]
    return "".join(read), "".join(meant)


def _decoded(c: Column, fmt: DropFormat) -> Column:
    return F.translate(c, *_map_1252()) if fmt.encoding.lower() in CODE_PAGE_1252 else c


def decoded(df: DataFrame, fmt: DropFormat) -> DataFrame:
    """Text columns with the characters of the drop's code page."""
    return df.select(*[
        _decoded(F.col(f"`{f.name}`"), fmt).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def read_drop_text(spark: SparkSession, path: str, fmt: DropFormat = DEFAULT_FORMAT, check_header: bool = True) -> DataFrame:
    """All five fields as text; an empty field reads as NULL.  A line with
    the wrong number of fields keeps its raw text in ``_corrupt_record``
    (a wrong header still fails the read)."""
    if needs_records(fmt):
        return parse_lines(drop_lines(spark.read, path, fmt), fmt, check_header)
    reader = spark.read.schema(TEXT_SCHEMA).options(**fmt.options()).option("enforceSchema", not check_header)
    return decoded(reader.csv(path), fmt)


def needs_records(fmt: DropFormat) -> bool:
    """Formats whose rows Spark's CSV reader cannot find in splittable files."""
    return bool(fmt.skip_header_rows or fmt.skip_rows or fmt.quote)


def drop_lines(reader, path: str, fmt: DropFormat) -> DataFrame:
    """Raw lines of a drop, from a batch or streaming reader."""
    return lines_of(reader, path, fmt.line_sep)


def parse_lines(lines: DataFrame, fmt: DropFormat, check_header: bool = True, limit: int = MAX_BLOCKS) -> DataFrame:
    """The text layout of raw lines: rows are told by the text qualifier, and
    rows to skip are left out of every file, however deep they lie."""
    head = fmt.skip_header_rows
    out_of = head + int(fmt.header) + fmt.skip_rows
    found = records(
        lines, sep=fmt.sep, quote=fmt.quote, charset=fmt.charset, line_sep=fmt.line_sep, numbered=out_of, limit=limit
    ).withColumn("line", F.decode("text", fmt.charset))
    keep = (F.col("number") >= out_of) & (F.col("line") != "")
    if fmt.header and check_header:
        names = F.replace("line", F.lit(fmt.quote), F.lit("")) if fmt.quote else F.col("line")
        wrong = (F.col("number") == head) & (names != fmt.sep.join(CSV_FIELDS))
        keep = F.when(wrong, F.raise_error(F.concat("file", F.lit(": header "), "line"))).otherwise(keep)
    options = {k: str(v) for k, v in fmt.options().items() if k not in ("header", "encoding")} | {"multiLine": "true"}
    schema = ", ".join(f"`{f.name}` STRING" for f in TEXT_SCHEMA.fields)
    parsed = found.filter(keep).select(F.from_csv(F.col("line"), schema, options).alias("r"))
    return decoded(parsed.select(*[F.col("r")[f.name].alias(f.name) for f in TEXT_SCHEMA.fields]), fmt)


def read_drop_typed(spark: SparkSession, path: str, fmt: DropFormat = DEFAULT_FORMAT, check_header: bool = True) -> DataFrame:
    """The declared typed layout straight from the CSV reader: the job fails
    on the first field that does not convert or is wider than declared."""
    options = fmt.options() | {"mode": "FAILFAST"}
    options.pop("columnNameOfCorruptRecord")
    reader = spark.read.schema(CSV_SCHEMA).options(**options).option("enforceSchema", not check_header)
    df = decoded(reader.csv(path), fmt)
    for name, width in CSV_WIDTHS.items():
        wide = F.char_length(F.col(f"`{name}`")) > width
        said = F.concat(F.lit(f"{name} is wider than {width}: "), F.col(f"`{name}`"))
        df = df.filter(F.when(F.coalesce(wide, F.lit(False)), F.raise_error(said)).otherwise(F.lit(True)))
    return df


def sales_target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales-target lines derived from ``customer`` and ``nation``.

    Nation names run to 8 letters (over the 7-letter width), a quantity of
    five times the balance overflows SMALLINT for rich customers, a negative
    balance leaves the quantity empty, and some last names hold the bytes
    0x80 and 0x9C or a bare LF -- so the drop carries every kind of line the
    load has to handle.
    """
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    odd = F.when(F.col("c_custkey") % 40 == 0, "\x80\x9c").when(F.col("c_custkey") % 40 == 7, "\n").otherwise("")
    return rows.select(
        F.regexp_replace("n_name", "_", "").alias("FirstName"),
        F.concat(F.lit("Rep"), odd, F.col("c_custkey").cast("string")).alias("LastName"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") * 5).cast("string")).alias("SalesQuantity"),
        F.floor(F.col("c_acctbal") * 100).cast("string").alias("SalesRevenue "),
        (F.lit(2000) + F.col("n_regionkey")).cast("string").alias("Year"),
    )


def qualified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with last names that need a text qualifier: row and
    column delimiters and qualifiers inside."""
    key = F.regexp_extract("LastName", "([0-9]+)$", 1).cast("long")
    name = F.when(key % 3 == 0, F.concat(F.lit('of "'), key, F.lit('",\r\n'))).when(key % 3 == 1, F.concat(key, F.lit("\r\n\r\n"))).otherwise(key.cast("string"))
    return sales_target_rows(spark, sf_dir).withColumn("LastName", name)


def write_drop(df: DataFrame, path: str, fmt: DropFormat = DEFAULT_FORMAT, before: list[str] = (), after: list[str] = ()) -> str:
    """Write lines as a CSV drop in the format's delimiters: every file has the
    header, with the rows ``before`` and ``after`` it; empty for NULL."""
    value = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    if fmt.quote:
        own = F.lit(fmt.quote)
        needs = lambda c: F.contains(value(c), own) | F.contains(value(c), F.lit(fmt.sep)) | F.contains(value(c), F.lit(fmt.line_sep))
        shown = [F.when(needs(c), F.concat(own, F.replace(value(c), own, F.concat(own, own)), own)).otherwise(value(c)) for c in df.columns]
    else:
        shown = [value(c) for c in df.columns]
    top = [*before, *([fmt.sep.join(df.columns)] if fmt.header else []), *after]
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of a file's rows
    line = F.concat_ws(fmt.sep, *shown)
    if top:
        line = F.when(first, F.concat(F.lit(fmt.line_sep.join(top) + fmt.line_sep), line)).otherwise(line)
    # the text writer takes the bytes as they are
    raw = df.select(F.encode(line, fmt.charset).cast("string").alias("value"))
    raw.write.mode("overwrite").option("lineSep", fmt.line_sep).text(path)
    return path


# bump when the derivation rule changes
DROP_VERSION = 3
#: Format of the qualified drop: two rows (one of them over two lines) before
#: the header, and a row of units after it.
QUALIFIED = DropFormat(quote='"', skip_header_rows=2, skip_rows=1)
QUALIFIED_TOP = (['Sales targets', '"of all\r\nregions",x'], ["text,text,pieces,cents,year"])


def _derived_drop(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a derived drop under the shared scratch folder (written once per
    state of the source files)."""
    tag = source_tag(spark, table_path(sf_dir, "customer"), table_path(sf_dir, "nation"))
    path = shared_scratch(spark, f"drops/{name}_v{DROP_VERSION}_{tag}.csv")
    if not path_exists(spark, path + "/_SUCCESS"):
        staging = shared_scratch(spark, "staging/drop", unique=True)
        write(staging)
        publish_once(spark, staging, path)
    return path


def sales_target_drop(spark: SparkSession, sf_dir: str) -> str:
    return _derived_drop(spark, sf_dir, "sales_target", lambda to: write_drop(sales_target_rows(spark, sf_dir), to))


def qualified_drop(spark: SparkSession, sf_dir: str) -> str:
    write = lambda to: write_drop(qualified_rows(spark, sf_dir), to, QUALIFIED, *QUALIFIED_TOP)
    return _derived_drop(spark, sf_dir, "qualified", write)
