"""What the target of a load declares, checked before anything is written.

A declaration lists the target's columns: type, whether NULL may stand there,
greatest width, least and greatest value, and the default that replaces NULL.
Rows that break it go to the sink's own error stream with an integer code and
the column's position, apart from the lines that the source could not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Codes of the sink's error stream.
NULL_ERROR, WIDTH_ERROR, RANGE_ERROR = 1, 2, 3
CODE, COLUMN = "SinkErrorCode", "SinkErrorColumn"


@dataclass(frozen=True)
class TargetColumn:
    """One column of a target. ``default`` is an SQL expression of constants;
    ``id`` its position in the target, from 1."""

    name: str
    type: str
    id: int
    nullable: bool = True
    width: int | None = None
    least: float | None = None
    most: float | None = None
    default: str | None = None

    def broken(self) -> list[tuple[Column, int]]:
        """(condition, code) of each of the column's constraints."""
        c, out = F.col(f"`{self.name}`"), []
        if not self.nullable:
            out.append((c.isNull(), NULL_ERROR))
        if self.width is not None:
            out.append((F.char_length(c) > self.width, WIDTH_ERROR))
        if self.least is not None:
            out.append((c < F.lit(self.least), RANGE_ERROR))
        if self.most is not None:
            out.append((c > F.lit(self.most), RANGE_ERROR))
        return [(F.coalesce(b, F.lit(False)), code) for b, code in out]


def declared_columns(spark: SparkSession, table: str) -> list[TargetColumn]:
    """The declaration of a catalogue table: types, NOT NULL and DEFAULTs."""
    return [
        TargetColumn(f.name, f.dataType.simpleString(), i, f.nullable, default=(f.metadata or {}).get("CURRENT_DEFAULT"))
        for i, f in enumerate(spark.table(table).schema.fields, 1)
    ]


def with_limits(columns: list[TargetColumn], **limits: dict) -> list[TargetColumn]:
    """The same columns with further limits, by name."""
    return [replace(c, **limits.get(c.name, {})) for c in columns]


def apply_defaults(df: DataFrame, columns: list[TargetColumn]) -> DataFrame:
    """NULL becomes the column's declared default. Empty text is no NULL."""
    made = {c.name: F.coalesce(F.col(f"`{c.name}`"), F.expr(c.default).cast(c.type)) for c in columns if c.default and c.name in df.columns}
    return df.withColumns(made) if made else df


def check_constraints(df: DataFrame, columns: list[TargetColumn], only: Column | None = None) -> DataFrame:
    """Adds the code and the column's position of the first constraint that a
    row breaks, in column order (both NULL if none, or outside ``only``)."""
    code = column = None
    for c in columns:
        for broken, number in c.broken():
            where = broken if only is None else broken & only
            code = F.when(where, number) if code is None else code.when(where, number)
            column = F.when(where, c.id) if column is None else column.when(where, c.id)
    none = F.lit(None).cast("int")
    return df.withColumns({CODE: none if code is None else code.cast("int"), COLUMN: none if column is None else column.cast("int")})


__all__ = [
    "CODE", "COLUMN", "NULL_ERROR", "RANGE_ERROR", "WIDTH_ERROR", "TargetColumn", "apply_defaults", "check_constraints",
    "declared_columns", "with_limits",
]
