"""Conforming accepted files to the canonical sale table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import EXTRA_SEPARATOR, fold_extras
from tillroll.schemas import ADDITIONAL_COLUMN, MANDATORY_COLUMNS, SALE, SALE_COLUMNS
from tillroll.sources.csv import CORRUPT_COLUMN, CSV_OPTIONS


def extra_columns(header: list[str]) -> list[str]:
    """Header names that are not mandatory, in header order."""
    return [c for c in header if c not in MANDATORY_COLUMNS]


def conform_frame(df: DataFrame, header: list[str], lineage: str | list[str] | None = None) -> DataFrame:
    """Bind by name (any column order), fold surplus columns into
    ``additional_column`` and cast to the declared sale schema.

    ``lineage`` names columns (e.g. the source file) kept after the nine
    canonical ones.
    """
    cols = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in SALE.fields
            if f.name != ADDITIONAL_COLUMN]
    cols.append(fold_extras(extra_columns(header)).alias(ADDITIONAL_COLUMN))
    for name in [lineage] if isinstance(lineage, str) else lineage or []:
        cols.append(F.col(name))
    return df.select(*cols)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name of already-conformed frames."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- Rows read by position (``scan_positions``) and the files' layouts ---

_TYPED = [f for f in SALE.fields if f.name in MANDATORY_COLUMNS and f.dataType.simpleString() != "string"]


def _plain(value: Column, kind: T.DataType) -> Column:
    """Whether a text is NULL or written so plainly that a cast and the CSV
    reader agree on it: digits within the type's range, or an ISO date."""
    if isinstance(kind, T.DateType):
        iso = value.rlike(r"^(1[6-9]|[2-9][0-9])[0-9]{2}-[0-9]{2}-[0-9]{2}\z")
        return value.isNull() | (iso & value.try_cast(kind).isNotNull())
    if isinstance(kind, T.DecimalType):
        digits = rf"[0-9]{{1,{kind.precision - kind.scale}}}([.][0-9]{{1,{kind.scale}}})?"
    else:
        digits = {"int": "[0-9]{1,9}", "bigint": "[0-9]{1,18}"}[kind.simpleString()]
    return value.isNull() | value.rlike(rf"^-?{digits}\z")


def layouts(accepted: DataFrame) -> DataFrame:
    """One row per accepted file: its path, the place of each mandatory
    column (``__places``) and the places of the surplus columns in header
    order (``__extras``)."""
    header, names = F.col("header"), F.array(*[F.lit(c) for c in MANDATORY_COLUMNS])
    places = F.array(*[(F.array_position(header, F.lit(c)) - 1).cast("int") for c in MANDATORY_COLUMNS])
    every = F.sequence(F.lit(0), F.size(header) - 1)
    extras = F.filter(every, lambda i: ~F.array_contains(names, F.get(header, i)))
    return accepted.select(F.col("path").alias("__path"), places.alias("__places"), extras.alias("__extras"))


def bind_positions(rows: DataFrame, layout: DataFrame) -> DataFrame:
    """P1-P3 on rows read by position: each file's layout names the values.
    Typed values are parsed as the CSV reader parses them: a row of plain
    values by casts, any other by that reader; a row that has the wrong number
    of values or one that does not parse gets a ``record``."""
    joined = rows.join(layout, F.col("source_file") == F.col("__path"))

    def value(name: str):
        return F.get("__values", F.get("__places", F.lit(MANDATORY_COLUMNS.index(name))))

    plain = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _TYPED) + f", {CORRUPT_COLUMN} string"
    parsed = F.from_csv(F.to_csv(F.struct(*[value(f.name).alias(f.name) for f in _TYPED]), plain), schema,
                        {**CSV_OPTIONS, "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    casts = F.struct(*[value(f.name).try_cast(f.dataType).alias(f.name) for f in _TYPED],
                     F.lit(None).cast("string").alias(CORRUPT_COLUMN))
    typed = F.when(reduce(lambda a, b: a & b, [_plain(value(f.name), f.dataType) for f in _TYPED]), casts).otherwise(parsed)
    # The values as CSV: quoted where they hold a separator, a quote or a line end.
    quoted = F.transform("__values", lambda v: F.when(v.rlike('[",\r\n]'), F.concat(
        F.lit('"'), F.replace(v, F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(F.coalesce(v, F.lit(""))))
    extras = F.when(F.size("__extras") > 0, F.concat_ws(EXTRA_SEPARATOR, F.transform("__extras", lambda i: F.get("__values", i))))
    bound = joined.select("source_file", "__line", "__values", typed.alias("__t"),
                          *[value(f.name).alias(f.name) for f in SALE.fields if f.name in MANDATORY_COLUMNS and f not in _TYPED],
                          extras.alias(ADDITIONAL_COLUMN))
    named = {f.name for f in _TYPED}
    columns = [(F.col(f"__t.{c}") if c in named else F.col(c)).alias(c) for c in SALE_COLUMNS]
    record = F.coalesce("__line", F.when(F.col(f"__t.{CORRUPT_COLUMN}").isNotNull(), F.array_join(quoted, ",")))
    return bound.select(*columns, "source_file", record.alias("record"),
                        F.when(record.isNotNull(), F.to_json(F.struct(*columns))).alias("parsed"))
