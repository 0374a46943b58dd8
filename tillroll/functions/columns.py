"""Column expressions (P1, P2, P6, P7, P10-P13). All are Spark built-ins, so
they stay inside whole-stage codegen; no UDF is involved anywhere."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import LINE_MONEY, TOTAL_MONEY

# Separator for folded surplus columns, separator of a full
# name, incentive rate for the top seller and its rounding scale.
EXTRA_SEPARATOR = ", "
NAME_SEPARATOR = " "
INCENTIVE_RATE = Decimal("0.01")
INCENTIVE_SCALE = 2


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_extras(extra_columns: list[str]) -> Column:
    """Surplus columns joined by ``", "`` in header order.

    NULLs are skipped (``concat_ws``); all-NULL gives ``''``; no surplus
    column at all gives a typed NULL.
    """
    if not extra_columns:
        return F.lit(None).cast("string")
    return F.concat_ws(EXTRA_SEPARATOR, *[F.col(f"`{c}`").cast("string") for c in extra_columns])


def full_name(first: str | Column, last: str | Column) -> Column:
    """First + ' ' + last, NULL when either part is NULL."""
    return F.concat(_c(first), F.lit(NAME_SEPARATOR), _c(last))


def month_bucket(date_col: str | Column) -> Column:
    """``'yyyy-MM'`` from a DATE (first seven characters of its ISO text).

    Date based on purpose: it never goes through a time zone.
    """
    return F.substring(_c(date_col).cast("date").cast("string"), 1, 7)


def line_money(c: str | Column) -> Column:
    return _c(c).cast(LINE_MONEY)


def total_money(c: str | Column) -> Column:
    return _c(c).cast(TOTAL_MONEY)


def incentive(total: str | Column, is_top: Column) -> Column:
    """1 % of the total for a top seller, rounded HALF_UP to 2
    digits; 0 for everyone else. Decimal throughout (a bare 0.01 would turn
    the product into a double)."""
    earned = F.round(_c(total) * F.lit(INCENTIVE_RATE), INCENTIVE_SCALE)
    return F.when(is_top, earned).otherwise(F.lit(Decimal("0.00"))).cast(TOTAL_MONEY)
