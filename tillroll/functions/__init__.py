"""Column-level functions (built-in expressions only)."""

from tillroll.functions.columns import (fold_extras, full_name, incentive, line_money,
                                        month_bucket, total_money)

__all__ = ["fold_extras", "full_name", "incentive", "line_money", "month_bucket", "total_money"]
