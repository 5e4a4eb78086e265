"""Column-expression helpers (built-in Spark functions only, no UDFs)."""

from .rounding import half_away, money_avg, money_sum, ratio
from .scalar import (flag, is_large, is_night, is_weekend, log_amount, safe_divide,
                     tx_day, tx_day_of_week, tx_hour, zscore)

__all__ = ["half_away", "money_avg", "money_sum", "ratio", "flag",
           "is_large", "is_night", "is_weekend", "log_amount", "safe_divide", "tx_day",
           "tx_day_of_week", "tx_hour", "zscore"]
