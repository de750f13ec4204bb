"""Column expressions. All are built-in Spark expressions; there is no UDF."""

from .dates import rolling_month_start
from .nulls import first_value_of, net_amount, null_label
from .rules import case_map
from .text import ci, identity_key, normalise_text

__all__ = [
    "case_map",
    "ci",
    "first_value_of",
    "identity_key",
    "net_amount",
    "normalise_text",
    "null_label",
    "rolling_month_start",
]
