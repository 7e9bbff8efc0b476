"""Column expressions shared by the operators."""

from wearline.functions.columns import (  # noqa: F401
    absolute_error, clean, ieee_div, iso_timestamp, rounded, rmse,
)
