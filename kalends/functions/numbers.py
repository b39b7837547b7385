"""Errors and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def signed_error_bps(forecast: Column, truth: Column) -> Column:
    return (forecast / truth - 1) * 10000


def absolute_error_bps(forecast: Column, truth: Column) -> Column:
    return F.abs(signed_error_bps(forecast, truth))


def round_half_even(col: Column, places: int) -> Column:
    """Banker's rounding on the exact decimal reading of the value."""
    return F.bround(col, places)


def rnd(col: Column, places: int = 6) -> Column:
    """Rounded output value; floating sums depend on row order beyond these places."""
    return F.round(col, places)
