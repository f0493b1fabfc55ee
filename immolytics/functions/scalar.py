"""Scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even(c: Column | str, decimals: int = 2) -> Column:
    """NumPy-style rounding: ``rint(x * 10^d) / 10^d`` (ties to even on the binary value)."""
    col = F.col(c) if isinstance(c, str) else c
    scale = 10.0 ** decimals
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def oui_non(c: Column | str) -> Column:
    """'Oui' -> 1, 'Non' -> 0 (case and accents ignored), other values NULL."""
    col = F.lower(F.trim(F.col(c) if isinstance(c, str) else c))
    return F.when(col == "oui", 1).when(col == "non", 0)
