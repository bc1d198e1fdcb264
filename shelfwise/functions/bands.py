"""Threshold bands and label maps as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.config import RATING_LABELS, Bands


def band(col: Column | str, bands: Bands) -> Column:
    """``CASE WHEN c <= b1 THEN l1 WHEN c <= b2 THEN l2 ... ELSE top END``.

    A null (or NaN) value falls through to the top label, as in the
    reference's when/otherwise chain.
    """
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for upper, label in bands.bounds:
        cond = c <= F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(bands.top_label)
    if bands.top_label is not None:
        expr = expr.otherwise(F.lit(bands.top_label))
    return expr


def label_map(col: Column | str, pairs=RATING_LABELS) -> Column:
    """Exact-match labels without a default: anything else gives null."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for value, label in pairs:
        cond = c == F.lit(value)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
