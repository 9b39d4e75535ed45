"""Row-level quote expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .backend import INLINE, positive, sql


def mid(bid="bid", ask="ask") -> Column:
    return ((sql(bid) + sql(ask)) * 0.5).column


def log_moneyness(strike="strike", forward="forward") -> Column:
    """ln(K/F); NULL unless both are positive."""
    return INLINE.log(positive(strike) / positive(forward)).column


def is_two_sided(bid: str = "bid", ask: str = "ask") -> Column:
    """Both sides quoted above zero. NaN compares above every number, so it is excluded by hand."""
    return F.expr(f"{bid} > 0 and {ask} > 0 and not isnan({bid}) and not isnan({ask})")


def has_exercise(style: str, exercise: str = "exercise") -> Column:
    """Case-insensitive exercise style test: feeds write both ``american`` and ``American``."""
    return F.lower(F.trim(exercise)) == style.lower()
