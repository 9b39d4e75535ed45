"""Day counts. Dividends and quotes use different bases, so the basis is always an argument."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days per year on the dividend side and on the quote side.
DIVIDEND_BASIS = 365.25
QUOTE_BASIS = 365.0


def parse_date(text: str | Column) -> Column:
    """ISO ``YYYY-MM-DD`` text to DATE; anything else is NULL."""
    return F.try_to_date(text, "yyyy-MM-dd")


def year_frac(start, end, basis: float = DIVIDEND_BASIS) -> Column:
    """Actual days from ``start`` to ``end`` over ``basis``; negative when ``end`` comes first."""
    return F.datediff(end, start) / F.lit(basis)


def expiry_years(days: str) -> Column:
    """Quote-side year fraction: days / 365 to six decimals."""
    return F.round(F.col(days) / F.lit(QUOTE_BASIS), 6)
