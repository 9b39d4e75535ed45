"""One formula text, three evaluations.

A closed form takes a backend ``m`` and marks its shared terms with ``m.let``, which returns one
value per term:

* ``INLINE`` renders SQL text for a single Column; ``let`` does nothing;
* ``Staged(df)`` renders SQL text too, and ``let`` adds the terms to the DataFrame as columns, so
  later text refers to them by name. Catalyst keeps such projections apart when a term is used
  more than once, and code generation fuses them again: each term is computed once per row and the
  expression trees stay small;
* ``ARRAY`` computes on numpy arrays.

Division renders as ``try_divide``: a zero divisor gives NULL instead of an ANSI error.
"""

from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# How tightly SQL text binds: a comparison, a sum, a product, anything self-contained.
COMPARISON, SUM, PRODUCT, ATOM = range(4)


class Sql:
    """SQL expression text with arithmetic; parentheses appear only where they are needed."""

    def __init__(self, text: str, binds: int = ATOM):
        self.text = text
        self.binds = binds

    def __str__(self) -> str:
        return self.text

    def _join(self, operator, other, binds, swap=False):
        left, right = (sql(other), self) if swap else (self, sql(other))
        a = left.text if left.binds >= binds else f"({left})"
        b = right.text if right.binds > binds else f"({right})"
        return Sql(f"{a} {operator} {b}", binds)

    def __add__(self, other):
        return self._join("+", other, SUM)

    def __radd__(self, other):
        return self._join("+", other, SUM, swap=True)

    def __sub__(self, other):
        return self._join("-", other, SUM)

    def __rsub__(self, other):
        return self._join("-", other, SUM, swap=True)

    def __mul__(self, other):
        return self._join("*", other, PRODUCT)

    def __rmul__(self, other):
        return self._join("*", other, PRODUCT, swap=True)

    def __truediv__(self, other):
        return Sql(f"try_divide({self}, {sql(other)})")

    def __rtruediv__(self, other):
        return Sql(f"try_divide({sql(other)}, {self})")

    def __neg__(self):
        return Sql(f"negative({self})")

    def __gt__(self, other):
        return self._join(">", other, COMPARISON)

    def __lt__(self, other):
        return self._join("<", other, COMPARISON)

    def __le__(self, other):
        return self._join("<=", other, COMPARISON)

    def __and__(self, other):
        return Sql(f"(({self}) and ({sql(other)}))")

    @property
    def column(self) -> Column:
        return F.expr(self.text)


def sql(value) -> Sql:
    """Text as it is (in parentheses unless a bare name), bools and numbers as literals."""
    if isinstance(value, Sql):
        return value
    if isinstance(value, str):
        bare = value.replace("_", "").replace(".", "").isalnum()
        return Sql(value, ATOM if bare else COMPARISON - 1)
    if isinstance(value, bool):
        return Sql(str(value).lower())
    text = f"{float(value)!r}D"
    return Sql(f"({text})" if text.startswith("-") else text)


def positive(value) -> Sql:
    """``value`` where it is a number above zero, else NULL.

    Guarding one operand is enough, since NULL propagates through the rest of the arithmetic, and
    no CASE branch hides shared terms from the optimizer. NaN sorts above every number in Spark,
    hence the explicit test.
    """
    value = sql(value)
    return Sql(f"case when {value > 0.0} and not isnan({value}) then {value} end")


def _function(name: str):
    return lambda *arguments: Sql(f"{name}({', '.join(str(sql(a)) for a in arguments)})")


def _same(*terms):
    return terms


class Inline:
    sqrt = staticmethod(_function("sqrt"))
    exp = staticmethod(_function("exp"))
    log = staticmethod(_function("ln"))
    abs = staticmethod(_function("abs"))
    capped = staticmethod(_function("least"))
    let = staticmethod(_same)

    @staticmethod
    def indicator(condition) -> Sql:
        return Sql(f"cast({condition} as double)")


class Staged(Inline):
    """Collects shared terms as columns of a DataFrame; ``done`` leaves only the outputs."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.columns = df.columns
        self.count = 0

    def let(self, *terms):
        names = [f"_term{self.count + i}" for i in range(len(terms))]
        self.count += len(terms)
        self.df = self.df.selectExpr("*", *[f"{t} as {n}" for t, n in zip(terms, names)])
        return tuple(Sql(n) for n in names)

    def done(self, **outputs) -> DataFrame:
        kept = [F.col(f"`{c}`") for c in self.columns if c not in outputs]
        return self.df.select(*kept, *[F.expr(f"{sql(t)} as {n}") for n, t in outputs.items()])


INLINE = Inline()

ARRAY = SimpleNamespace(
    sqrt=np.sqrt,
    exp=np.exp,
    log=np.log,
    abs=np.abs,
    capped=np.minimum,
    indicator=lambda condition: np.asarray(condition, dtype=np.float64),
    let=_same,
)
