"""Option-chain files: CSV, positional, header skipped, bad lines dropped, counted or kept apart."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quotes import has_exercise, is_two_sided
from .positions import file_position

# Column order of a chain file.
CHAIN_COLUMNS = (
    "expiration", "T", "daysToExpiry", "type", "exerciseType", "strike",
    "bid", "ask", "lastPrice", "volume", "openInterest", "impliedVolatility",
)
CHAIN_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CHAIN_COLUMNS])


def _number(name: str) -> Column:
    """Numeric text as DOUBLE; blank, malformed or NaN is NULL."""
    return F.nanvl(F.col(name).try_cast("double"), F.lit(None).cast("double"))


def _count(name: str) -> Column:
    """Integer part of a numeric text, so ``12.0`` reads as 12."""
    return _number(name).try_cast("int")


def parse_chain(raw: DataFrame, is_call: bool | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Type a chain whose columns are all text and keep the two-sided, well-formed quotes.

    A row whose T, strike, bid, ask, volume or openInterest is not a number is dropped; the other
    columns are never looked at. ``keep`` names extra columns to carry through (say, underlier).
    """
    side = is_call if isinstance(is_call, Column) else F.lit(is_call)
    typed = raw.select(
        *keep,
        _number("strike").alias("strike"),
        _number("T").alias("T"),
        side.alias("is_call"),
        F.when(has_exercise("american", "exerciseType"), "american")
        .otherwise("european")
        .alias("exercise"),
        _number("bid").alias("bid"),
        _number("ask").alias("ask"),
        _count("volume").alias("volume"),
        _count("openInterest").alias("open_interest"),
    )
    return typed.where(
        is_two_sided()
        & F.col("strike").isNotNull()
        & F.col("T").isNotNull()
        & F.col("volume").isNotNull()
        & F.col("open_interest").isNotNull()
    )


# The columns that must be numbers, in file order, and the cause of what is left without a market.
NUMBERS = ("T", "strike", "bid", "ask", "volume", "openInterest")
ONE_SIDED = "one_sided"


def reject_cause() -> Column:
    """Why ``parse_chain`` drops a row of text columns: ``malformed_<column>`` for the first column
    that is not a number, else ``one_sided`` where bid or ask is not above zero; NULL if it stays."""
    cause = F.when(_number("T").isNull(), f"malformed_{NUMBERS[0]}")
    for name in NUMBERS[1:]:
        value = _count(name) if name in ("volume", "openInterest") else _number(name)
        cause = cause.when(value.isNull(), f"malformed_{name}")
    return cause.when((_number("bid") <= 0) | (_number("ask") <= 0), ONE_SIDED)


def chain_rejects(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows that ``parse_chain`` drops, as they were read, with their ``cause``."""
    return raw.select(*keep, *CHAIN_COLUMNS, reject_cause().alias("cause")).where("cause is not null")


def reject_report(rejects: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows per cause (and key)."""
    return rejects.groupBy(*keys, "cause").agg(F.count("*").alias("rows"))


def observed_chain(
    raw: DataFrame, is_call: bool | Column, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, Observation]:
    """``parse_chain``, and an observation that holds, once an action has run over the quotes, the
    rows read (``rows``) and the rows dropped for each cause. It costs no pass of its own."""
    seen = Observation()
    causes = [f"malformed_{name}" for name in NUMBERS] + [ONE_SIDED]
    counts = [F.count_if(F.coalesce(reject_cause() == c, F.lit(False))).alias(c) for c in causes]
    return parse_chain(raw.observe(seen, F.count("*").alias("rows"), *counts), is_call, keep), seen


def read_chain_text(spark: SparkSession, path, keep: tuple[str, ...] = ()) -> DataFrame:
    """The lines of chain CSV files as text columns, with their ``position`` in the files."""
    schema = T.StructType(CHAIN_SCHEMA.fields + [T.StructField(c, T.StringType()) for c in keep])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .csv(path)
    )
    return raw.select("*", file_position().alias("position"))


def read_chain(
    spark: SparkSession, path, is_call: bool | Column, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Read chain CSV files. Partition directories (``underlier=…/asof=…``) become columns;
    name them in ``keep`` to carry them along, and ``position`` to have the order of the files."""
    named = tuple(c for c in keep if c != "position")
    return parse_chain(read_chain_text(spark, path, named), is_call, keep)
