"""Spots, zero curves and dividends: two-column CSV files, and whole market folders.

Extra columns named in ``keep`` come from partition directories.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date, year_frac
from ..operators.curves import marked_curves, validate_curve
from ..operators.snapshot import latest_spot
from .chain import CHAIN_COLUMNS, parse_chain
from .positions import file_position

# Endings of the files of a market folder and the name of its curve.
SPOT_FILE, DIVIDEND_FILE = "_spot.csv", "_dividends.csv"
CALL_FILE, PUT_FILE, RATE_FILE = "_calls.csv", "_puts.csv", "treasury_rates.csv"
CURVE = "usd"
# In place of an underlier in the name of a file: lines of all underliers, each with its own in a last column.
SHARED = "all_underliers"


def _read_text(spark: SparkSession, path, columns: str) -> DataFrame:
    return (
        spark.read.schema(columns)
        .option("header", True)
        .option("enforceSchema", True)
        .csv(path)
    )


def read_spots(spark: SparkSession, path, keep: tuple[str, ...] = ()) -> DataFrame:
    """``date,spot`` files to (asof DATE, spot DOUBLE)."""
    extra = "".join(f", {c} string" for c in keep)
    raw = _read_text(spark, path, "date string, spot string" + extra)
    return raw.select(
        *keep, parse_date("date").alias("asof"), F.col("spot").try_cast("double").alias("spot")
    ).where("asof is not null and spot is not null")


def read_rates(spark: SparkSession, path, keep: tuple[str, ...] = ()) -> DataFrame:
    """``tenor,rate`` files to (tenor, rate, seq), ``seq`` being the place in the file. Fails the
    job on text that is not a number."""
    extra = "".join(f", {c} string" for c in keep)
    raw = _read_text(spark, path, "tenor string, rate string" + extra)
    return raw.select(
        *keep, F.col("tenor").cast("double").alias("tenor"),
        F.col("rate").cast("double").alias("rate"), file_position().alias("seq"),
    )


def read_dividends(spark: SparkSession, path, asof, keep: tuple[str, ...] = ()) -> DataFrame:
    """``Date,amount`` files to future dividends as of ``asof`` (a date string or Column)."""
    extra = "".join(f", {c} string" for c in keep)
    raw = _read_text(spark, path, "Date string, amount string" + extra)
    paid = raw.select(
        *keep,
        parse_date(F.substring("Date", 1, 10)).alias("pay_date"),
        F.col("amount").cast("double").alias("amount"),
    )
    return future_dividends(paid, asof)


def future_dividends(paid: DataFrame, asof: Column | str) -> DataFrame:
    """Keep payments after ``asof`` and express them as (T, alpha cash, beta proportional)."""
    asof = F.to_date(F.lit(asof)) if isinstance(asof, str) else asof
    return (
        paid.withColumn("T", year_frac(asof, "pay_date"))
        .where(F.col("T") > 0)
        .withColumnRenamed("amount", "alpha")
        .withColumn("beta", F.lit(0.0))
    )


class Market(NamedTuple):
    """Tables of one valuation date, in the order ``enrich_quotes`` takes them. ``rates`` tells in
    ``sound`` whether the tenors of the curve rise; quotes of a curve that is not sound get the
    status invalid_curve."""

    quotes: DataFrame
    spots: DataFrame
    rates: DataFrame
    dividends: DataFrame

    def curve_report(self) -> DataFrame:
        """The curves whose tenors do not rise, as ``validate_curve`` lists them."""
        return validate_curve(self.rates)


def underlier_of(path: str, ending: str) -> Column:
    """The underlier from the path of a file, or of a part of it."""
    return F.regexp_extract(path, f"(?:^|/)([^/]*){ending}(/[^/]*)?$".replace(".", "\\."), 1)


def underlier_in(path: str, ending: str, given: str = "underlier") -> Column:
    """The underlier of a line: from the path, or the column ``given`` of files named ``SHARED``."""
    shared = F.col(path).rlike(f"(^|/){SHARED}{ending}(/[^/]*)?$".replace(".", "\\."))
    return F.when(shared, F.col(given)).otherwise(underlier_of(path, ending))


def read_market(spark: SparkSession, folder: str, asof: str) -> Market:
    """All underliers of a folder with ``<underlier>_calls.csv``, ``_puts.csv``, ``_spot.csv`` and
    ``_dividends.csv`` files and one ``treasury_rates.csv``.

    A spot file may hold a history: the last spot up to ``asof`` counts. Each kind of file is one
    scan; the underlier is taken from the file name, or from the last column of the files called
    ``SHARED``. In place of a file there may be a folder of that name with its parts. A folder without
    any file of a kind fails when it is read, except dividends, which may be absent for some.
    """

    def named(ending: str, columns: str) -> DataFrame:
        files = _read_text(spark, f"{folder}/*{ending}", columns + ", underlier string")
        return files.withColumn("underlier", underlier_in("_metadata.file_path", ending))

    chain_columns = ", ".join(f"{c} string" for c in CHAIN_COLUMNS)
    sides = [
        parse_chain(named(ending, chain_columns), is_call, ("underlier",))
        for ending, is_call in ((CALL_FILE, True), (PUT_FILE, False))
    ]
    history = named(SPOT_FILE, "date string, spot string").select(
        "underlier", parse_date("date").alias("asof"), F.col("spot").try_cast("double").alias("spot")
    )
    known = history.where((F.col("asof") <= F.to_date(F.lit(asof))) & (F.col("spot") > 0))
    paid = named(DIVIDEND_FILE, "Date string, amount string").select(
        "underlier",
        parse_date(F.substring("Date", 1, 10)).alias("pay_date"),
        F.col("amount").cast("double").alias("amount"),
    )
    curve = F.lit(CURVE).alias("curve_id")
    return Market(
        sides[0].unionByName(sides[1]).select("*", curve),
        latest_spot(known).select("underlier", "spot"),
        marked_curves(read_rates(spark, f"{folder}/{RATE_FILE}").select("*", curve)),
        future_dividends(paid, asof).select("*", curve),
    )
