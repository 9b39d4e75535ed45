"""Quotes stored in the layout that their enrichment needs, so that they are shuffled once only."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.snapshot import MATURITY

MARKET_KEYS = ("underlier", "curve_id", MATURITY)
BUCKETS = 64


def _bucketed(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def store_quotes(
    quotes: DataFrame, table: str, path: str, buckets: int = BUCKETS, keys: Sequence[str] = MARKET_KEYS
) -> DataFrame:
    """Write ``quotes`` at ``path`` as a Parquet table bucketed by ``keys``; the stored quotes, which
    have one more column, ``maturity``.

    ``keys`` are those that ``enrich_quotes`` joins on, the maturity among them, so the chain of a
    hot underlier spreads over buckets. One shuffle brings each bucket into one file. What is
    computed per expiry, and the join of the quotes with it, then start from the files as they lie.
    """
    laid_out = quotes.withColumn(MATURITY, F.xxhash64("T")).repartition(buckets, *keys)
    writer = laid_out.write.format("parquet").mode("errorifexists").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return quotes.sparkSession.table(table)


def open_quotes(
    spark: SparkSession, table: str, path: str, schema: T.StructType, buckets: int = BUCKETS,
    keys: Sequence[str] = MARKET_KEYS,
) -> DataFrame:
    """The quotes that ``store_quotes`` wrote at ``path``, in a session whose catalog does not know
    them. Schema, buckets and keys are those of the writer."""
    by = ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"create table {_bucketed(table)} ({columns}) using parquet clustered by ({by}) sorted by ({by}) "
        f"into {buckets} buckets location '{path}'"
    )
    return spark.table(table)
