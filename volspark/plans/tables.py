"""Option-market tables derived from the star-schema tables.

``part`` supplies the underliers and their spots, ``lineitem`` the quotes, ``nation`` one zero
curve each, ``orders`` a daily rate history. Everything is a lazy DataFrame over the full tables.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.black import with_bs_price
from ..functions.ssvi import with_ssvi_iv
from ..operators.surfaces import literal_rows

# Valuation date, flat rate of the plain pricing queries, and the base zero curve
# (tenor in years, rate).
ASOF = "1995-01-01"
FLAT_RATE = 0.03
BASE_CURVE = (
    (1.0 / 12.0, 0.021), (0.25, 0.0235), (0.5, 0.022), (1.0, 0.026),
    (2.0, 0.0305), (5.0, 0.029), (10.0, 0.0365), (30.0, 0.041),
)
HISTORY_TENORS = {
    "m1": 1.0 / 12.0, "m3": 0.25, "m6": 0.5, "y1": 1.0,
    "y2": 2.0, "y5": 5.0, "y10": 10.0, "y30": 30.0,
}
CURVES = 25
TASK_ROWS = 500_000  # line items that a task groups at most, about, where they are dealt first


def asof() -> Column:
    return F.to_date(F.lit(ASOF))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_curve(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", f"cast(underlier % {CURVES} as int) as curve_id")


def with_surface(df: DataFrame, underlier: str = "underlier") -> DataFrame:
    """SSVI parameters of an underlier."""
    return df.selectExpr(
        "*",
        f"{underlier} % 7 * 1e-1 - 7e-1 as rho",
        f"{underlier} % 5 * 1e-1 + 5e-1 as eta",
        f"{underlier} % 6 * 5e-2 + 2e-1 as gam",
        f"{underlier} % 8 * 1e-2 + 3e-2 as nu",
    )


# What makes a quote.
QUOTE_KEYS = ("underlier", "qty", "days", "is_call")


def _quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quote of each line item."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey as underlier",
        "cast(l_quantity as int) as qty",
        f"cast(datediff(l_shipdate, date '{ASOF}') % 359 + 7 as int) as days",
        "l_linenumber % 2 = 0 as is_call",
        "l_returnflag",
        "l_quantity",
        "l_discount",
    )


def _grouped(rows: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Quotes from those of line items, with the columns ``carried`` that depend on the keys."""
    grouped = rows.groupBy(*QUOTE_KEYS).agg(
        F.min("l_returnflag").alias("flag"),
        F.sum("l_quantity").alias("quantity"),
        F.count("*").alias("open_interest"),
        F.max("l_discount").alias("discount"),
        *[F.min(c).alias(c) for c in carried],
    )
    return grouped.selectExpr(
        "((underlier * 64 + qty) * 512 + days) * 2 + cast(is_call as int) as quote_id",
        *QUOTE_KEYS,
        "days / 365e0 as T",
        "case when flag = 'R' then 'american' else 'european' end as exercise",
        "(qty - 25) / 62.5e0 as k",
        "cast(quantity as bigint) as volume",
        "open_interest",
        "discount / 1e1 as spread_frac",
        *carried,
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per (underlier, qty, days, side): quote_id, T, volume, open_interest, ..."""
    return _grouped(_quoted(spark, sf_dir))


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").selectExpr(
        "p_partkey as underlier", "p_retailprice as spot"
    )


def dealt_spot_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes with spot, from line items dealt to tasks of about ``TASK_ROWS``, both sides of a strike
    to the same one: what a task holds when it groups them does not grow with the table.

    Nearly every line item is a quote of its own, so that grouping them where they are read, or
    before the spots are joined, would save no exchange.
    """
    rows = _quoted(spark, sf_dir).join(spots(spark, sf_dir), "underlier")
    count = load(spark, sf_dir, "lineitem").count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-count // TASK_ROWS))
    return _grouped(rows.repartition(tasks, "underlier", "qty", "days"), ("spot",))


def chain(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Quotes with spot, strike = spot e^k, surface parameters and the true vol (4 decimals)."""
    rows = quotes(spark, sf_dir).join(spots(spark, sf_dir), "underlier")
    rows = with_surface(dealt_spot_quotes(spark, sf_dir) if dealt else rows)
    rows = with_ssvi_iv(rows, "model_iv")
    return rows.selectExpr(
        "* except (model_iv)", "spot * exp(k) as strike", "round(model_iv, 4) as sigma_true"
    )


def is_liquid(width: float = 2.0) -> Column:
    """Quotes close enough to the money for a price to pin down its vol."""
    return F.expr(f"abs(k) <= sigma_true * sqrt(T) * {width}D")


def with_flat_price(df: DataFrame, name: str = "price", is_call: str = "is_call") -> DataFrame:
    """Black-Scholes price at the true vol."""
    return with_bs_price(df, name, r=FLAT_RATE, q=0.0, sigma="sigma_true", is_call=is_call)


def priced_quotes(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Chain with bid and ask around the Black-Scholes price at the true vol."""
    return with_flat_price(chain(spark, sf_dir, dealt)).selectExpr(
        "*", "price * (1e0 - spread_frac) as bid", "price * (1e0 + spread_frac) as ask"
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain(spark, sf_dir).selectExpr(
        "quote_id as contract_id", "spot", "strike", "T", "sigma_true as sigma",
        "5e-2 as r", "2e-2 as q", "is_call", "exercise", "k", "rho", "eta", "gam", "nu",
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zero curve per nation: the base curve shifted by its key in basis points."""
    nodes = literal_rows(("tenor", "base"), BASE_CURVE)
    return (
        load(spark, sf_dir, "nation")
        .selectExpr("cast(n_nationkey as int) as curve_id", f"inline({nodes}) as (tenor, base)")
        .selectExpr("curve_id", "tenor", "base + curve_id * 1e-4 as rate")
    )


def paid_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight quarterly payments per underlier around the valuation date."""
    return (
        load(spark, sf_dir, "part")
        .selectExpr("p_partkey", "p_retailprice", "explode(sequence(0, 7)) as i")
        .selectExpr(
            "p_partkey as underlier",
            f"date_add(date '{ASOF}', cast(i * 91 - 365 + p_partkey % 30 as int)) as pay_date",
            "round(p_retailprice * 1e-3, 4) as amount",
        )
    )


def rate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily percent rates per customer, one column per tenor, with gaps."""
    return load(spark, sf_dir, "orders").selectExpr(
        "o_custkey as curve_id",
        "to_date(o_orderdate) as asof",
        *[
            f"case when o_orderkey % 11 <> {i} then sqrt(o_totalprice) / 1e2 + 1e-2 * {i} end "
            f"as {name}"
            for i, name in enumerate(HISTORY_TENORS)
        ],
    )


def chain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a chain file as text columns, some of them malformed."""
    rows = load(spark, sf_dir, "lineitem").selectExpr("*", "cast(l_quantity as int) as qty")
    return rows.selectExpr(
        "l_partkey as underlier",
        "l_linenumber % 2 = 0 as side",
        "date_format(l_shipdate, 'yyyy-MM-dd') as expiration",
        "concat(qty, 'e-2') as T",
        "'not read' as daysToExpiry",
        "'not read' as type",
        "case l_returnflag when 'R' then 'American' when 'A' then 'american' else 'European' end "
        "as exerciseType",
        "case when qty = 13 then 'n/a' else string(qty * 10) end as strike",
        "case when qty % 10 = 0 then '' when qty = 7 then 'nan' when qty = 9 then '0' "
        "else concat(qty, 'e-1') end as bid",
        "case when qty = 17 then '-1' else concat(qty + 1, 'e-1') end as ask",
        "cast(null as string) as lastPrice",
        "case when qty = 23 then '12abc' else concat(qty, '.7') end as volume",
        "case when qty <> 29 then string(l_linenumber) end as openInterest",
        "cast(null as string) as impliedVolatility",
    )


def folder_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of a market folder with an underlier per supplier: columns of a chain file, some
    of them malformed, and ``row``, the key of the line item (as lastPrice in the file)."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        "concat('S', l_suppkey) as underlier",
        "l_linenumber % 2 = 0 as is_call",
        f"date_add(date '{ASOF}', cast(l_quantity * 7 as int)) as expiration",
        "cast(l_quantity * 7 as int) / 365e0 as T",
        "if(l_returnflag = 'R', 'American', 'european') as exerciseType",
        "if(l_linenumber = 5, 'n/a', string(cast(l_extendedprice as int))) as strike",
        "if(l_linenumber = 6, 0e0, 1e0 + l_discount) as bid",
        "2e0 + l_tax as ask",
        "l_orderkey * 8 + l_linenumber as lastPrice",
        "cast(l_quantity as int) as volume",
        "if(l_linenumber = 7, null, l_linenumber) as openInterest",
    )


def folder_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of spots per supplier."""
    return load(spark, sf_dir, "supplier").selectExpr(
        "concat('S', s_suppkey) as underlier", f"explode(sequence(date '{ASOF}', date '{ASOF}' + 1)) as date"
    ).selectExpr("underlier", "date", f"1e2 + datediff(date, date '{ASOF}') + length(underlier) as spot")


def folder_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").selectExpr(
        "concat('S', s_suppkey) as underlier", f"explode(sequence(date '{ASOF}' - 90, date '{ASOF}' + 300, interval 91 days)) as Date"
    ).selectExpr("underlier", "Date", "1e0 + length(underlier) / 8e0 as amount")


def curve_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of 97 curves in the order of ``seq``: every fifth curve steps back at times, and every
    seventh lacks tenors."""
    return load(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey % 97 as int) as curve_id",
        "o_orderkey as seq",
        "case when o_custkey % 97 % 7 = 3 and o_orderkey % 50 = 1 then null "
        "when o_custkey % 97 % 5 = 2 and o_orderkey % 20 = 3 then 1e-3 else o_orderkey / 36e1 end as tenor",
        "2e-2 + o_custkey % 97 * 1e-4 as rate",
    )


def dated_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of many dates: one per line item, on its shipping day."""
    return load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as quote_id", "l_partkey as underlier",
        f"cast(l_partkey % {CURVES} as int) as curve_id", "to_date(l_shipdate) as asof",
        "l_linenumber * 40 / 365e0 as T", "l_extendedprice / l_quantity as strike",
        "1e0 + l_discount as bid", "2e0 + l_tax as ask",
    )


def spot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spot every ninety days for each underlier, from March 1992 on."""
    return load(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_retailprice", "explode(sequence(0, 27)) as i"
    ).selectExpr(
        "p_partkey as underlier", "date_add(date '1992-03-01', cast(i * 90 + p_partkey % 30 as int)) as asof",
        "p_retailprice + i as spot",
    )


def curve_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly curves from February 1992 on, with weeks missing."""
    nodes = literal_rows(("tenor", "base"), BASE_CURVE)
    return (
        load(spark, sf_dir, "nation")
        .selectExpr("cast(n_nationkey as int) as curve_id", "explode(sequence(0, 399)) as week")
        .where("(week * 7 + curve_id) % 5 <> 0")
        .selectExpr("curve_id", "date_add(date '1992-02-01', week * 7) as asof", "week", f"inline({nodes}) as (tenor, base)")
        .selectExpr("curve_id", "asof", "tenor", "base + curve_id * 1e-4 + week % 10 * 1e-3 as rate")
    )


def payment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly payments from 1992 on."""
    return load(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_retailprice", "explode(sequence(0, 35)) as i"
    ).selectExpr(
        "p_partkey as underlier", "date_add(date '1992-01-10', cast(i * 91 + p_partkey % 30 as int)) as pay_date",
        "round(p_retailprice * 1e-3, 4) as amount",
    )
