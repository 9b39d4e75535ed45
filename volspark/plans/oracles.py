"""DuckDB SQL for every job in ``queries``, over the same star-schema tables.

The statements restate the definitions in plain SQL (brute-force joins, textbook formulas) rather
than the way the operators compute them. Inversion and calibration oracles select the true
parameters the prices were made from.
"""

from .queries import BOUND_CANDIDATES, CANDIDATES, K_GRID, MANY, T_GRID, WIDE_K_GRID, WIDE_T_GRID
from .tables import BASE_CURVE, CURVES, HISTORY_TENORS

ORACLES: dict[str, str] = {}

ASOF = "date '1995-01-01'"


def r(expression: str, name: str, digits: int = 6) -> str:
    """Rounded output column."""
    return f"{rounded(expression, digits)} as {name}"


def rounded(expression: str, digits: int = 6) -> str:
    """Adding zero turns -0 into 0."""
    return f"round({expression}, {digits}) + 0e0"


def number(value: float) -> str:
    return f"{value!r}e0" if "e" not in repr(value) else repr(value)


def values(items) -> str:
    return ", ".join(f"({number(float(v))})" for v in items)


def cdf(x: str) -> str:
    """Normal distribution function: Hart's rational below 7.07, a continued fraction above."""
    a = f"abs({x})"
    top = (
        f"((((((3.52624965998911e-2*{a}+7.00383064443688e-1)*{a}+6.37396220353165e0)*{a}"
        f"+3.3912866078383e1)*{a}+1.12079291497871e2)*{a}+2.21213596169931e2)*{a}"
        f"+2.20206867912376e2)"
    )
    bottom = (
        f"(((((((8.83883476483184e-2*{a}+1.75566716318264e0)*{a}+1.6064177579207e1)*{a}"
        f"+8.67807322029461e1)*{a}+2.96564248779674e2)*{a}+6.37333633378831e2)*{a}"
        f"+7.93826512519948e2)*{a}+4.40413735824752e2)"
    )
    far = f"({a}+1e0/({a}+2e0/({a}+3e0/({a}+4e0/({a}+6.5e-1)))))/2.506628274631e0"
    tail = (
        f"case when {a} > 37e0 then 0e0 when {a} < 7.07106781186547e0 "
        f"then exp(-{a}*{a}/2e0)*{top}/{bottom} else exp(-{a}*{a}/2e0)/{far} end"
    )
    return f"(case when {x} > 0e0 then 1e0-({tail}) else {tail} end)"


def pdf(x: str) -> str:
    return f"(exp(-({x})*({x})/2e0)/sqrt(2e0*pi()))"


QUOTES = f"""
quotes as (
  select ((underlier*64+qty)*512+days)*2+cast(is_call as int) as quote_id, underlier, qty, days,
    is_call, days/365e0 as T, case when flag = 'R' then 'american' else 'european' end as exercise,
    (qty-25)/62.5e0 as k, volume, open_interest, spread_frac, cast(underlier%25 as int) as curve_id,
    -7e-1+1e-1*(underlier%7) as rho, 5e-1+1e-1*(underlier%5) as eta,
    2e-1+5e-2*(underlier%6) as gam, 3e-2+1e-2*(underlier%8) as nu
  from (
    select l_partkey as underlier, cast(l_quantity as int) as qty,
      cast(7+(date_diff('day', {ASOF}, cast(l_shipdate as date)) % 359) as int) as days,
      (l_linenumber % 2 = 0) as is_call, min(l_returnflag) as flag,
      cast(sum(l_quantity) as bigint) as volume, count(*) as open_interest,
      max(l_discount)/1e1 as spread_frac
    from lineitem group by 1, 2, 3, 4) g)"""


def ssvi_terms(source: str, eta: str = "eta") -> str:
    """Subquery over ``source`` adding th, ph, u = ph k + rho, and d = sqrt(u^2 + 1 - rho^2)."""
    return f"""(
  select *, sqrt(u*u+1e0-rho*rho) as d from (
    select *, ph*k+rho as u from (
      select *, {eta}/(pow(th,gam)*pow(1e0+th,1e0-gam)) as ph from (
        select *, nu*T as th from {source}) a) b) c) t"""


SURFACE_W = "th/2e0*(1e0+rho*ph*k+d)"
SLOPE_K = "th/2e0*(rho*ph+ph*u/d)"
CURVATURE_K = "th/2e0*ph*ph*(1e0-rho*rho)/pow(d*d,1.5e0)"
SLOPE_T = (
    "nu*(5e-1*(1e0+rho*ph*k+d)"
    "-th*5e-1*ph*(gam/th+(1e0-gam)/(1e0+th))*k*(rho+u/d))"
)

SURFACED = f"""
surfaced as (
  select *, {SURFACE_W} as w, sqrt(({SURFACE_W})/T) as iv from {ssvi_terms("quotes")})"""

CHAIN = f"""{QUOTES}, {SURFACED},
chain as (
  select s.*, p_retailprice as spot, p_retailprice*exp(k) as strike, round(iv, 4) as sigma_true
  from surfaced s join part on p_partkey = underlier)"""

# Black-Scholes at the true vol with rate 3 % and no dividends.
PRICED = f"""{CHAIN},
leveled as (
  select *, (ln(spot/strike)+(3e-2+5e-1*sigma_true*sigma_true)*T)/(sigma_true*sqrt(T)) as d1,
    (ln(spot/strike)+(3e-2-5e-1*sigma_true*sigma_true)*T)/(sigma_true*sqrt(T)) as d2
  from chain),
priced as (
  select *, spot*{cdf("d1")}-strike*exp(-3e-2*T)*{cdf("d2")} as call_price,
    strike*exp(-3e-2*T)*{cdf("-d2")}-spot*{cdf("-d1")} as put_price from leveled),
flat as (select *, case when is_call then call_price else put_price end as price from priced)"""

CURVE_NODES = ", ".join(f"({number(t)}, {number(rate)})" for t, rate in BASE_CURVE)
RATES = f"""
rates as (
  select cast(n_nationkey as int) as curve_id, tenor, rate+n_nationkey*1e-4 as rate
  from nation cross join (values {CURVE_NODES}) b(tenor, rate)),
segments as (
  select curve_id, tenor as lo, rate as r_lo,
    lead(tenor) over w as hi, lead(rate) over w as r_hi, row_number() over w as i
  from rates window w as (partition by curve_id order by tenor)),
first_node as (select curve_id, lo, r_lo from segments where i = 1)"""


def rate_at(curve: str, T: str) -> str:
    """Scalar subquery: linear inside the curve, flat outside."""
    return f"""(
    select case when {T} <= (select lo from first_node f where f.curve_id = {curve})
      then (select r_lo from first_node f where f.curve_id = {curve})
      else (select max(case when hi is null then r_lo
                            else r_lo+({T}-lo)*(r_hi-r_lo)/(hi-lo) end)
            from segments s where s.curve_id = {curve} and {T} > lo
              and (hi is null or {T} <= hi)) end)"""


DIVIDENDS = f"""
paid as (
  select p_partkey as underlier,
    cast({ASOF}+cast(-365+91*i+p_partkey%30 as int) as date) as pay_date,
    cast(-365+91*i+p_partkey%30 as int) as pay_days, round(p_retailprice*1e-3, 4) as amount
  from part cross join (values (0),(1),(2),(3),(4),(5),(6),(7)) t(i)),
future as (
  select underlier, pay_date, pay_days/365.25e0 as T, amount as alpha, 0e0 as beta,
    cast(underlier%25 as int) as curve_id
  from paid where pay_days > 0)"""

DISCOUNTED = f"""{RATES}, {DIVIDENDS},
discounted as (
  select underlier, T, alpha*exp(-T*zero) as pv
  from (select *, {rate_at("future.curve_id", "future.T")} as zero from future) f)"""


def forwards(source: str) -> str:
    return f"""
slices as (
  select s.*, p_retailprice as spot, exp(-s.T*s.r) as df,
    coalesce((select sum(pv) from discounted d where d.underlier = s.underlier and d.T <= s.T), 0e0)
      as pv_div
  from (select underlier, curve_id, T, {rate_at("q.curve_id", "q.T")} as r
        from (select distinct underlier, curve_id, T from {source}) q) s
  join part on p_partkey = s.underlier),
forwards as (select *, (spot-pv_div)/df as forward from slices)"""


ENRICHED = f"""{PRICED}, {DISCOUNTED}, {forwards("quotes")},
enriched as (
  select f.quote_id, f.underlier, f.T, f.strike, f.is_call, f.sigma_true, f.price, f.spread_frac,
    s.spot, s.r, s.df, s.pv_div, s.forward, ln(f.strike/s.forward) as k
  from flat f join forwards s on s.underlier = f.underlier and s.T = f.T)"""

SURFACES = f"""
surfaces as (
  select p_partkey as surface_id, -7e-1+1e-1*(p_partkey%7) as rho,
    (5e-1+1e-1*(p_partkey%5))*case when p_partkey%4 = 0 then 9e0 else 1e0 end as eta,
    2e-1+5e-2*(p_partkey%6) as gam, 3e-2+1e-2*(p_partkey%8) as nu
  from part)"""


def local_vol(source: str, keep: str) -> str:
    """CTE ``lv``: local vol and the reason where there is none."""
    return f"""
shaped as (
  select {keep}, {SURFACE_W} as w, {SLOPE_K} as w1, {CURVATURE_K} as w2, {SLOPE_T} as wt, k
  from {ssvi_terms(source)}),
ratio as (
  select *, 1e0-k/w*w1+25e-2*(-25e-2-1e0/w+k*k/(w*w))*w1*w1+5e-1*w2 as g from shaped),
lv as (
  select *, case when g <= 0e0 then 'butterfly' when wt < 0e0 then 'calendar'
                 when w < 1e-6 then 'tiny_variance' end as reason,
    case when g > 0e0 and wt >= 0e0 and w >= 1e-6 then sqrt(wt/g) end as local_vol
  from ratio)"""


def grid(T_grid, k_grid) -> str:
    return f"""
grid as (
  select s.*, a.T, b.k from surfaces s
  cross join (values {values(T_grid)}) a(T) cross join (values {values(k_grid)}) b(k))"""


# Sources and snapshot preparation

ORACLES["chain_scan"] = """
with text as (
  select l_partkey as underlier, (l_linenumber % 2 = 0) as is_call,
    cast(l_quantity as int) as qty, l_returnflag, l_linenumber from lineitem),
typed as (
  select underlier, is_call,
    try_cast(case when qty = 13 then 'n/a' else cast(qty*10 as varchar) end as double) as strike,
    try_cast(qty || 'e-2' as double) as T,
    case when l_returnflag in ('R', 'A') then 'american' else 'european' end as exercise,
    try_cast(case when qty%10 = 0 then '' when qty = 7 then 'nan' when qty = 9 then '0'
      else qty || 'e-1' end as double) as bid,
    try_cast(case when qty = 17 then '-1' else (qty+1) || 'e-1' end as double) as ask,
    case when qty = 23 then null else qty end as volume,
    case when qty = 29 then null else l_linenumber end as open_interest
  from text)
select * from typed
where strike is not null and T is not null and bid > 0 and not isnan(bid) and ask > 0
  and not isnan(ask) and volume is not null and open_interest is not null"""

ORACLES["chain_rejects"] = """
with text as (select (l_linenumber % 2 = 0) as side, cast(l_quantity as int) as qty from lineitem),
judged as (
  select side, case when qty = 13 then 'malformed_strike' when qty%10 = 0 or qty = 7 then 'malformed_bid'
    when qty = 23 then 'malformed_volume' when qty = 29 then 'malformed_openInterest'
    when qty in (9, 17) then 'one_sided' end as cause from text)
select side, cause, count(*) as rows from judged where cause is not null group by 1, 2"""

FOLDER = f"""
listed as (
  select 'S' || l_suppkey as underlier, (l_linenumber % 2 = 0) as is_call, trunc(l_quantity*7)/365e0 as T,
    case when l_returnflag = 'R' then 'american' else 'european' end as exercise,
    case when l_returnflag = 'R' then 'A' else 'e' end as written,
    trunc(l_extendedprice)+0e0 as strike, 1e0+l_discount as bid, 2e0+l_tax as ask,
    cast(l_quantity as int) as volume, cast(l_linenumber as int) as open_interest,
    cast(l_orderkey*8+l_linenumber as varchar) as row
  from lineitem where l_linenumber < 5)"""

ORACLES["market_folder"] = f"""
with {RATES}, {FOLDER},
paid as (select d/365.25e0 as T from (values (1), (92), (183), (274)) v(d)),
discounted as (select T, exp(-T*zero) as df from (select T, {rate_at("0", "paid.T")} as zero from paid) p),
slices as (
  select T, exp(-T*r) as df, coalesce((select sum(df) from discounted d where d.T <= t.T), 0e0) as coupons
  from (select T, {rate_at("0", "l.T")} as r from (select distinct T from listed) l) t),
enriched as (
  select l.*, 1e2+length(underlier) as spot, (1e0+length(underlier)/8e0)*coupons as pv_div, df
  from listed l join slices using (T))
select underlier, is_call, strike, {r("T", "T", 8)}, exercise, bid, ask, volume, open_interest, spot,
  {r("pv_div", "pv_div")}, {r("(spot-pv_div)/df", "forward", 5)}, 'ok' as status
from enriched"""

ORACLES["first_calls_in_file"] = f"""
with {FOLDER}
select underlier, row_number() over (partition by underlier
    order by T, strike, written, bid, ask, row) as rank,
  strike, {r("T", "T", 8)}, exercise, bid, ask, volume, open_interest
from listed where is_call qualify rank <= 5"""

ORACLES["curve_file_validate"] = """
with nodes as (
  select cast(o_custkey%97 as int) as curve_id, o_orderkey as seq,
    case when o_custkey%97%7 = 3 and o_orderkey%50 = 1 then null
      when o_custkey%97%5 = 2 and o_orderkey%20 = 3 then 1e-3 else o_orderkey/36e1 end as tenor
  from orders),
marked as (
  select *, lag(tenor ignore nulls) over (partition by curve_id order by seq) as before from nodes),
judged as (
  select curve_id, case when tenor is null or tenor <= before then 1 else 0 end as bad from marked)
select curve_id, cast(sum(bad) as bigint) as violations, count(*) as rows
from judged group by 1 having sum(bad) > 0"""

ORACLES["spot_latest"] = """
select underlier, "asof", spot from (
  select l_partkey as underlier, cast(l_shipdate as date) as "asof", l_extendedprice as spot,
    row_number() over (partition by l_partkey
      order by cast(l_shipdate as date) desc, l_extendedprice desc) as i
  from lineitem) t where i = 1"""

ORACLES["curve_validate"] = """
with nodes as (
  select l_orderkey as curve_id, l_linenumber as seq,
    case when l_linenumber <> 2 or l_orderkey%4 <> 0 then max(l_quantity) end as tenor
  from lineitem group by 1, 2),
marked as (
  select *, lag(tenor ignore nulls) over (partition by curve_id order by seq) as before from nodes),
judged as (
  select curve_id, case when tenor is null or tenor <= before then 1 else 0 end as bad from marked)
select curve_id, cast(sum(bad) as bigint) as violations, count(*) as rows
from judged group by 1 having sum(bad) > 0"""

ORACLES["dividends_future"] = f"""
with {DIVIDENDS}
select underlier, pay_date, {r("T", "T")}, alpha, beta from future"""

ORACLES["quotes_enriched"] = f"""
with {ENRICHED}
select quote_id,
  case when no_spot then 'no_spot' when no_curve then 'no_curve' else 'ok' end as status,
  case when not no_spot then spot end as spot,
  case when not no_curve then {rounded("r")} end as r,
  case when not no_curve then {rounded("df")} end as df,
  case when not no_curve then {rounded("pv_div", 5)} else 0e0 end as pv_div,
  case when not (no_spot or no_curve) then {rounded("forward", 5)} end as forward,
  {r("(price*(1e0-spread_frac)+price*(1e0+spread_frac))/2e0", "mid", 5)},
  case when not (no_spot or no_curve) then {rounded("k")} end as k
from (select *, underlier%17 = 0 as no_spot, underlier%{CURVES}%11 = 3 as no_curve from enriched) e"""

ORACLES["quotes_enriched_dates"] = f"""
with quotes as (
  select l_orderkey*8+l_linenumber as quote_id, row_number() over () as row, l_partkey as underlier, cast(l_partkey%25 as int) as curve_id,
    cast(l_shipdate as date) as day, l_linenumber*40/365e0 as T, l_extendedprice/l_quantity as strike
  from lineitem),
spots as (
  select p_partkey as underlier, cast(date '1992-03-01'+cast(i*90+p_partkey%30 as int) as date) as day,
    p_retailprice+i as spot
  from part cross join (select unnest(range(28)) as i)),
nodes as (
  select cast(n_nationkey as int) as curve_id, cast(date '1992-02-01'+cast(week*7 as int) as date) as day,
    tenor, rate+n_nationkey*1e-4+week%10*1e-3 as rate
  from nation cross join (select unnest(range(400)) as week) cross join (values {CURVE_NODES}) b(tenor, rate)
  where (week*7+n_nationkey)%5 <> 0),
days as (select distinct curve_id, day from nodes),
paid as (
  select p_partkey as underlier, cast(date '1992-01-10'+cast(i*91+p_partkey%30 as int) as date) as day,
    round(p_retailprice*1e-3, 4) as amount
  from part cross join (select unnest(range(36)) as i)),
dated as (
  select q.*, s.spot, s.day as spot_day, d.day as curve_day from quotes q
  asof left join spots s on s.underlier = q.underlier and s.day <= q.day
  asof left join days d on d.curve_id = q.curve_id and d.day <= q.day),
pieces as (
  select curve_id, day, lag(tenor) over w as lo, lag(rate) over w as r_lo, tenor as hi, rate as r_hi
  from nodes window w as (partition by curve_id, day order by tenor)
  union all
  select curve_id, day, max(tenor), arg_max(rate, tenor), null, null from nodes group by 1, 2),
cash as (
  select row, q.curve_id, curve_day, date_diff('day', q.day, p.day)/365.25e0 as T, amount
  from dated q join paid p on p.underlier = q.underlier and p.day > q.day
    and date_diff('day', q.day, p.day)/365.25e0 <= q.T),
rated as (
  select x.*, case when p.lo is null then r_hi when p.hi is null then r_lo
    else r_lo+(x.T-lo)*(r_hi-r_lo)/(hi-lo) end as r
  from (select row, curve_id, curve_day, T, null as amount from dated
        union all select * from cash) x
  left join pieces p on p.curve_id = x.curve_id and p.day = x.curve_day
    and (p.lo is null or x.T > p.lo) and (p.hi is null or x.T <= p.hi)),
values_ as (select row, sum(amount*exp(-r*T)) as pv from rated where amount is not null group by 1),
found as (
  select d.*, r.r, coalesce(v.pv, 0e0) as pv_div, (d.spot-coalesce(v.pv, 0e0))/exp(-r.r*d.T) as forward
  from dated d join rated r on r.row = d.row and r.amount is null
  left join values_ v on v.row = d.row)
select quote_id, case when spot is null then 'no_spot' when r is null then 'no_curve' else 'ok' end as status,
  spot, spot_day as spot_asof, curve_day as curve_asof, {r("r", "r", 8)}, {r("pv_div", "pv_div", 5)},
  {r("forward", "forward", 4)}, {r("ln(strike/forward)", "k")}
from found"""

ORACLES["chain_normalise"] = f"""
with {CHAIN}
select quote_id, cast({ASOF}+(days*2-30) as date) as expiration,
  round((days*2-30)/365e0, 6) as T, days*2-30 as "daysToExpiry",
  case when is_call then 'call' else 'put' end as type, 'american' as "exerciseType",
  {r("strike", "strike", 5)}, qty/8e0 as bid, qty/4e0 as ask, volume-5 as volume,
  open_interest as "openInterest"
from chain
where days*2-30 between 7 and 365 and qty%10 <> 0 and volume-5 > 0 and qty%9 <> 0
  and qty/8e0 > 5e-2"""

ORACLES["chain_union"] = f"""
with {QUOTES}
select quote_id, underlier, case when is_call then volume end as volume,
  case when not is_call then open_interest end as open_interest
from quotes"""

ORACLES["dividend_lookback"] = f"""
with {DIVIDENDS}
select underlier, pay_date, amount from paid
where date_diff('day', pay_date, date '1996-12-01') <= 730"""

_HISTORY = ", ".join(
    f"case when o_orderkey%11 <> {i} then base+1e-2*{i} end as {name}"
    for i, name in enumerate(HISTORY_TENORS)
)
_NODES = " union all ".join(
    f'select curve_id, "asof", '
    f" {r(number(t), 'tenor')}, round({name}/1e2, 6) as rate "
    f"from latest where i = 1"
    for name, t in HISTORY_TENORS.items()
)
ORACLES["curve_snapshot"] = f"""
with history as (
  select o_custkey as curve_id, cast(o_orderdate as date) as "asof", {_HISTORY}
  from (select *, sqrt(o_totalprice)/1e2 as base from orders) o),
latest as (
  select *, row_number() over (partition by curve_id order by "asof" desc, m1 desc) as i
  from history where {" and ".join(f"{c} is not null" for c in HISTORY_TENORS)})
{_NODES}"""

# Scalar columns

ORACLES["year_fraction"] = f"""
select l_orderkey, l_linenumber,
  {r("date_diff('day', date '1998-06-15', cast(l_shipdate as date))/365.25e0", "years")},
  {r("date_diff('day', date '1998-06-15', cast(l_shipdate as date))/365e0", "years_365")}
from lineitem"""

ORACLES["quote_mid"] = f"""
with {PRICED}
select quote_id, {r("price*(1e0-spread_frac)", "bid", 5)}, {r("price*(1e0+spread_frac)", "ask", 5)},
  {r("(price*(1e0-spread_frac)+price*(1e0+spread_frac))/2e0", "mid", 5)}
from flat"""

ORACLES["log_moneyness"] = f"""
with {CHAIN}
select quote_id, case when qty <> 50 then round(ln(strike/(spot*exp(3e-2*T))), 6) + 0e0 end as k
from chain"""

ORACLES["normal_cdf"] = f"""
select l_orderkey, l_linenumber, {r(cdf("x"), "cdf", 9)}, {r(pdf("x"), "pdf", 9)}
from (select *, (l_quantity-25.5e0)/3e0+l_discount as x from lineitem) t"""

ORACLES["bs_d1_d2"] = f"""
with {PRICED} select quote_id, {r("d1", "d1")}, {r("d2", "d2")} from leveled"""

ORACLES["bs_price"] = f"""
with {PRICED} select quote_id, {r("price", "price", 5)} from flat"""

ORACLES["bs_price_column"] = ORACLES["bs_price"]

FORWARD = f"""{CHAIN},
carried as (
  select *, spot*exp(1e-2*T) as forward, exp(-3e-2*T) as df, sigma_true*sqrt(T) as sd from chain),
placed as (
  select *, ln(forward/strike)/sd+5e-1*sd as d1, ln(forward/strike)/sd-5e-1*sd as d2 from carried)"""

ORACLES["black_price"] = f"""
with {FORWARD}
select quote_id, {r(f'''df*case when is_call
    then forward*{cdf("d1")}-strike*{cdf("d2")}
    else strike*{cdf("-d2")}-forward*{cdf("-d1")} end''', "price", 5)}
from placed"""

ORACLES["black_vega"] = f"""
with {FORWARD}
select quote_id, {r(f'df*forward*sqrt(T)*{pdf("d1")}', "vega", 5)},
  {r(f'spot*sqrt(T)*{pdf("(ln(spot/strike)+3e-2*T)/sd+5e-1*sd")}', "spot_vega", 5)}
from placed"""

_GREEK_LEVELS = f"""{CHAIN},
based as (
  select *, exp(-1e-2*T) as dq, exp(-3e-2*T) as dr, sqrt(T) as rt,
    (ln(spot/strike)+(2e-2+5e-1*sigma_true*sigma_true)*T)/(sigma_true*sqrt(T)) as d1
  from chain),
levels as (
  select *, d1-sigma_true*rt as d2, {pdf("d1")} as n1, case when is_call then 1e0 else -1e0 end as e
  from based),
probabilities as (select *, {cdf("(e*d1)")} as p1, {cdf("(e*d2)")} as p2 from levels)"""
ORACLES["bs_greeks"] = f"""
with {_GREEK_LEVELS}
select quote_id, {r("e*dq*p1", "delta", 5)}, {r("dq*n1/(spot*sigma_true*rt)", "gamma", 5)},
  {r("spot*dq*rt*n1", "vega", 5)},
  {r("-spot*dq*n1*sigma_true/(2e0*rt)-e*3e-2*strike*dr*p2+e*1e-2*spot*dq*p1", "theta", 5)},
  {r("e*strike*T*dr*p2", "rho", 5)}, {r("-dq*n1*d2/sigma_true", "vanna", 5)},
  {r("spot*dq*rt*n1*d1*d2/sigma_true", "volga", 5)}
from probabilities"""

ORACLES["ssvi_iv"] = f"""
with {QUOTES}, {SURFACED}
select quote_id, {r("th", "theta")}, {r("ph", "phi")}, {r("w", "w", 8)}, {r("iv", "iv", 8)}
from surfaced"""

ORACLES["ssvi_derivs"] = f"""
with {QUOTES}
select quote_id, {r(SURFACE_W, "w")}, {r(SLOPE_K, "dw_dk")}, {r(CURVATURE_K, "d2w_dk2")},
  {r(SLOPE_T, "dw_dt")}
from {ssvi_terms("quotes")}"""

ORACLES["ssvi_arb_free"] = f"""
with {SURFACES}
select surface_id, (abs(rho) < 1 and eta*(1e0+abs(rho)) <= 4e0 and gam > 0 and gam <= 5e-1)
  as arb_free
from surfaces"""

ORACLES["dupire_local_vol"] = f"""
with {QUOTES},
stretched as (
  select * replace (eta*case when underlier%4 = 0 then 9e0 else 1e0 end as eta) from quotes),
{local_vol("stretched", "quote_id")}
select quote_id, {r("local_vol", "local_vol")}, reason from lv"""

# Filters, limits, counts

ORACLES["two_sided"] = f"""
with {QUOTES}
select quote_id, qty/8e0 as bid, qty/4e0 as ask from quotes
where qty%10 not in (0, 1) and qty%7 <> 0"""

ORACLES["exercise_split"] = f"""
with {QUOTES}
select quote_id, case when exercise = 'american' then 'a' else 'e' end as style from quotes"""

ORACLES["top_calls"] = f"""
with {QUOTES}
select underlier, cast(i as int) as rank, quote_id from (
  select *, row_number() over (partition by underlier order by days, qty) as i
  from quotes where is_call) t
where i <= 5"""

ORACLES["first_calls"] = f"""
with {QUOTES}
select quote_id, underlier, days, qty from quotes where is_call
order by underlier, days, qty limit 5"""

ORACLES["chain_summary"] = f"""
with {QUOTES}
select underlier, is_call, count(*) as quotes, cast(sum(volume) as bigint) as volume,
  cast(sum(open_interest) as bigint) as open_interest
from quotes group by 1, 2"""

ORACLES["future_dividend_counts"] = f"""
with {DIVIDENDS} select underlier, count(*) as dividends from future group by 1"""

# Curve and dividend lookups

LONG_DATED = f"""{QUOTES},
dated as (
  select quote_id, curve_id, case when days%10 = 0 then 25e-2 when days%10 = 1 then 31e0
    else days*days/3650e0 end as T
  from quotes),
{RATES},
looked_up as (select *, {rate_at("dated.curve_id", "dated.T")} as rate from dated)"""

ORACLES["zero_rate"] = f"""
with {LONG_DATED} select quote_id, {r("rate", "rate", 8)} from looked_up"""

ORACLES["discount_factor"] = f"""
with {LONG_DATED} select quote_id, {r("exp(-rate*T)", "df", 8)} from looked_up"""

ORACLES["forward_rate"] = f"""
with {QUOTES}, {RATES},
spans as (
  select quote_id, curve_id, days/365e0 as a, days/365e0+(qty-1)/1e1 as b from quotes),
ends as (
  select *, {rate_at("spans.curve_id", "spans.a")} as ra, {rate_at("spans.curve_id", "spans.b")} as rb
  from spans)
select quote_id, case when a <> b then round((rb*b-ra*a)/(b-a), 7) + 0e0 end as forward_rate
from ends"""

ORACLES["pv_dividends"] = f"""
with {QUOTES}, {DISCOUNTED}
select q.underlier, {r("q.T", "T", 8)}, {r("coalesce(sum(pv), 0e0)", "pv_div")}
from (select distinct underlier, T from quotes) q
left join discounted d on d.underlier = q.underlier and d.T > 125e-3 and d.T <= q.T
group by q.underlier, q.T"""

ORACLES["forward_price"] = f"""
with {QUOTES}, {DISCOUNTED}, {forwards("quotes")}
select underlier, {r("T", "T", 8)}, {r("df", "df", 8)}, {r("forward", "forward", 5)} from forwards"""

ORACLES["dividends_in_interval"] = f"""
with {DIVIDENDS}
select underlier, pay_date, alpha, beta from future
where T > underlier%3*25e-2 and T <= underlier%3*25e-2+5e-1"""

# Call/put parity

PARITY = f"""{FORWARD},
sides as (
  select underlier, qty, days, strike, forward, df,
    df*(forward*{cdf("d1")}-strike*{cdf("d2")})+spread_frac as call_price,
    df*(strike*{cdf("-d2")}-forward*{cdf("-d1")})-spread_frac as put_price
  from placed),
pairs as (
  select c.underlier, c.qty, c.days,
    c.call_price-p.put_price-c.df*(c.forward-c.strike) as residual
  from sides c join sides p on p.underlier = c.underlier and p.qty = c.qty and p.days = c.days),
strikes as (
  select underlier, qty, days, count(*) as pairs, min(residual) as residual_lo,
    max(residual) as residual_hi, max(abs(residual)) as worst
  from pairs group by 1, 2, 3)"""

ORACLES["parity_by_strike"] = f"""
with {PARITY}
select underlier, qty, days, pairs, {r("residual_lo", "residual_lo")},
  {r("residual_hi", "residual_hi")}, {r("worst", "worst")}
from strikes"""

ORACLES["parity_residual"] = f"""
with {PARITY}
select underlier, count(*) as strikes, cast(sum(pairs) as bigint) as pairs,
  {r("max(worst)", "max_residual")}
from strikes group by underlier"""

ORACLES["parity_column"] = f"""
with {QUOTES} select quote_id, true as holds from quotes"""

# Grids

ORACLES["ssvi_grid"] = f"""
with {SURFACES}, {grid(T_GRID, K_GRID)}
select surface_id, T, k, {r(f"sqrt({SURFACE_W}/T)", "iv", 8)} from {ssvi_terms("grid")}"""

ORACLES["local_vol_grid"] = f"""
with {SURFACES}, {grid(T_GRID, K_GRID)}, {local_vol("grid", "surface_id, T")}
select surface_id, T, k, {r("local_vol", "local_vol")}, reason from lv"""

ORACLES["surface_arbitrage"] = f"""
with {SURFACES}, {grid(WIDE_T_GRID, WIDE_K_GRID)}, {local_vol("grid", "surface_id, T")}
select surface_id, count(*) as points, count(*) filter (reason = 'butterfly') as butterfly,
  count(*) filter (reason = 'calendar') as calendar,
  count(*) filter (reason = 'tiny_variance') as tiny_variance
from lv group by 1"""

ORACLES["spot_ladder"] = f"""
with {CHAIN},
ladder as (
  select quote_id as contract_id, cast(i as int) as step, strike, T, sigma_true*sqrt(T) as sd,
    is_call, strike*exp(-5e-1+i*125e-3) as s
  from chain cross join range(9) t(i)),
placed as (
  select *, (ln(s/strike)+3e-2*T)/sd+5e-1*sd as d1, (ln(s/strike)+3e-2*T)/sd-5e-1*sd as d2
  from ladder)
select contract_id, step, {r("s", "scenario_spot", 5)}, {r(f'''case when is_call
    then s*exp(-2e-2*T)*{cdf("d1")}-strike*exp(-5e-2*T)*{cdf("d2")}
    else strike*exp(-5e-2*T)*{cdf("-d2")}-s*exp(-2e-2*T)*{cdf("-d1")} end''', "price", 5)}
from placed"""

# Calibration

_SCORED = """
  select q.underlier as surface_id, q.T, q.k, q.iv as quoted, {weight} as weight, {param_id} as param_id,
    s.rho, s.eta, s.gam, s.nu+{shift} as nu
  from surfaced q join surfaces s on s.surface_id = q.underlier {extra}"""
_SSE = (
    "case when bool_and(abs(rho) < 1 and eta*(1e0+abs(rho)) <= 4e0 and gam > 0 and gam <= 5e-1) "
    f"then sum(weight*pow(sqrt({SURFACE_W}/T)-quoted, 2)) else 1e6 end"
)


def _sse(digits: int, **parts: str) -> str:
    return f"""
with {QUOTES}, {SURFACED}, {SURFACES}, scored as ({_SCORED.format(**parts)})
select surface_id, cast(param_id as int) as param_id, {r(_SSE, "sse", digits)}
from {ssvi_terms("scored")} group by surface_id, param_id"""


ORACLES["ssvi_sse"] = _sse(
    8, weight="1e0", param_id="i", shift="i*1e-2", extra="cross join range(3) t(i)"
)
ORACLES["ssvi_sse_weighted"] = _sse(
    6, weight="1e0/(q.spread_frac+1e-2)", param_id="0", shift="2e-2", extra=""
)

_CANDIDATES = ", ".join(
    f"({i}, {', '.join(number(v) for v in c)})" for i, c in enumerate(CANDIDATES)
)
ORACLES["ssvi_grid_fit"] = f"""
with {QUOTES}, {SURFACED},
candidates(param_id, rho, eta, gam, nu) as (values {_CANDIDATES}),
scored as (
  select q.underlier as surface_id, q.T, q.k, q.iv as quoted, 1e0 as weight, c.*
  from surfaced q cross join candidates c),
scores as (
  select surface_id, param_id, {_SSE} as sse
  from {ssvi_terms("scored")} group by surface_id, param_id),
best as (
  select *, row_number() over (partition by surface_id order by sse, param_id) as i from scores)
select surface_id, c.rho, c.eta, c.gam, c.nu, {r("sse", "sse", 8)},
  cast(b.param_id as int) as param_id
from best b join candidates c on c.param_id = b.param_id where i = 1"""

_TRUE_PARAMS = ", ".join(
    f"case when n >= 4 then round({p}, 4) + 0e0 end as {p}" for p in ("rho", "eta", "gam", "nu")
)
ORACLES["ssvi_calibrate"] = f"""
with {QUOTES}
select underlier as surface_id, {_TRUE_PARAMS},
  case when n >= 4 then 'ok' else 'invalid_input' end as status
from (select underlier, rho, eta, gam, nu, count(*) as n from quotes group by 1, 2, 3, 4, 5) t"""
ORACLES["ssvi_calibrate_distributed"] = ORACLES["ssvi_calibrate"]

_BOUND = ", ".join(
    f"({i}, {', '.join(number(v) for v in c)})" for i, c in enumerate(BOUND_CANDIDATES)
)
ORACLES["ssvi_calibrate_bound"] = f"""
with {QUOTES.replace("5e-1+1e-1*(underlier%5)", "6e0*(5e-1+1e-1*(underlier%5))")}, {SURFACED},
candidates(param_id, rho, eta, gam, nu) as (values {_BOUND}),
scored as (
  select q.underlier as surface_id, q.T, q.k, q.iv as quoted, 1e0 as weight, c.*
  from surfaced q cross join candidates c),
scores as (
  select surface_id, param_id, {_SSE} as sse, count(*) as n
  from {ssvi_terms("scored")} group by surface_id, param_id)
select surface_id, case when max(n) >= 4 then 'ok' else 'invalid_input' end as status,
  {r("min(sse)", "best_candidate", 7)}, case when max(n) >= 4 then true end as as_good,
  case when max(n) >= 4 then true end as within_limit
from scores group by surface_id"""

# Implied vol

LIQUID = "abs(k) <= sigma_true*sqrt(T)*2e0"

ORACLES["implied_vol"] = f"""
with {CHAIN}
select quote_id, case qty when 50 then 'no_arbitrage_violation' when 49 then 'invalid_input'
    else 'ok' end as status,
  case when qty < 49 and {LIQUID} then sigma_true + 0e0 end as sigma,
  case when qty < 49 then true end as reprices
from chain"""

ORACLES["implied_vol_fwd"] = f"""
with {ENRICHED}
select quote_id, 'ok' as status, case when {LIQUID} then sigma_true + 0e0 end as sigma, true as reprices
from enriched"""

ORACLES["chain_to_local_vol"] = f"""
with {ENRICHED},
placed as (
  select e.underlier, e.T, e.k, q.rho, q.eta, q.gam, q.nu
  from enriched e join quotes q on q.quote_id = e.quote_id),
modelled as (
  select underlier, T, k, rho, eta, gam, nu, sqrt(({SURFACE_W})/T) as iv from {ssvi_terms("placed")}),
surfaces as (
  select underlier as surface_id, any_value(rho) as rho, any_value(eta) as eta, any_value(gam) as gam,
    any_value(nu) as nu
  from modelled where abs(k) <= iv*sqrt(T) group by 1 having count(*) >= {MANY}),
{grid([0.25, 0.5, 1.0], [-0.1, 0.0, 0.1])}, {local_vol("grid", "surface_id, T")}
select surface_id, T, k, {r("local_vol", "local_vol", 3)}, reason from lv"""

_FOUR = ", ".join(f"case when count(*) >= 4 then any_value({p}) end as {p}" for p in ("rho", "eta", "gam", "nu"))
ORACLES["chain_to_local_vol_all"] = f"""
with {ENRICHED},
surfaces as (
  select e.underlier as surface_id, {_FOUR},
    case when count(*) >= 4 then 'ok' else 'invalid_input' end as status
  from enriched e join quotes q on q.quote_id = e.quote_id group by 1),
{grid([0.25, 0.5, 1.0], [-0.1, 0.0, 0.1])}, {local_vol("grid", "surface_id, status, T")}
select surface_id, status, T, k, {r("local_vol", "local_vol", 3)}, reason from lv"""

_NEAR = "abs(k) <= sigma_true*sqrt(T)*5e-1"
ORACLES["call_vol_report"] = f"""
with {ENRICHED},
ranked as (
  select e.*, sigma_true*sqrt(T) as sd,
    row_number() over (partition by underlier order by T, strike) as i
  from enriched e where is_call),
levels as (select *, -k/sd+5e-1*sd as d1, -k/sd-5e-1*sd as d2 from ranked)
select underlier, cast(i as int) as rank, {r("strike", "strike", 5)}, {r("T", "T")},
  {r(f'df*(forward*{cdf("d1")}-strike*{cdf("d2")})', "mid", 5)}, {r("k", "k")},
  case when {_NEAR} then sigma_true + 0e0 end as sigma, true as reprices
from levels where i <= 5"""

ORACLES["implied_vol_newton"] = f"""
with {CHAIN}
select quote_id, 'ok' as status,
  case when {LIQUID} then sigma_true + 0e0 end as sigma, true as reprices
from chain"""
