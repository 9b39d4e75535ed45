"""Dupire local volatility of an SSVI surface."""

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame

from .backend import INLINE, Sql, Staged, sql
from .ssvi import curvature_in_k, guarded_smile, slope_in_k, slope_in_T

# Fixed value: total variance below this is too small to divide by.
TINY_VARIANCE = 1e-6


def dupire_terms(s, m=INLINE):
    """Numerator dw/dT and denominator g of the local variance, with the total variance."""
    w, dk = m.let(s.w, slope_in_k(s))
    ratio = s.k / w
    g, slope = m.let(
        1.0
        - ratio * dk
        + 0.25 * (ratio * ratio - 1.0 / w - 0.25) * dk * dk
        + 0.5 * curvature_in_k(s),
        slope_in_T(s),
    )
    return SimpleNamespace(g=g, dw_dT=slope, w=w)


def _local_vol(k, T, rho, eta, gam, nu, m):
    t = dupire_terms(guarded_smile(k, T, rho, eta, gam, nu, m), m)
    reason = Sql(
        f"(case when {t.g} <= 0 then 'butterfly' when {t.dw_dT} < 0 then 'calendar' "
        f"when {t.w} < {sql(TINY_VARIANCE)} then 'tiny_variance' end)"
    )
    (reason,) = m.let(reason)
    value = Sql(f"(case when {reason} is null then {m.sqrt(t.dw_dT / t.g)} end)")
    return value, reason


def local_vol(k="k", T="T", rho="rho", eta="eta", gam="gam", nu="nu") -> Column:
    """Local vol; NULL where the surface admits none."""
    return _local_vol(k, T, rho, eta, gam, nu, INLINE)[0].column


def with_local_vol(
    frame: DataFrame, k="k", T="T", rho="rho", eta="eta", gam="gam", nu="nu"
) -> DataFrame:
    """Add ``local_vol`` and ``reason``: NULL vol with reason butterfly, calendar or
    tiny_variance."""
    m = Staged(frame)
    value, reason = _local_vol(k, T, rho, eta, gam, nu, m)
    return m.done(local_vol=value, reason=reason)
