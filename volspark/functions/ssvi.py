"""SSVI total-variance surface (Gatheral and Jacquier 2014, power-law phi) and its derivatives.

Parameters are columns ``rho, eta, gam, nu``: theta = nu T and
phi = eta / (theta^gam (1 + theta)^(1 - gam)). ``smile`` computes the shared terms once and the
derivatives follow from them.
"""

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame

from .backend import INLINE, Staged, positive, sql

PARAMS = ("rho", "eta", "gam", "nu")

# Calibration box, start, and the largest eta (1 + |rho|) free of butterfly arbitrage.
LOWER_BOUNDS = (-0.99, 0.01, 0.01, 0.001)
UPPER_BOUNDS = (0.99, 5.0, 0.5, 1.0)
START = (-0.5, 1.0, 0.3, 0.04)
WING_LIMIT = 4.0
GAMMA_LIMIT = 0.5


def smile(k, T, rho, eta, gam, nu, m=INLINE):
    """Total variance ``w`` at (k, T) with the terms every derivative shares."""
    (theta,) = m.let(nu * T)
    # theta^gam (1 + theta)^(1 - gam) with one logarithm, which the Jacobian needs as well.
    (decay,) = m.let(m.log(theta / (1.0 + theta)))
    (phi,) = m.let(eta / ((1.0 + theta) * m.exp(gam * decay)))
    skew = phi * k
    shifted = skew + rho
    slack = 1.0 - rho * rho
    (root,) = m.let(m.sqrt(shifted * shifted + slack))
    level = 1.0 + rho * skew + root
    return SimpleNamespace(
        k=k, T=T, rho=rho, eta=eta, gam=gam, nu=nu, theta=theta, decay=decay, phi=phi, skew=skew,
        shifted=shifted, slack=slack, root=root, level=level, w=0.5 * theta * level,
    )


def slope_in_phi(s):
    """dw/dphi at fixed theta."""
    return 0.5 * s.theta * s.k * (s.rho + s.shifted / s.root)


def slope_in_k(s):
    return 0.5 * s.theta * s.phi * (s.rho + s.shifted / s.root)


def curvature_in_k(s):
    return 0.5 * s.theta * s.phi * s.phi * s.slack / (s.root * s.root * s.root)


def slope_in_theta(s):
    """dw/dtheta, through theta itself and through phi(theta)."""
    dlog_phi = s.gam / s.theta + (1.0 - s.gam) / (1.0 + s.theta)
    return 0.5 * s.level - slope_in_phi(s) * s.phi * dlog_phi


def slope_in_T(s):
    return s.nu * slope_in_theta(s)


def vol(s, m=INLINE):
    return m.sqrt(s.w / s.T)


def vol_at(unit, k, rho, eta, nu, m=INLINE):
    """``vol`` from ``unit``, the phi of eta = 1, which sets of the same gam and nu share."""
    skew = eta * unit * k
    shifted = skew + rho
    return m.sqrt(0.5 * nu * (1.0 + rho * skew + m.sqrt(shifted * shifted + (1.0 - rho * rho))))


def vol_jacobian(s, m=INLINE):
    """(iv, d iv / d rho, d eta, d gam, d nu) from the chain rule on w."""
    iv, through_phi = m.let(vol(s, m), slope_in_phi(s) * s.phi)
    (scale,) = m.let(0.5 / (iv * s.T))
    return m.let(
        iv,
        scale * 0.5 * s.theta * (s.skew + s.skew / s.root),
        scale * through_phi / s.eta,
        -(scale * through_phi * s.decay),
        scale * s.T * slope_in_theta(s),
    )


def guarded_smile(k, T, rho, eta, gam, nu, m=INLINE):
    """Smile of columns; every term is NULL unless T and nu are positive."""
    T, nu = m.let(positive(T), positive(nu))
    return smile(sql(k), T, sql(rho), sql(eta), sql(gam), nu, m)


def ssvi_theta(T="T", nu="nu") -> Column:
    return (sql(nu) * positive(T)).column


def ssvi_phi(T="T", eta="eta", gam="gam", nu="nu") -> Column:
    return guarded_smile("0D", T, "0D", eta, gam, nu).phi.column


def ssvi_w(k="k", T="T", rho="rho", eta="eta", gam="gam", nu="nu") -> Column:
    """Total variance; NULL when T <= 0."""
    return guarded_smile(k, T, rho, eta, gam, nu).w.column


def ssvi_iv(k="k", T="T", rho="rho", eta="eta", gam="gam", nu="nu") -> Column:
    """Implied vol sqrt(w/T); NULL when T <= 0."""
    return vol(guarded_smile(k, T, rho, eta, gam, nu)).column


def with_ssvi_iv(
    frame: DataFrame, name: str = "iv", k="k", T="T", rho="rho", eta="eta", gam="gam", nu="nu"
) -> DataFrame:
    """Add ``name``: implied vol."""
    m = Staged(frame)
    iv = vol(guarded_smile(k, T, rho, eta, gam, nu, m))
    return m.done(**{name: iv})


def with_ssvi_terms(
    frame: DataFrame, k="k", T="T", rho="rho", eta="eta", gam="gam", nu="nu"
) -> DataFrame:
    """Add theta, phi, w, iv and the derivatives dw_dk, d2w_dk2, dw_dt."""
    m = Staged(frame)
    s = guarded_smile(k, T, rho, eta, gam, nu, m)
    return m.done(
        theta=s.theta, phi=s.phi, w=s.w, iv=vol(s), dw_dk=slope_in_k(s),
        d2w_dk2=curvature_in_k(s), dw_dt=slope_in_T(s),
    )


def ssvi_derivs(k="k", T="T", rho="rho", eta="eta", gam="gam", nu="nu") -> Column:
    """Struct of w and its analytic derivatives dw_dk, d2w_dk2, dw_dt."""
    s = guarded_smile(k, T, rho, eta, gam, nu)
    return sql(
        f"named_struct('w', {s.w}, 'dw_dk', {slope_in_k(s)}, "
        f"'d2w_dk2', {curvature_in_k(s)}, 'dw_dt', {slope_in_T(s)})"
    ).column


def arb_free(rho, eta, gam, m=INLINE):
    size = m.abs(rho)
    return (
        (size < 1.0)
        & (eta * (1.0 + size) <= WING_LIMIT)
        & (gam > 0.0)
        & (gam <= GAMMA_LIMIT)
    )


def ssvi_arb_free(rho="rho", eta="eta", gam="gam") -> Column:
    """Sufficient parameter condition; nu is not part of it."""
    return arb_free(sql(rho), sql(eta), sql(gam)).column
