"""Standard normal CDF and inverse CDF on numpy arrays, for Arrow-batched tasks.

Both are published rational approximations.
"""

from __future__ import annotations

import math

import numpy as np

# Abramowitz & Stegun (1964), formula 26.2.17, |error| < 7.5e-8.
AS_P = 0.2316419
AS_B = [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]

# P. J. Acklam's rational approximation of the inverse normal
# CDF (relative error < 1.15e-9), coefficients a1..a6, b1..b5, c1..c6, d1..d4.
AC_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
        1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
AC_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
        6.680131188771972e+01, -1.328068155288572e+01]
AC_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
        -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
AC_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
        3.754408661907416e+00]
AC_P_LOW = 0.02425


def np_norm_cdf(z):
    az = np.abs(z)
    t = 1.0 / (1.0 + AS_P * az)
    poly = np.zeros_like(t)
    for b in reversed(AS_B):
        poly = poly * t + b
    poly = poly * t
    upper = 1.0 - np.exp(-az * az / 2.0) / math.sqrt(2 * math.pi) * poly
    return np.where(z >= 0, upper, 1.0 - upper)


def np_norm_ppf(p):
    p = np.asarray(p, dtype=float)

    def horner(coefs, x):
        acc = np.full_like(x, coefs[0])
        for c in coefs[1:]:
            acc = acc * x + c
        return acc

    out = np.empty_like(p)
    lo = p < AC_P_LOW
    hi = p > 1 - AC_P_LOW
    mid = ~(lo | hi)
    q = np.sqrt(-2.0 * np.log(p[lo]))
    out[lo] = horner(AC_C, q) / (horner(AC_D, q) * q + 1.0)
    q = np.sqrt(-2.0 * np.log(1.0 - p[hi]))
    out[hi] = -horner(AC_C, q) / (horner(AC_D, q) * q + 1.0)
    q = p[mid] - 0.5
    r = q * q
    out[mid] = horner(AC_A, r) * q / (horner(AC_B, r) * r + 1.0)
    return out
