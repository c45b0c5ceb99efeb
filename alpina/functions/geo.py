"""Projection and grid functions as column expressions (P4, P5, P6, pixel index).

All arithmetic uses ``*`` chains in a fixed order so that Spark and an SQL
oracle produce the same doubles bit for bit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the published approximate WGS84 -> LV95
# (EPSG:2056) formula, arguments in units of 10000 arc-seconds.
LV95_LON_SHIFT_SEC = 26782.5
LV95_LAT_SHIFT_SEC = 169028.66
LV95_E0 = 2600072.37
LV95_E_LON = 211455.93
LV95_E_LON_LAT = 10938.51
LV95_E_LON_LAT2 = 0.36
LV95_E_LON3 = 44.54
LV95_N0 = 1200147.07
LV95_N_LAT = 308807.95
LV95_N_LON2 = 3745.25
LV95_N_LAT2 = 76.63
LV95_N_LON2_LAT = 194.56
LV95_N_LAT3 = 119.79

# Rigorous Swiss projection parameters (Bessel 1841 ellipsoid,
# Bern origin, CH1903+ -> WGS84 shift in metres) and the WGS84 ellipsoid.
BESSEL_A = 6377397.155
BESSEL_E2 = 0.006674372230614
ORIGIN_LAT_DEG = 46.0 + 57.0 / 60 + 8.66 / 3600
ORIGIN_LON_DEG = 7.0 + 26.0 / 60 + 22.50 / 3600
SHIFT_DX, SHIFT_DY, SHIFT_DZ = 674.374, 15.056, 405.346
WGS84_A = 6378137.0
WGS84_E2 = 0.00669438002290


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(v: float) -> Column:
    return F.lit(float(v))


def wgs84_to_lv95(lon, lat) -> tuple[Column, Column]:
    """(E, N) in metres from degrees; null in, null out."""
    lo = (_c(lon) * _d(3600.0) - _d(LV95_LON_SHIFT_SEC)) / _d(10000.0)
    la = (_c(lat) * _d(3600.0) - _d(LV95_LAT_SHIFT_SEC)) / _d(10000.0)
    e = (_d(LV95_E0) + _d(LV95_E_LON) * lo - _d(LV95_E_LON_LAT) * lo * la
         - _d(LV95_E_LON_LAT2) * lo * (la * la) - _d(LV95_E_LON3) * (lo * lo * lo))
    n = (_d(LV95_N0) + _d(LV95_N_LAT) * la + _d(LV95_N_LON2) * (lo * lo)
         + _d(LV95_N_LAT2) * (la * la) - _d(LV95_N_LON2_LAT) * (lo * lo) * la
         + _d(LV95_N_LAT3) * (la * la * la))
    return e, n


def floor_div(x, d: float) -> Column:
    """``floor(x / d)`` as a long (null when not finite)."""
    return F.floor(_c(x) / _d(d)).try_cast("long")


def tile_key(e, n, size: float = 1000.0) -> Column:
    """``"<E//1000>-<N//1000>"``; null when a coordinate is null or not finite."""
    e, n = _c(e), _c(n)
    ok = e.isNotNull() & n.isNotNull() & ~F.isnan(e) & ~F.isnan(n) \
        & (F.abs(e) < F.lit(1e15)) & (F.abs(n) < F.lit(1e15))
    return F.when(ok, F.concat_ws("-", floor_div(e, size).cast("string"),
                                  floor_div(n, size).cast("string")))


def pixel_index(v, origin, step) -> Column:
    """``int((v - origin) / step)``: truncation toward zero, null when not finite."""
    q = (_c(v) - _c(origin)) / _c(step)
    return F.when(q.isNotNull() & ~F.isnan(q) & (F.abs(q) < F.lit(2.0e9)), q.try_cast("int"))


# --- LV95 -> WGS84, rigorous closed form -------------------------------------

def _bern_constants():
    phi0 = math.radians(ORIGIN_LAT_DEG)
    e = math.sqrt(BESSEL_E2)
    alpha = math.sqrt(1 + BESSEL_E2 / (1 - BESSEL_E2) * math.cos(phi0) ** 4)
    b0 = math.asin(math.sin(phi0) / alpha)
    k = (math.log(math.tan(math.pi / 4 + b0 / 2))
         - alpha * math.log(math.tan(math.pi / 4 + phi0 / 2))
         + alpha * e / 2 * math.log((1 + e * math.sin(phi0)) / (1 - e * math.sin(phi0))))
    r = BESSEL_A * math.sqrt(1 - BESSEL_E2) / (1 - BESSEL_E2 * math.sin(phi0) ** 2)
    return dict(phi0=phi0, e=e, alpha=alpha, b0=b0, k=k, r=r, lam0=math.radians(ORIGIN_LON_DEG))


BERN = _bern_constants()


def with_wgs84(df, e: str, n: str, lon_out: str = "lon_wgs84", lat_out: str = "lat_wgs84",
               iterations: int = 6):
    """P5: add WGS84 (lon, lat) degrees computed from LV95 metres.

    Inverse oblique-conformal projection onto the Bessel ellipsoid, geocentric
    shift to WGS84 and iterative geodetic latitude - all column arithmetic.
    Each iteration is a named column: the latitude refers to itself several
    times per step, and nesting the expressions would grow them exponentially.
    """
    c = BERN
    t = "_w84_"
    cb0, sb0 = _d(math.cos(c["b0"])), _d(math.sin(c["b0"]))
    df = (df.withColumn(t + "l", (_c(e) - _d(2600000.0)) / _d(c["r"]))
            .withColumn(t + "bb", _d(2.0) * (F.atan(F.exp((_c(n) - _d(1200000.0)) / _d(c["r"]))) - _d(math.pi / 4))))
    l, bb = F.col(t + "l"), F.col(t + "bb")
    df = (df.withColumn(t + "b", F.asin(cb0 * F.sin(bb) + sb0 * F.cos(bb) * F.cos(l)))
            .withColumn(t + "lam", _d(c["lam0"]) + F.atan2(F.sin(l), cb0 * F.cos(l) - sb0 * F.tan(bb)) / _d(c["alpha"])))
    b = F.col(t + "b")
    df = df.withColumn(t + "sb", (F.log(F.tan(_d(math.pi / 4) + b / _d(2.0))) - _d(c["k"])) / _d(c["alpha"]))
    df = df.withColumn(t + "phi", b)
    for _ in range(iterations):
        s = F.col(t + "sb") + _d(c["e"]) * F.log(F.tan(_d(math.pi / 4) + F.asin(_d(c["e"]) * F.sin(t + "phi")) / _d(2.0)))
        df = df.withColumn(t + "phi", _d(2.0) * F.atan(F.exp(s)) - _d(math.pi / 2))
    phi, lam = F.col(t + "phi"), F.col(t + "lam")
    df = df.withColumn(t + "nb", _d(BESSEL_A) / F.sqrt(_d(1.0) - _d(BESSEL_E2) * F.sin(phi) * F.sin(phi)))
    nb = F.col(t + "nb")
    df = (df.withColumn(t + "gx", nb * F.cos(phi) * F.cos(lam) + _d(SHIFT_DX))
            .withColumn(t + "gy", nb * F.cos(phi) * F.sin(lam) + _d(SHIFT_DY))
            .withColumn(t + "gz", nb * (_d(1.0) - _d(BESSEL_E2)) * F.sin(phi) + _d(SHIFT_DZ)))
    gx, gy, gz = F.col(t + "gx"), F.col(t + "gy"), F.col(t + "gz")
    df = df.withColumn(t + "p", F.sqrt(gx * gx + gy * gy))
    df = df.withColumn(t + "lat", F.atan(gz / F.col(t + "p")))
    for _ in range(iterations):
        lat = F.col(t + "lat")
        nw = _d(WGS84_A) / F.sqrt(_d(1.0) - _d(WGS84_E2) * F.sin(lat) * F.sin(lat))
        df = df.withColumn(t + "lat", F.atan((gz + _d(WGS84_E2) * nw * F.sin(lat)) / F.col(t + "p")))
    df = df.withColumn(lon_out, F.degrees(F.atan2(gy, gx))).withColumn(lat_out, F.degrees(F.col(t + "lat")))
    return df.drop(*[x for x in df.columns if x.startswith(t)])
