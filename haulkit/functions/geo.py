"""Alaska Albers equal-area conic (ellipsoidal, Snyder 1987 eqs. 14-1..14-21)
as Spark column expressions, plus the same formulas in numpy and SQL text.

Only the per-point terms run per row (sin, log, sqrt, atan2 — all JVM
built-ins inside whole-stage codegen); the cone constants n, C, rho0 depend
on the projection parameters alone and are computed once here.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


class Albers:
    def __init__(self, lon0=K.ALBERS["lon0"], lat1=K.ALBERS["lat1"], lat2=K.ALBERS["lat2"],
                 lat0=K.ALBERS["lat0"], a=K.ALBERS["a"], inv_f=K.ALBERS["inv_f"], x0=0.0, y0=0.0):
        f = 1.0 / inv_f
        self.a, self.e2 = a, 2 * f - f * f
        self.e = math.sqrt(self.e2)
        self.lon0, self.x0, self.y0 = math.radians(lon0), x0, y0
        p1, p2, p0 = (math.radians(v) for v in (lat1, lat2, lat0))
        m1, m2 = self._m(p1), self._m(p2)
        q1, q2, q0 = self._q(p1), self._q(p2), self._q(p0)
        self.n = (m1 * m1 - m2 * m2) / (q2 - q1)
        self.C = m1 * m1 + self.n * q1
        self.rho0 = a * math.sqrt(self.C - self.n * q0) / self.n

    def _m(self, phi):
        s = math.sin(phi)
        return math.cos(phi) / math.sqrt(1 - self.e2 * s * s)

    def _q(self, phi):
        s, e = math.sin(phi), self.e
        return (1 - self.e2) * (s / (1 - self.e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    # ---- Spark columns
    def forward(self, lon, lat) -> tuple[Column, Column]:
        lon = F.col(lon) if isinstance(lon, str) else lon
        lat = F.col(lat) if isinstance(lat, str) else lat
        s = F.sin(F.radians(lat))
        e, e2 = F.lit(self.e), F.lit(self.e2)
        q = (F.lit(1 - self.e2) * (s / (F.lit(1.0) - e2 * s * s)
             - F.lit(1 / (2 * self.e)) * F.log((F.lit(1.0) - e * s) / (F.lit(1.0) + e * s))))
        rho = F.lit(self.a) * F.sqrt(F.lit(self.C) - F.lit(self.n) * q) / F.lit(self.n)
        theta = F.lit(self.n) * (F.radians(lon) - F.lit(self.lon0))
        x = rho * F.sin(theta) + F.lit(self.x0)
        y = F.lit(self.rho0) - rho * F.cos(theta) + F.lit(self.y0)
        return x, y

    def inverse(self, x, y) -> tuple[Column, Column]:
        """Projected metres -> (lon, lat) degrees.  Latitude from the authalic
        latitude by Snyder's series (eq. 3-18), closed form (error ~1e-9 rad
        on GRS80), so the expression stays small inside codegen."""
        x = (F.col(x) if isinstance(x, str) else x) - F.lit(self.x0)
        y = (F.col(y) if isinstance(y, str) else y) - F.lit(self.y0)
        ry = F.lit(self.rho0) - y
        rho2 = x * x + ry * ry
        theta = F.atan2(x, ry)
        q = (F.lit(self.C) - rho2 * F.lit(self.n * self.n / (self.a * self.a))) / F.lit(self.n)
        e, e2 = self.e, self.e2
        qp = 1 - ((1 - e2) / (2 * e)) * math.log((1 - e) / (1 + e))
        beta = F.asin(F.least(F.greatest(q / F.lit(qp), F.lit(-1.0)), F.lit(1.0)))
        e4, e6 = e2 * e2, e2 * e2 * e2
        phi = (beta + F.lit(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(F.lit(2.0) * beta)
               + F.lit(23 * e4 / 360 + 251 * e6 / 3780) * F.sin(F.lit(4.0) * beta)
               + F.lit(761 * e6 / 45360) * F.sin(F.lit(6.0) * beta))
        lon = F.degrees(theta / F.lit(self.n) + F.lit(self.lon0))
        return lon, F.degrees(phi)

    # ---- numpy (constants, tests)
    def forward_np(self, lon, lat):
        lon, lat = np.radians(np.asarray(lon, float)), np.radians(np.asarray(lat, float))
        s, e = np.sin(lat), self.e
        q = (1 - self.e2) * (s / (1 - self.e2 * s * s) - (1 / (2 * e)) * np.log((1 - e * s) / (1 + e * s)))
        rho = self.a * np.sqrt(self.C - self.n * q) / self.n
        theta = self.n * (lon - self.lon0)
        return rho * np.sin(theta) + self.x0, self.rho0 - rho * np.cos(theta) + self.y0

    # ---- SQL text (DuckDB oracle)
    def forward_sql(self, lon: str, lat: str) -> tuple[str, str]:
        s = f"sin(radians({lat}))"
        q = (f"({(1 - self.e2)!r} * ({s} / (1.0 - {self.e2!r} * {s} * {s}) - {1 / (2 * self.e)!r} * "
             f"ln((1.0 - {self.e!r} * {s}) / (1.0 + {self.e!r} * {s}))))")
        rho = f"({self.a!r} * sqrt({self.C!r} - {self.n!r} * {q}) / {self.n!r})"
        theta = f"({self.n!r} * (radians({lon}) - {self.lon0!r}))"
        return (f"({rho} * sin({theta}) + {self.x0!r})", f"({self.rho0!r} - {rho} * cos({theta}) + {self.y0!r})")


ALASKA_ALBERS = Albers()


def window_corners(lat=K.PLOT_LAT, lon=K.PLOT_LON, proj: Albers = ALASKA_ALBERS):
    """The plot window's projected limits (two projected corner points, as
    the map code crops with xlim/ylim from them)."""
    xs, ys = proj.forward_np([lon[0], lon[1]], [lat[0], lat[1]])
    return (float(min(xs)), float(max(xs))), (float(min(ys)), float(max(ys)))


def in_window(x, y, corners=None) -> Column:
    (x0, x1), (y0, y1) = corners or window_corners()
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return x.between(x0, x1) & y.between(y0, y1)
