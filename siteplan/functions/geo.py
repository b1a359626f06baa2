"""Great-circle distance and one equal-area projection as Column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_MI = 3958.8  # fixed value
SQ_M_PER_SQ_MI = 2.59e6  # fixed value


def haversine_miles(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in miles; the arguments are SQL expressions in degrees."""
    s_lat, s_lon = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lon2} - {lon1}) / 2)"
    a = f"{s_lat} * {s_lat} + cos(radians({lat1})) * cos(radians({lat2})) * {s_lon} * {s_lon}"
    return F.expr(f"asin(least(sqrt({a}), 1d)) * {2 * EARTH_RADIUS_MI}d")


class AlbersConus:
    """Ellipsoidal Albers equal-area projection for the contiguous United States.

    Fixed values: GRS80 ellipsoid, standard parallels 29.5 and 45.5, origin 23 N 96 W.
    Formulas: Snyder, Map Projections, A Working Manual (USGS 1987), pages 101-102 and 16.
    """

    A = 6378137.0
    F_INV = 298.257222101
    PAR1, PAR2, LAT0, LON0 = 29.5, 45.5, 23.0, -96.0

    E2 = 2 / F_INV - 1 / F_INV ** 2
    E = math.sqrt(E2)

    @classmethod
    def _q_num(cls, lat: float) -> float:
        s = math.sin(math.radians(lat))
        return (1 - cls.E2) * (s / (1 - cls.E2 * s * s)
                               - math.log((1 - cls.E * s) / (1 + cls.E * s)) / (2 * cls.E))

    @classmethod
    def constants(cls) -> tuple[float, float, float, float]:
        """(n, C, rho0, q at the pole)"""
        def m2(lat: float) -> float:
            s = math.sin(math.radians(lat))
            return math.cos(math.radians(lat)) ** 2 / (1 - cls.E2 * s * s)

        q1, q2 = cls._q_num(cls.PAR1), cls._q_num(cls.PAR2)
        n = (m2(cls.PAR1) - m2(cls.PAR2)) / (q2 - q1)
        c = m2(cls.PAR1) + n * q1
        rho0 = cls.A * math.sqrt(c - n * cls._q_num(cls.LAT0)) / n
        return n, c, rho0, cls._q_num(90.0)

    @classmethod
    def forward(cls, lat: Column, lon: Column) -> tuple[Column, Column]:
        """(x, y) in metres."""
        n, c, rho0, _ = cls.constants()
        s = F.sin(F.radians(lat))
        q = (1 - cls.E2) * (s / (1 - cls.E2 * s * s)
                            - F.ln((1 - cls.E * s) / (1 + cls.E * s)) / (2 * cls.E))
        rho = F.sqrt(c - n * q) * (cls.A / n)
        theta = F.radians(lon - cls.LON0) * n
        return rho * F.sin(theta), rho0 - rho * F.cos(theta)

    @classmethod
    def inverse(cls, x: Column, y: Column) -> tuple[Column, Column]:
        """(lat, lon) in degrees, by the authalic-latitude series."""
        n, c, rho0, qp = cls.constants()
        dy = rho0 - y
        rho2 = x * x + dy * dy
        beta = F.asin((c - rho2 * (n / cls.A) ** 2) / n / qp)
        e2, e4, e6 = cls.E2, cls.E2 ** 2, cls.E2 ** 3
        lat = (beta + F.sin(beta * 2) * (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040)
               + F.sin(beta * 4) * (23 * e4 / 360 + 251 * e6 / 3780)
               + F.sin(beta * 6) * (761 * e6 / 45360))
        return F.degrees(lat), F.degrees(F.atan2(x, dy) / n) + cls.LON0
