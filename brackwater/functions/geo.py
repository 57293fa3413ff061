"""Boxes, distances, grids and projections on plain coordinate columns.

Places are lon/lat in degrees; footprints are always axis-parallel boxes, so four columns hold them
without loss and their filters reach the Parquet scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
KM_PER_DEGREE = 111.0
MERCATOR_RADIUS = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE, UTM_EAST = 0.9996, 500000.0

Box = tuple[float, float, float, float]


def box_around(lat: float, lon: float, km: float) -> Box:
    """minx, miny, maxx, maxy of a square of so many km each way, at 111 km a degree (G1)."""
    d = km / KM_PER_DEGREE
    return lon - d, lat - d, lon + d, lat + d


def boxes_meet(box: Box, minx: Column = None, miny: Column = None, maxx: Column = None, maxy: Column = None) -> Column:
    """Whether footprints meet a box; touching counts."""
    x0, y0, x1, y1 = box
    c = [x if x is not None else F.col(n) for x, n in ((minx, "minx"), (miny, "miny"), (maxx, "maxx"), (maxy, "maxy"))]
    return (c[2] >= x0) & (c[0] <= x1) & (c[3] >= y0) & (c[1] <= y1)


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance on a sphere of mean radius."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.when(h.isNotNull(), F.least(h, F.lit(1.0)))))  # least() passes over a null


#: The length of any path on the ellipsoid is within these factors of its length on the sphere: the extremes of the two radii of curvature, over the mean radius.
MOST_CURVED, LEAST_CURVED = MERCATOR_RADIUS * (1 - FLATTENING) ** 2 / 1000 / EARTH_KM, MERCATOR_RADIUS / (1 - FLATTENING) / 1000 / EARTH_KM


def _let(value: Column, then) -> Column:
    """then(value) with value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


_F, _A = FLATTENING, MERCATOR_RADIUS / 1000
_B = _A * (1 - _F)


def _ends(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> dict[str, Column]:
    """Sines and cosines of the reduced latitudes, and the longitude between the ends."""
    u1, u2 = (F.atan((1 - _F) * F.tan(F.radians(x))) for x in (lat1, lat2))
    return {"s1": F.sin(u1), "c1": F.cos(u1), "s2": F.sin(u2), "c2": F.cos(u2), "l": F.radians(lon2 - lon1 - 360.0 * F.round((lon2 - lon1) / 360.0))}


def _arc(e, lam: Column) -> dict[str, Column]:
    """The arc on the auxiliary sphere (its sine, cosine and angle), and the product of the end latitudes' cosines with the sine of lam."""
    sine = F.sqrt(F.pow(e["c2"] * F.sin(lam), 2) + F.pow(e["c1"] * e["s2"] - e["s1"] * e["c2"] * F.cos(lam), 2))
    cosine = e["s1"] * e["s2"] + e["c1"] * e["c2"] * F.cos(lam)
    return {"ss": sine, "cs": cosine, "sigma": F.atan2(sine, cosine), "m": e["c1"] * e["c2"] * F.sin(lam)}


def _course(e, p) -> dict[str, Column]:
    """Sine of the geodesic's azimuth at the equator, its squared cosine, and the cosine of twice the arc's middle."""
    return _bent(e, p, F.when(p["ss"] > 0, p["m"] / F.when(p["ss"] > 0, p["ss"])).otherwise(0.0))


def _bent(e, p, sine: Column) -> dict[str, Column]:
    square = 1 - sine * sine
    middle = F.when(square > 1e-15, p["cs"] - 2 * e["s1"] * e["s2"] / F.when(square > 1e-15, square)).otherwise(0.0)
    return {"sa": sine, "ca": square, "cm": middle}


def _moved(e, p, q) -> Column:
    c = _F / 16 * q["ca"] * (4 + _F * (4 - 3 * q["ca"]))
    return e["l"] + (1 - c) * _F * q["sa"] * (p["sigma"] + c * p["ss"] * (q["cm"] + c * p["cs"] * (2 * q["cm"] * q["cm"] - 1)))


def _length(p, q) -> Column:
    square = q["ca"] * (_A * _A - _B * _B) / (_B * _B)
    big = 1 + square / 16384 * (4096 + square * (-768 + square * (320 - 175 * square)))
    small = square / 1024 * (256 + square * (-128 + square * (74 - 47 * square)))
    twice = 2 * q["cm"] * q["cm"] - 1
    inner = p["cs"] * twice - small / 6 * q["cm"] * (4 * p["ss"] * p["ss"] - 3) * (4 * q["cm"] * q["cm"] - 3)
    return _B * big * (p["sigma"] - small * p["ss"] * (q["cm"] + small / 4 * inner))


def _settled(move: Column, lam: Column) -> Column:
    return (move < 1e-11) & (F.abs(lam) <= math.pi)


def geodesic_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column, rounds: int = 8) -> Column:
    """Distance along the ellipsoid WGS84 (G5): the inverse problem by iteration of the longitude on the auxiliary sphere.

    Each round adds two to three digits, so eight are more than doubles hold. Close to antipodes the iteration does not
    settle; there the distance on the sphere stands in, which is within 0.56 % of it. Null coordinates give null.
    """

    def struct(parts: dict[str, Column]) -> Column:
        return F.struct(*[v.alias(k) for k, v in parts.items()])

    def step(e: Column, lam: Column) -> Column:
        return _let(struct(_arc(e, lam)), lambda p: _let(struct(_course(e, p)), lambda q: _moved(e, p, q)))

    def length(e: Column, lam: Column) -> Column:
        return _let(struct(_arc(e, lam)), lambda p: _let(struct(_course(e, p)), lambda q: _length(p, q)))

    def solved(e: Column) -> Column:
        state = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(e["l"].alias("lam"), F.lit(10.0).alias("move")), lambda s, _: _let(step(e, s["lam"]), lambda new: F.struct(new.alias("lam"), F.abs(new - s["lam"]).alias("move"))))
        return _let(state, lambda s: F.when(_settled(s["move"], s["lam"]), length(e, s["lam"])))

    return F.coalesce(_let(struct(_ends(lon1, lat1, lon2, lat2)), solved), haversine_km(lon1, lat1, lon2, lat2))


def with_geodesic(df: DataFrame, name: str, lon1: Column, lat1: Column, lon2: Column, lat2: Column, rounds: int = 8) -> DataFrame:
    """df with geodesic_km() of its columns as one more, to the bit, at a fraction of the cost where rows are many.

    The rounds' steps are columns here, which Spark compiles; steps within an expression are interpreted. The distance comes out of a
    list of one: conditions on it are not moved below it then, where each would have it computed again.
    """
    own, ends = df.columns, ["s1", "c1", "s2", "c2", "l"]
    at = {n: F.col(f"_g_{n}") for n in (*ends, "ss", "cs", "sigma", "sa", "ca", "cm", "lam", "move")}

    def held(df: DataFrame, *names: str, **more: Column) -> DataFrame:
        return df.select(*own, *[at[n] for n in names], *[v.alias(f"_g_{n}") for n, v in more.items()])

    def turned(df: DataFrame) -> DataFrame:
        arc = _arc(at, at["lam"])
        return held(df, *ends, "lam", "move", ss=arc["ss"], cs=arc["cs"], sa=_course(at, arc)["sa"])

    arc = {"ss": at["ss"], "cs": at["cs"], "sigma": F.atan2(at["ss"], at["cs"])}
    course = _bent(at, arc, at["sa"])
    out = held(df, **_ends(lon1, lat1, lon2, lat2))
    out = held(out, *ends, lam=at["l"], move=F.lit(10.0))
    for _ in range(rounds):
        new = _moved(at, arc, course)
        out = held(turned(out), *ends, lam=new, move=F.abs(new - at["lam"]))
    km = F.coalesce(F.when(_settled(at["move"], at["lam"]), _length(arc, course)), haversine_km(lon1, lat1, lon2, lat2))
    out = turned(out)
    return out.select(*own, km.alias("_g_km")).select(*own, F.explode(F.array("_g_km")).alias(name))


def nearest_in_box(lon: Column, lat: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> tuple[Column, Column]:
    """The place of a box nearest in degrees."""
    return F.least(F.greatest(lon, minx), maxx), F.least(F.greatest(lat, miny), maxy)


def km_to_box(lon: Column, lat: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Distance of a point to a box: to the box's point nearest in degrees; 0 inside."""
    return haversine_km(lon, lat, *nearest_in_box(lon, lat, minx, miny, maxx, maxy))


def geodesic_to_box(lon: Column, lat: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """km_to_box() along the ellipsoid."""
    return geodesic_km(lon, lat, *nearest_in_box(lon, lat, minx, miny, maxx, maxy))


def utm_zone(lon: Column) -> Column:
    """UTM zone of a longitude."""
    return (F.floor((lon + 180.0) / 6.0) + 1).cast("int")


def utm_epsg(lon: Column) -> Column:
    """EPSG code of the northern UTM zone."""
    return F.concat(F.lit("EPSG:"), (F.lit(32600) + utm_zone(lon)).cast("string"))


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Web-mercator metres."""
    return F.radians(lon) * MERCATOR_RADIUS, F.log(F.tan(F.lit(3.141592653589793) / 4 + F.radians(lat) / 2)) * MERCATOR_RADIUS


def unmercator(x: Column, y: Column) -> tuple[Column, Column]:
    """Degrees from web-mercator metres."""
    return F.degrees(x / MERCATOR_RADIUS), F.degrees(2 * F.atan(F.exp(y / MERCATOR_RADIUS)) - F.lit(3.141592653589793) / 2)


def utm_series() -> dict[str, list[float]]:
    """Coefficients of the transverse Mercator series to the fourth power of the third flattening n, for multiples 1 to 4 of an angle.

    alpha: sphere to plane, beta: plane to sphere, delta: conformal to geographic latitude. What is left out is below a micrometre within a zone.
    """
    n = FLATTENING / (2 - FLATTENING)
    # The series' coefficients, from the power of n that equals the multiple up to the fourth.
    powers = {
        "alpha": [[1 / 2, -2 / 3, 5 / 16, 41 / 180], [13 / 48, -3 / 5, 557 / 1440], [61 / 240, -103 / 140], [49561 / 161280]],
        "beta": [[1 / 2, -2 / 3, 37 / 96, -1 / 360], [1 / 48, 1 / 15, -437 / 1440], [17 / 480, -37 / 840], [4397 / 161280]],
        "delta": [[2, -2 / 3, -2, 116 / 45], [7 / 3, -8 / 5, -227 / 45], [56 / 15, -136 / 35], [4279 / 630]],
    }
    return {k: [sum(c * n ** (j + i) for i, c in enumerate(row)) for j, row in enumerate(rows, 1)] for k, rows in powers.items()}


def utm_radius() -> float:
    """Metres of a radian along the central meridian, on the average, with the scale of UTM."""
    n = FLATTENING / (2 - FLATTENING)
    return UTM_SCALE * MERCATOR_RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)


def utm(lon: Column, lat: Column, zone: Column | int) -> tuple[Column, Column]:
    """Easting and northing in metres of a northern UTM zone, which need not be the place's own."""
    e = math.sqrt(FLATTENING * (2 - FLATTENING))
    angle, sine = F.radians(lon - (zone * 6.0 - 183.0)), F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    up, along = F.atan2(t, F.cos(angle)), F.atanh(F.sin(angle) / F.sqrt(1 + t * t))
    x, y = along, up
    for j, c in enumerate(utm_series()["alpha"], 1):
        x, y = x + c * F.cos(2 * j * up) * F.sinh(2 * j * along), y + c * F.sin(2 * j * up) * F.cosh(2 * j * along)
    return UTM_EAST + utm_radius() * x, utm_radius() * y


def unutm(x: Column, y: Column, zone: Column | int) -> tuple[Column, Column]:
    """Degrees from metres of a northern UTM zone."""
    up, along = y / utm_radius(), (x - UTM_EAST) / utm_radius()
    series = utm_series()
    a, b = along, up
    for j, c in enumerate(series["beta"], 1):
        a, b = a - c * F.cos(2 * j * up) * F.sinh(2 * j * along), b - c * F.sin(2 * j * up) * F.cosh(2 * j * along)
    chi = F.asin(F.sin(b) / F.cosh(a))
    lat = chi
    for j, c in enumerate(series["delta"], 1):
        lat = lat + c * F.sin(2 * j * chi)
    return zone * 6.0 - 183.0 + F.degrees(F.atan2(F.sinh(a), F.cos(b))), F.degrees(lat)


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Plane distance of a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    size = dx * dx + dy * dy
    t = F.when(size > 0, F.least(F.greatest(((px - x1) * dx + (py - y1) * dy) / F.when(size > 0, size), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return F.sqrt(F.pow(px - (x1 + t * dx), 2) + F.pow(py - (y1 + t * dy), 2))


def box_wkt(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """The box as a WKT polygon, counter-clockwise from the lower right corner."""
    def at(x: Column, y: Column) -> Column:
        return F.concat_ws(" ", x.cast("string"), y.cast("string"))

    ring = F.concat_ws(", ", at(maxx, miny), at(maxx, maxy), at(minx, maxy), at(minx, miny), at(maxx, miny))
    return F.concat(F.lit("POLYGON(("), ring, F.lit("))"))


def wkt_points(wkt: Column) -> Column:
    """array<struct<x, y>> of the coordinate pairs in a WKT."""
    number = r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
    pairs = F.regexp_extract_all(wkt, F.lit(rf"({number}\s+{number})"), F.lit(1))
    parts = F.transform(pairs, lambda p: F.split(p, r"\s+"))
    return F.transform(parts, lambda p: F.struct(p[0].cast("double").alias("x"), p[1].cast("double").alias("y")))


def tile_choice(width_deg: Column, height_deg: Column, scale_m: Column, bands: Column, sensor: Column) -> tuple[Column, Column]:
    """(estimated bytes, tiles per side) of a download: two bytes per pixel and band; Sentinel-2 over 30 MB in 2x2, over 100 MB in 3x3."""
    px = (width_deg * 111000.0 / scale_m).cast("long")
    py = (height_deg * 111000.0 / scale_m).cast("long")
    size = px * py * bands * 2
    tiles = F.when(sensor != "sentinel-2", 1).when(size > 100_000_000, 3).when(size > 30_000_000, 2).otherwise(1)
    return size, tiles
