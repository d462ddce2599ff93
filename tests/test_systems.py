"""Coordinate systems against published example points and a plain statement of the datum shift."""

import math

import pytest

from mapweave.functions import geometry as G


def moved(spark, rows, src, dst):
    df = spark.createDataFrame(rows, "x double, y double")
    x, y = G.reproject_xy("x", "y", src, dst)
    return [tuple(r) for r in df.select(x.alias("x2"), y.alias("y2")).collect()]


# fixed values: example points of the published guidance on each projection method
@pytest.mark.parametrize(
    "code, lon, lat, east, north",
    [
        ("epsg:3035", 5.0, 50.0, 3962799.45, 2999718.85),
        ("epsg:3857", -(100 + 20 / 60), 24 + 22 / 60 + 54.433 / 3600, -11169055.58, 2800000.00),
    ],
)
def test_published_points(spark, code, lon, lat, east, north):
    (x, y), = moved(spark, [(lon, lat)], "epsg:4326", code)
    assert abs(x - east) < 0.01 and abs(y - north) < 0.01
    (u, v), = moved(spark, [(x, y)], code, "epsg:4326")
    assert abs(u - lon) < 1e-8 and abs(v - lat) < 1e-8


@pytest.mark.parametrize("code", ["epsg:3035", "epsg:3857", "epsg:31466", "epsg:31467", "epsg:31468", "epsg:31469", "epsg:25832"])
def test_there_and_back(spark, code):
    rows = [(lon / 2, lat / 2) for lon in range(10, 32, 3) for lat in range(94, 112, 3)] + [(10.0, 52.0)]
    back = moved(spark, moved(spark, rows, "epsg:4326", code), code, "epsg:4326")
    # heights are dropped on the way through another datum: the way back may differ by a fraction of a millimetre
    assert max(max(abs(a - c), abs(b - d)) for (a, b), (c, d) in zip(rows, back, strict=True)) < 2e-8


def test_datum_shift_against_plain_rules(spark):
    """Geocentric coordinates of a Bessel point, shifted and solved by iteration."""
    lon, lat = 9.1, 48.7
    a, f = 6377397.155, 1 / 299.1528128
    e2, p, q = f * (2 - f), math.radians(lat), math.radians(lon)
    r = a / math.sqrt(1 - e2 * math.sin(p) ** 2)
    x, y, z = r * math.cos(p) * math.cos(q), r * math.cos(p) * math.sin(q), r * (1 - e2) * math.sin(p)
    dx, dy, dz, *turn, ppm = G.DHDN_TO_WGS84
    rx, ry, rz = (math.radians(t / 3600) for t in turn)
    m = 1 + ppm / 1e6
    x, y, z = m * (x - rz * y + ry * z) + dx, m * (rz * x + y - rx * z) + dy, m * (-ry * x + rx * y + z) + dz
    b, g = 6378137.0, 1 / 298.257223563
    ee, at = g * (2 - g), p
    for _ in range(50):
        n = b / math.sqrt(1 - ee * math.sin(at) ** 2)
        at = math.atan2(z + ee * n * math.sin(at), math.hypot(x, y))
    got = spark.range(1).select(*G.shifted_datum(G._dbl(lon), G._dbl(lat), "Bessel", "WGS84", G.DHDN_TO_WGS84)).first()
    assert abs(got[0] - math.degrees(math.atan2(y, x))) < 1e-11 and abs(got[1] - math.degrees(at)) < 1e-11
    # the two nets lie some 100 to 200 metres apart
    gap = math.hypot((got[0] - lon) * 111320 * math.cos(p), (got[1] - lat) * 111320)
    assert 50 < gap < 250


def test_equal_area_keeps_areas(spark):
    """A small square has its true area anywhere on the map."""
    for lon, lat in ((-5.0, 40.0), (10.0, 52.0), (25.0, 65.0)):
        h = 0.005
        pts = moved(spark, [(lon - h, lat - h), (lon + h, lat - h), (lon + h, lat + h), (lon - h, lat + h)], "epsg:4326", "epsg:3035")
        area = abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1]))) / 2
        a, e2 = 6378137.0, 0.00669438002290
        p = math.radians(lat)
        w = 1 - e2 * math.sin(p) ** 2
        true = (math.radians(2 * h) * a * math.cos(p) / math.sqrt(w)) * (math.radians(2 * h) * a * (1 - e2) / w**1.5)
        assert abs(area / true - 1) < 1e-4


def test_unknown_systems_raise():
    for code in ("epsg:31465", "epsg:31470", "epsg:1", "4326"):
        with pytest.raises(ValueError):
            G.Crs(code)
