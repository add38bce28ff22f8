"""Joins by closeness against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rentlens.functions import scalars as S
from rentlens.operators import close
from tests.plans import plan


def metres(a, b):
    lat1, lon1, lat2, lon2 = (math.radians(x) for x in (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * S.EARTH_M * math.asin(math.sqrt(min(1, h)))


def points(rng):
    """Crowds in the plain, near both poles and on them, along the date line; copies; junk."""
    out = []
    for lat, lon in ((51.1, 71.4), (0, 0), (89.9999, 12), (-89.9, -170), (70, 179.9999), (70, -179.9999), (-45, 180), (-45, -180)):
        out += [(min(90.0, max(-90.0, lat + rng.uniform(-1, 1) * s)), lon + rng.uniform(-1, 1) * s) for s in (1e-4, 1e-3, 0.01, 1) for _ in range(12)]
    out += [(90.0, 0.0), (90.0, 55.0), (-90.0, 10.0), (51.1, 71.4), (51.1, 71.4), (0.0, 180.0), (0.0, -180.0), (0.0, 540.0)]
    return out


@pytest.mark.parametrize("radius", [30, 2_000, 400_000])
def test_near_places(spark, radius):
    rows = points(random.Random(6))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(rows)] + [(9000, None, 1.0), (9001, 95.0, 1.0), (9002, float("nan"), 1.0), (9003, 1.0, float("inf"))], "id long, latitude double, longitude double")
    out = close.near(close.places(df), radius)
    got = {((r["lat_a"], r["lon_a"]), (r["lat_b"], r["lon_b"])): (r["n_a"], r["n_b"]) for r in out.collect()}
    places = sorted(set(rows))
    want = {(a, b): (rows.count(a), rows.count(b)) for a in places for b in places if a < b and metres(a, b) <= radius}
    assert got == want and len(want) > 20
    n = {r["id"]: r["n_near"] for r in close.neighbours(df, radius).collect()}
    assert n == {i: sum(metres(p, q) <= radius for q in rows) - 1 for i, p in enumerate(rows)} | {9000: None, 9001: None, 9002: None, 9003: None}
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_bands(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([1, 2, None]), round(rng.choice([rng.uniform(15, 60), rng.uniform(30, 45), rng.uniform(100, 900)]), rng.randint(0, 1)), float(round(math.exp(rng.uniform(4.5, 5.5))))) for i in range(700)]
    rows += [(1000, 1, 0.0, 100.0), (1001, 1, None, 100.0), (1002, 1, 37.5, 100.0), (1003, 1, 40.5, 100.0), (1004, 1, 40.5, 98.0), (1005, 1, 50.0, None), (1006, 1, -5.0, 100.0)]
    df = spark.createDataFrame(rows, "id int, floor int, square_m2 double, price double")
    want = {}
    for i, g, a, p in rows:
        ok = lambda x: x is not None and x > 0
        if g is None or not ok(a) or not ok(p):
            want[i] = None
        else:
            want[i] = sum(h == g and ok(b) and ok(q) and abs(a - b) <= max(3.0, min(a, b) * 0.08) and abs(p - q) / max(p, q) <= 0.02 for _, h, b, q in rows) - 1
    out = close.alike(df)
    assert {r["id"]: r["n_alike"] for r in out.collect()} == want and max(x or 0 for x in want.values()) > 4
    both = close.close(close.classes(df))
    assert both.count() > 100 and "NestedLoop" not in plan(both) and "Cartesian" not in plan(both)
    assert close.alike(df.limit(0)).count() == 0 and close.neighbours(df.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(1.0)}).limit(0)).count() == 0
