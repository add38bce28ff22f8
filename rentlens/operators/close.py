"""Joins by closeness: places within a radius of each other, listings whose area and price lie in tolerance bands.

Both are equi-joins on cells that are as wide as the tolerance, with the exact condition behind them, never joins on a condition. One side stands in its own
cell only, the other asks all cells that can hold a partner, so each pair is found once. Equal values are one class with a count, and copies never
meet; what is left of a hot cell is a join of two plain shuffles, which adaptive execution splits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import cut

# places


def places(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """(lat, lon, n): distinct points and their rows. Missing points and latitudes that don't exist are left out."""
    at = df.select(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    good = F.col("lat").between(-90, 90) & (F.abs("lon") < 1e6)  # neither NaN nor infinite
    return at.filter(good).groupBy("lat", "lon").agg(F.count("*").alias("n"))


def _cells(radius: float) -> tuple[float, object]:
    """Height of a band in degrees, and the number of cells in a band as a function of its number: a cell is at least as wide as the radius."""
    height = max(math.degrees(radius / S.EARTH_M) * (1 + 1e-9), 1e-7)

    def count(band: Column) -> Column:
        far = F.least(F.lit(90.0), F.greatest(F.abs(band * height - 90), F.abs((band + 1) * height - 90)))
        return F.greatest(F.lit(1), F.floor(F.lit(360.0) * F.cos(F.radians(far)) / height)).cast("long")

    return height, count


def near(points: DataFrame, radius: float = S.SAME_BUILDING_M) -> DataFrame:
    """(lat_a, lon_a, n_a, lat_b, lon_b, n_b, metres) of each two places up to radius metres apart, a before b.

    A band of latitude is as high as the radius. A place asks its own band and those beside it, each for the cells that a circle around it
    can touch: few of them, all of a band's where the circle holds a pole, and on from the other end at the date line."""
    height, count = _cells(radius)
    band, turned = F.floor((F.col("lat") + 90) / height).cast("long"), F.pmod(F.col("lon") + 180, F.lit(360.0))
    here = points.withColumns({"band": band, "x": turned})
    left = here.select(F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"), F.col("n").alias("n_a"), "band", F.least(F.floor(F.col("x") * count(F.col("band")) / 360).cast("long"), count(F.col("band")) - 1).alias("cell"))
    sine = F.lit(math.sin(math.radians(height))) / F.cos(F.radians("lat"))
    reach = F.when(F.abs("lat") + height >= 90, 180.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), sine))) * (1 + 1e-9) + 1e-9)

    def asked(k: Column) -> Column:
        b = F.col("band") + k
        n = count(b)
        lo, hi = (F.floor((F.col("x") + s * F.col("reach")) * n / 360).cast("long") for s in (-1, 1))
        some = F.when(hi - lo + 1 >= n, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.transform(F.sequence(lo, hi), lambda c: F.pmod(c, n)))
        return F.transform(some, lambda c: F.struct(b.alias("band"), c.alias("cell")))

    asks = here.withColumn("reach", reach).withColumn("ask", F.explode(F.flatten(F.array(*[asked(F.lit(k)) for k in (-1, 0, 1)]))))
    right = asks.select(F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"), F.col("n").alias("n_b"), "ask.band", "ask.cell")
    pairs = left.join(right, ["band", "cell"]).filter(F.struct("lat_a", "lon_a") < F.struct("lat_b", "lon_b"))
    metres = S.haversine_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    return pairs.withColumn("metres", metres).filter(F.col("metres") <= radius).select("lat_a", "lon_a", "n_a", "lat_b", "lon_b", "n_b", "metres")


def neighbours(df: DataFrame, radius: float = S.SAME_BUILDING_M, lat: str = "latitude", lon: str = "longitude", name: str = "n_near") -> DataFrame:
    """df with the number of other rows up to radius metres away; null without a place."""
    points = cut(places(df, lat, lon))
    both = near(points, radius)
    sides = both.select("lat_a", "lon_a", F.col("n_b").alias("m")).unionByName(both.select(F.col("lat_b").alias("lat_a"), F.col("lon_b").alias("lon_a"), F.col("n_a").alias("m")))
    own = points.select(F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"), (F.col("n") - 1).alias("m"))
    sums = cut(sides.unionByName(own).groupBy("lat_a", "lon_a").agg(F.sum("m").alias(name)).withColumnsRenamed({"lat_a": "__lat", "lon_a": "__lon"}))
    out = df.drop(name).join(sums, (F.col(lat).cast("double") == F.col("__lat")) & (F.col(lon).cast("double") == F.col("__lon")), "left")
    return out.drop("__lat", "__lon")


# bands


def classes(df: DataFrame, group: str = "floor", area: str = "square_m2", price: str = "price") -> DataFrame:
    """(g, area, price, n): distinct values and their rows; rows without one of them can't be close to another."""
    some = df.select(F.col(group).alias("g"), F.col(area).cast("double").alias("area"), F.col(price).cast("double").alias("price"))
    return some.filter(F.col("g").isNotNull() & S.present(F.col("area")) & S.present(F.col("price")) & (F.col("area") > 0) & (F.col("price") > 0)).groupBy("g", "area", "price").agg(F.count("*").alias("n"))


def _area_band(area: Column, absolute: float, relative: float) -> Column:
    """Areas within the larger of both tolerances are at most one band apart: bands are linear up to where the tolerances meet, then logarithmic."""
    meet = absolute / relative
    linear, log = area / absolute, meet / absolute + F.log(area / meet) / math.log1p(relative)
    return F.floor(F.when(area <= meet, linear).otherwise(log) / (1 + relative)).cast("long")


def _price_band(price: Column, tolerance: float) -> Column:
    """Prices within a relative tolerance of the larger one are at most one band apart."""
    return F.floor(F.log(price) / (-math.log1p(-tolerance) * (1 + 1e-9))).cast("long")


def close(rows: DataFrame, area: tuple[float, float] = S.AREA_CLOSE, price: float = S.PRICE_CLOSE) -> DataFrame:
    """(g, area_a, price_a, n_a, area_b, price_b, n_b) of each two classes of a group with close area and close price, a before b."""
    banded = rows.withColumns({"ab": _area_band(F.col("area"), *area), "pb": _price_band(F.col("price"), price)})
    left = banded.select("g", "ab", "pb", F.col("area").alias("area_a"), F.col("price").alias("price_a"), F.col("n").alias("n_a"))
    beside = F.explode(F.array(*[F.struct((F.col("ab") + i).alias("ab"), (F.col("pb") + j).alias("pb")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    right = banded.withColumn("ask", beside).select("g", "ask.ab", "ask.pb", F.col("area").alias("area_b"), F.col("price").alias("price_b"), F.col("n").alias("n_b"))
    pairs = left.join(right, ["g", "ab", "pb"]).filter(F.struct("area_a", "price_a") < F.struct("area_b", "price_b"))
    return pairs.filter(S.area_close(F.col("area_a"), F.col("area_b"), *area) & S.price_close(F.col("price_a"), F.col("price_b"), price)).drop("ab", "pb")


def alike(df: DataFrame, group: str = "floor", area: str = "square_m2", price: str = "price", name: str = "n_alike") -> DataFrame:
    """df with the number of other rows of the same group with close area and price; null where one of the three is missing."""
    rows = cut(classes(df, group, area, price))
    both = close(rows)
    sides = [both.select("g", F.col(f"area_{x}").alias("area"), F.col(f"price_{x}").alias("price"), F.col(f"n_{y}").alias("m")) for x, y in ("ab", "ba")]
    sums = sides[0].unionByName(sides[1]).unionByName(rows.select("g", "area", "price", (F.col("n") - 1).alias("m"))).groupBy("g", "area", "price").agg(F.sum("m").alias(name))
    sums = cut(sums.withColumnsRenamed({"g": "__g", "area": "__a", "price": "__p"}))
    out = df.drop(name).join(sums, (F.col(group) == F.col("__g")) & (F.col(area).cast("double") == F.col("__a")) & (F.col(price).cast("double") == F.col("__p")), "left")
    return out.drop("__g", "__a", "__p")
