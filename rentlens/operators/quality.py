"""Reason-coded listing filter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


@dataclass(frozen=True)
class Bounds:
    """What a listing can plausibly have; both ends count as inside."""

    area: tuple[float, float] = (15.0, 400.0)
    price_m2: tuple[float, float] = (1500.0, 40000.0)
    latitude: tuple[float, float] = (50.5, 52.0)
    longitude: tuple[float, float] = (70.5, 72.5)
    cities: tuple[str, ...] = ("astana", "астана", "нур-султан", "nur-sultan", "nursultan")
    include_missing: bool = True


#: Codes in the order in which they are tried.
REASONS = ["incomplete", "missing", "storage", "price", "area", "area_bounds", "price_m2_bounds", "outside", "city"]


def reject_reason(bounds: Bounds = Bounds()) -> Column:
    """The first code that applies to a row, null for a good one."""
    price, area, lat, lon = (S.coerce(c, F.col(c)) for c in ("price", "square_m2", "latitude", "longitude"))
    storage, city = F.trim(F.coalesce("storage", F.lit(""))), F.lower(F.trim(F.coalesce("city", F.lit(""))))
    inside = lat.between(*bounds.latitude) & lon.between(*bounds.longitude)
    tests = {
        "incomplete": ~S.is_complete(),
        "missing": F.lit(not bounds.include_missing) & F.col("status").eqNullSafe("missing"),
        "storage": (storage != "") & (storage != "live"),
        "price": price <= 0,
        "area": area <= 0,
        "area_bounds": ~area.between(*bounds.area),
        "price_m2_bounds": ~S.price_m2(price, area).between(*bounds.price_m2),
        "outside": lat.isNotNull() & lon.isNotNull() & ~inside,
        "city": (city != "") & ~city.isin(*bounds.cities),
    }
    out = F
    for code in REASONS:
        out = out.when(tests[code], code)
    return out


def reject(df: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """df with a reason column."""
    return df.withColumn("reason", reject_reason(bounds))


def accepted(df: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    return reject(df, bounds).filter(F.col("reason").isNull()).drop("reason")


def histogram(rejected: DataFrame) -> DataFrame:
    """(reason, n), the most frequent first."""
    return rejected.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def reject_rate(rejected: DataFrame, alarm: float = 0.1) -> DataFrame:
    """One row: total, rejected, rate, and whether the rate is over the alarm."""
    sums = rejected.agg(F.count("*").alias("total"), F.count("reason").alias("rejected"))
    rate = F.coalesce(F.try_divide("rejected", "total"), F.lit(0.0))
    return sums.withColumn("rate", rate).withColumn("alarm", rate > alarm)


def reason_text(reason: Column, bounds: Bounds = Bounds()) -> Column:
    """A reason code as a sentence part with its bounds."""
    texts = {
        "incomplete": "price, rooms or area missing", "missing": "no longer listed", "storage": "not a live advert", "price": "price not positive", "area": "area not positive",
        "area_bounds": "area outside [%.0f, %.0f]" % bounds.area, "price_m2_bounds": "price a square metre outside [%.0f, %.0f]" % bounds.price_m2,
        "outside": "coordinates outside [%.2f, %.2f] x [%.2f, %.2f]" % (*bounds.latitude, *bounds.longitude), "city": "city is not one of: " + ", ".join(bounds.cities),
    }
    out = F
    for code in REASONS:
        out = out.when(reason == code, texts[code])
    return out.otherwise(reason)
