"""Scalar functions on columns: coercion, text, geometry, dates. All native expressions, safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema

NUMBER_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NBSP = " "
#: Owner names that say a role, not a person.
GENERIC_OWNERS = ["хозяин", "хозяйка", "собственник", "владелец", "агент", "риелтор", "риэлтор", "", "-"]
#: The Earth's radius, and how far apart two listings of one building can be.
EARTH_M = 6371000.0
SAME_BUILDING_M = 30.0
#: Tolerances (square metres, share of the smaller area) of the two area rules, share of the larger price, and least price change; sets of fewer
#: shingles aren't compared.
LEAST_SHINGLES = 8
AREA_CLOSE, AREA_VERY_CLOSE, PRICE_CLOSE, PRICE_STEP = (3.0, 0.08), (2.0, 0.04), 0.02, 0.01


def _gated(text: Column) -> Column:
    """Numeric text as a double; anything that isn't written as a decimal number is null."""
    return F.when(text.rlike(NUMBER_RE), text.try_cast("double"))


def to_long(value: Column) -> Column:
    """Integer columns: blanks and no-break spaces go, fractions are cut towards 0, junk and overflow are null."""
    number = _gated(F.translate(value.cast("string"), " " + NBSP, ""))
    return F.when(F.abs(number) < 9.2e18, number).cast("long")


def to_double(value: Column) -> Column:
    """Real columns: a comma is a decimal point, blanks go."""
    return _gated(F.translate(value.cast("string"), ", ", "."))


def to_number(value: Column) -> Column:
    """The deduper's number: outer blanks go, a comma is a decimal point, inner blanks make it null."""
    return _gated(F.translate(F.trim(value.cast("string")), ",", "."))


def coerce(column: str, value: Column) -> Column:
    """A raw value as the type of a listing column; an empty string is null."""
    kind = schema.kind(column)
    if isinstance(kind, T.LongType):
        return to_long(value)
    return to_double(value) if isinstance(kind, T.DoubleType) else F.nullif(value.cast("string"), F.lit(""))


def is_complete(columns: dict[str, Column] | None = None) -> Column:
    """All required fields are there; zero counts as there."""
    cols = columns or {c: F.col(c) for c in schema.REQUIRED}
    out = F.lit(True)
    for c in schema.REQUIRED:
        out = out & coerce(c, cols[c]).isNotNull()
    return out


def present(number: Column) -> Column:
    """Neither null nor zero."""
    return number.isNotNull() & (number != 0)


# text


def norm(text: Column) -> Column:
    """Lower case, any run of white space one blank; null is empty."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(text.cast("string")), r"(?U)\s+", " ")), F.lit(""))


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[а-яёa-z0-9]+"), 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for each row even inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(tokens: Column, k: int = 4) -> Column:
    """Distinct runs of k tokens in order; none for fewer tokens."""

    def runs(t: Column) -> Column:
        made = F.transform(F.sequence(F.lit(1), F.size(t) - (k - 1)), lambda i: F.array_join(F.slice(t, i, k), " "))
        return F.when(F.size(t) >= k, F.array_distinct(made)).otherwise(F.array().cast("array<string>"))

    return let(tokens, runs)


def clean_house(text: Column) -> Column:
    """Comparable house number; lists of houses and blanks are null."""
    low = F.lower(F.trim(text))
    return F.when(~low.contains(","), F.nullif(F.translate(low, "\\ ", "/"), F.lit("")))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def owner(text: Column) -> Column:
    """Normalised owner name; null for roles and blanks."""
    name = norm(text)
    return F.when(~name.isin(GENERIC_OWNERS), name)


def first_text(*texts: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def floor_pair(text: Column) -> Column:
    """Struct (floor, total) of texts like '3 из 9' or '3'."""
    both = F.regexp_extract(text, r"([0-9]+)\s*из\s*([0-9]+)", 1)
    return F.struct(
        F.nullif(F.when(both != "", both).otherwise(F.regexp_extract(text, "([0-9]+)", 1)), F.lit("")).try_cast("long").alias("floor"),
        F.nullif(F.regexp_extract(text, r"[0-9]+\s*из\s*([0-9]+)", 1), F.lit("")).try_cast("long").alias("total"),
    )


def complex_alias(href: Column) -> Column:
    return F.nullif(F.regexp_extract(href, "/complex/show/[^/]+/([^/]+)/?", 1), F.lit(""))


def set_hash(values: Column) -> Column:
    """SHA-256 of the sorted values joined by a bar; null for none."""
    return F.when(F.size(values) > 0, F.sha2(F.array_join(F.array_sort(values), "|"), 256))


# numbers and geometry


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points; null if a coordinate is."""
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(F.when(half > 1, 1.0).otherwise(half))) * (2 * EARTH_M)


def jaccard(a: Column, b: Column, least: int = LEAST_SHINGLES) -> Column:
    """Shared part of two sets; null if either has fewer than `least` members."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) >= least) & (F.size(b) >= least), shared / (F.size(a) + F.size(b) - shared))


def area_close(a: Column, b: Column, absolute: float = AREA_CLOSE[0], relative: float = AREA_CLOSE[1]) -> Column:
    """Within the larger of an absolute and a relative tolerance; missing or zero areas aren't."""
    near = F.abs(a - b) <= F.greatest(F.lit(absolute), F.least(a, b) * relative)
    return F.coalesce(present(a) & present(b) & near, F.lit(False))


def area_very_close(a: Column, b: Column) -> Column:
    return area_close(a, b, *AREA_VERY_CLOSE)


def price_close(a: Column, b: Column, tolerance: float = PRICE_CLOSE) -> Column:
    return F.coalesce(present(a) & present(b) & (F.try_divide(F.abs(a - b), F.greatest(a, b)) <= tolerance), F.lit(False))


def price_changed(old: Column, new: Column) -> Column:
    return F.abs(old - new) > PRICE_STEP


def price_m2(price: Column, area: Column) -> Column:
    return F.try_divide(price.cast("double"), area)


# dates


def own_date(text: Column) -> Column:
    """The date as written in an ISO text, in its own zone; null if unreadable."""
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.substring(text, 1, 10).try_cast("date"))


def moment(text: Column) -> Column:
    """Timestamp of an ISO text, Z or an offset or none at its end; what stands after the seconds is ignored if it is unreadable. Null for other texts."""
    dated = text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}")
    return F.when(dated, F.coalesce(F.nullif(text, F.lit("")).try_cast("timestamp"), F.substring(text, 1, 19).try_cast("timestamp")))


def month_index(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date) - 1


def month_key_index(key: Column) -> Column:
    """'2024-03' as a month number; null if it isn't one."""
    parts = F.split(key, "-")
    return F.when(key.rlike("^[0-9]{4}-[0-9]{2}$"), F.get(parts, F.lit(0)).try_cast("int") * 12 + F.get(parts, F.lit(1)).try_cast("int") - 1)


def is_recent(created: Column, now: Column, days: int = 1) -> Column:
    """Published today or up to `days` before now's date; unreadable or later dates aren't recent."""
    return F.coalesce(F.datediff(own_date(now), own_date(created)).between(0, days), F.lit(False))


def iso(ts: Column) -> Column:
    """UTC timestamp as ISO text to the second."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def before(now: str, seconds: int) -> Column:
    """ISO text of a time some seconds before now."""
    return iso(F.lit(now).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds)))


def duration_text(seconds: Column) -> Column:
    """'1h 02m' or '5m 07s'."""
    s = seconds.cast("long")
    return F.when(s >= 3600, F.format_string("%dh %02dm", F.floor(s / 3600), F.floor(s % 3600 / 60))).otherwise(F.format_string("%dm %02ds", F.floor(s / 60), s % 60))
