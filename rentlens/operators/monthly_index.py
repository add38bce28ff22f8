"""Monthly price index: levels by date with interpolation, factors between dates, adjusted prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

LEAST_POINTS, DAYS, STALE_MONTHS = 3, 30.44, 3
#: Months that a series may leave out; more are a mistyped month, and would make a calendar that is too large to broadcast.
MOST_GAP = 1200
FACTOR_BOUNDS = (0.5, 2.0)


def levels(values: DataFrame, least: int = LEAST_POINTS) -> DataFrame:
    """(month, level) of a series (month, value): the last of a month wins, values must be positive; empty below `least` points.

    A series has a row a month, so its single-partition windows are small for any number of prices."""
    order = F.col("ordinal") if "ordinal" in values.columns else F.monotonically_increasing_id()
    good = values.withColumn("__o", order).withColumn("level", S.to_double(F.col("value"))).filter((F.col("level") > 0) & F.col("month").isNotNull())
    out = good.groupBy("month").agg(F.max_by("level", "__o").alias("level"))
    n = out.agg(F.count("*").alias("n"))
    return out.join(F.broadcast(n), F.col("n") >= least).select("month", "level")


def calendar(series: DataFrame) -> DataFrame:
    """(m, cur, nxt) for each month from the first to the last: its level and the one it moves to within the month.

    A month without a level has the straight line between its neighbours as cur, and moves to the next known level, as a known month does."""
    w = Window.orderBy("m")
    known = series.select(S.month_key_index(F.col("month")).alias("m"), "level")
    spans = known.withColumn("m1", F.lead("m").over(w)).withColumn("v1", F.lead("level").over(w))
    wide = F.col("m1") - F.col("m") > MOST_GAP
    spans = spans.withColumn("m1", F.when(wide, F.raise_error(F.concat(F.lit("the series has no month for too long after month "), F.col("m").cast("string"))).cast("int")).otherwise(F.col("m1")))
    months = spans.select("m", "level", "v1", "m1", F.explode(F.sequence(F.col("m"), F.coalesce(F.col("m1") - 1, F.col("m")))).alias("at"))
    line = F.col("level") + (F.coalesce("v1", "level") - F.col("level")) * F.coalesce(F.try_divide(F.col("at") - F.col("m"), F.col("m1") - F.col("m")), F.lit(0.0))
    return months.select(F.col("at").alias("m"), line.alias("cur"), F.coalesce("v1", "level").alias("nxt"))


def with_level(df: DataFrame, series: DataFrame, date: Column, name: str = "level") -> DataFrame:
    """df with the level at a date; before the first month and from the last on it is theirs. Null for a null date or an empty series.

    The calendar is broadcast: it has a row a month."""
    cal = calendar(series)
    ends = cal.agg(F.min("m").alias("__lo"), F.max("m").alias("__hi"))
    month = S.month_index(date)
    out = df.withColumns({"__m": month, "__d": F.dayofmonth(date)}).join(F.broadcast(ends))
    out = out.withColumn("__at", F.greatest(F.col("__lo"), F.least(F.col("__hi"), F.col("__m"))))
    out = out.join(F.broadcast(cal.withColumnsRenamed({"m": "__at", "cur": "__cur", "nxt": "__nxt"})), "__at", "left")
    share = F.least(F.lit(1.0), (F.col("__d") - 1) / DAYS)
    level = F.when(F.col("__m").isNull(), None).when((F.col("__m") <= F.col("__lo")) | (F.col("__m") >= F.col("__hi")), F.col("__cur")).otherwise(F.col("__cur") + (F.col("__nxt") - F.col("__cur")) * share)
    return out.withColumn(name, level).drop("__m", "__d", "__lo", "__hi", "__at", "__cur", "__nxt")


def guarded(factor: Column) -> Column:
    """1 for a missing factor or one out of bounds; it isn't clipped."""
    return F.coalesce(F.when(factor.between(*FACTOR_BOUNDS), factor), F.lit(1.0))


def with_factor(df: DataFrame, series: DataFrame, observed: Column, target: str, name: str = "factor") -> DataFrame:
    """df with the factor from the observed date's prices to the target date's."""
    one = with_level(df.sparkSession.range(1), series, F.lit(target).cast("date"), "__target").select("__target")
    out = with_level(df, series, observed, "__level").join(F.broadcast(one))
    return out.withColumn(name, guarded(F.try_divide("__target", F.nullif("__level", F.lit(0.0))))).drop("__level", "__target")


def adjusted(df: DataFrame, series: DataFrame, price: Column, observed: Column, target: str) -> DataFrame:
    """df with factor and adjusted_price; junk prices are null."""
    return with_factor(df, series, observed, target).withColumn("adjusted_price", S.to_double(price) * F.col("factor"))


def describe(series: DataFrame) -> DataFrame:
    """One row: first and last month, points, growth in percent."""
    sums = series.agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count("*").alias("points"), F.min_by("level", "month").alias("a"), F.max_by("level", "month").alias("b"))
    return sums.select("first_month", "last_month", "points", ((F.try_divide("b", "a") - 1) * 100).alias("growth"))


def is_stale(series: DataFrame, date: str) -> DataFrame:
    """One row: whether the date is over STALE_MONTHS past the last month."""
    last = series.agg(F.max(S.month_key_index(F.col("month"))).alias("m"))
    return last.select(over_stale(S.month_index(F.lit(date).cast("date")), F.col("m")).alias("stale"))


def over_stale(month: Column, last: Column) -> Column:
    """Whether a month number is over STALE_MONTHS past the last one."""
    return F.coalesce(month - last > STALE_MONTHS, F.lit(False))


def rows(series: DataFrame) -> DataFrame:
    return series.orderBy("month").select("month", "level")
