"""The most useful scalar functions for SQL users, as native SQL functions (no Python at run time)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalars import EARTH_M

FUNCTIONS = {
    "haversine_m(lat1 double, lon1 double, lat2 double, lon2 double) returns double": f"2 * {EARTH_M}D * asin(least(if(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2) is null, null, 1.0D), sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))",
    "norm_text(x string) returns string": r"coalesce(trim(regexp_replace(lower(x), '(?U)\\s+', ' ')), '')",
    "clean_house(x string) returns string": r"case when not contains(x, ',') then nullif(translate(lower(trim(x)), '\\ ', '/'), '') end",
    "jaccard(a array<string>, b array<string>) returns double": "size(array_intersect(a, b)) / nullif(size(array_union(a, b)), 0)",
}


def register(spark: SparkSession) -> list[str]:
    """Create them as temporary functions; returns their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {head} return {body}")
    return [head.partition("(")[0] for head in FUNCTIONS]
