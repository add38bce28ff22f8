"""Adapters that make listings, price observations and the like from the test tables.

Each is a list of SQL expressions that Spark and DuckDB read alike, so queries and their oracles share inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import table

BASE = {
    "doc_id": "doc_id",
    "full_description": "text",
    "bld": "(case lang when 'de' then 1 when 'en' then 2 when 'es' then 3 when 'fr' then 4 else 5 end) * 20 + cast(floor(n_chars / cast(2000 as double)) as bigint)",
    "rb": "cast(floor(n_chars / cast(3000 as double)) as bigint)",
    "sqm": "15 + cast(floor(n_chars / cast(200 as double)) as bigint)",
    "fb": "cast(floor(n_chars / cast(800 as double)) as bigint)",
    "ob": "cast(floor(doc_id / cast(8 as double)) as bigint)",
}
_DAY = "lpad(cast(1 + doc_id % 30 as string), 2, '0')"
_F = "doc_id % 20"
_UNPLACED = "doc_id % 47 = 11"
LISTING = {
    "id": "cast(doc_id as string)",
    "doc_id": "doc_id",
    "url": "concat('https://listing.example/', cast(doc_id as string))",
    "lat_u": f"case when {_UNPLACED} then null else 51000000 + bld * 10000 + (doc_id % 3) * 100 end",
    "lon_u": f"case when {_UNPLACED} then null else 71400000 + bld * 10000 + (doc_id % 2) * 100 end",
    "latitude": f"case when {_UNPLACED} then null else cast(51000000 + bld * 10000 + (doc_id % 3) * 100 as double) / 1000000 end",
    "longitude": f"case when {_UNPLACED} then null else cast(71400000 + bld * 10000 + (doc_id % 2) * 100 as double) / 1000000 end",
    "rooms": "1 + rb % 4",
    "square_m2": "case when doc_id % 41 = 7 then null else cast(sqm as double) end",
    "floor": "case when doc_id % 43 = 9 then null else 1 + fb % 9 end",
    "price": "sqm * (4000 + (doc_id % 5) * 150)",
    "owner_name": "case when doc_id % 4 = 0 then concat('owner', cast(ob % 6 as string)) else 'Хозяин' end",
    "status": "case when doc_id % 10 = 0 then 'missing' else 'active' end",
    "full_description": "full_description",
    "city": "'Astana'",
    "storage": "'live'",
    "street": "case doc_id % 6 when 0 then concat(' Улица  ', cast(bld % 7 as string)) when 1 then '' end",
    "house_num": "case when doc_id % 7 = 3 then '9/1' when doc_id % 7 = 5 then '9/1,_9/2' end",
    "complex_name": "case doc_id % 5 when 2 then concat('ЖК  ', cast(bld as string)) when 3 then '' end",
    "complex_alias": "case when doc_id % 5 = 3 then concat('alias-', cast(bld as string)) end",
    "created_at": f"concat('2024-01-', {_DAY})",
    "scraped_at": f"concat('2024-02-', lpad(cast(1 + doc_id % 28 as string), 2, '0'), 'T00:00:00+00:00')",
    "first_seen_at": "'2024-01-01T00:00:00+00:00'",
    "last_seen_at": f"concat('2024-01-', {_DAY}, 'T12:00:00+00:00')",
}
#: The listing columns with a fault by doc_id modulo 20; 11 and 12 must still pass.
FAULTS = {
    "price": f"case {_F} when 1 then null when 3 then 0 when 7 then 1 else price end",
    "rooms": f"case when {_F} = 2 then null else rooms end",
    "square_m2": f"case {_F} when 4 then 0 when 5 then 9 when 6 then 500 else square_m2 end",
    "latitude": f"case {_F} when 8 then 10 when 11 then null else latitude end",
    "city": f"case {_F} when 9 then 'Other' when 12 then '' else city end",
    "storage": f"case when {_F} = 10 then 'archive' else storage end",
}


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{e} as {n}" for n, e in columns.items()]


def listings(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """Listings made from documents."""
    df = table(spark, sf_dir, "documents").selectExpr(*_select(BASE)).selectExpr(*_select(LISTING))
    return df.selectExpr(*_select({c: FAULTS.get(c, c) for c in LISTING})) if faults else df


def listings_sql(faults: bool = False) -> str:
    """The same rows as a DuckDB query."""
    base = f"select {', '.join(_select(BASE))} from documents"
    out = f"select {', '.join(_select(LISTING))} from ({base})"
    return f"select {', '.join(_select({c: FAULTS.get(c, c) for c in LISTING}))} from ({out})" if faults else out


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations (id, price, observed_at, seq) made from purchases."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(F.col("user_id").alias("id"), F.col("value").alias("price"), F.col("ts").alias("observed_at"), F.col("event_id").alias("seq"))


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price history (id, price, observed_at as text): the observations of the first half of the month whose id isn't a multiple of 4."""
    p = observations(spark, sf_dir).filter("observed_at < '2024-01-16' and id % 4 <> 0")
    at = F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return p.groupBy(F.col("id").cast("string").alias("id"), at.alias("observed_at")).agg(F.max_by("price", "seq").alias("price")).select("id", "price", "observed_at")


OBSERVATIONS_SQL = "select user_id as id, value as price, ts as observed_at, event_id as seq from events where event_type = 'purchase'"

RECORDED_SQL = f"""select cast(id as varchar) as id, arg_max(price, seq) as price, strftime(observed_at, '%Y-%m-%dT%H:%M:%S+00:00') as observed_at
from ({OBSERVATIONS_SQL}) where observed_at < '2024-01-16' and id % 4 <> 0 group by 1, 3"""

#: An index series with a gap, a jump and an end, so that every branch occurs.
SERIES = [("1996-01", 100.0), ("1996-02", 110.0), ("1996-05", 140.0), ("1997-01", 150.0), ("2001-01", 400.0)]


def series(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, m, str(v)) for i, (m, v) in enumerate(SERIES)], "ordinal int, month string, value string")
