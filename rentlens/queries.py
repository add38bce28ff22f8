"""The library's queries on the test tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as X
from . import schema
from .functions import scalars as S
from .operators import close, digest, history, monthly_index, quality, registry, resolve, segments
from .plans import publish, serve
from .session import cut, own_dir, table
from .sources import feed, keyed, pages, sinks, state, tables
from .streaming import feeds

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
L, LF, P = X.listings_sql(), X.listings_sql(faults=True), X.OBSERVATIONS_SQL


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# scalars


@query("""
with t as (select p_partkey, case p_partkey % 8 when 0 then '1 200' when 1 then '12,5' when 2 then '-12.9' when 3 then ''
  when 4 then 'abc' when 5 then '1d' when 6 then cast(p_retailprice as decimal(12,2))::varchar else ' 58.5 ' end as raw from part)
select p_partkey,
  cast(trunc(case when regexp_full_match(replace(raw, ' ', ''), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)') then cast(replace(raw, ' ', '') as double) end) as bigint) as as_long,
  case when regexp_full_match(replace(replace(raw, ' ', ''), ',', '.'), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)') then cast(replace(replace(raw, ' ', ''), ',', '.') as double) end as as_double,
  case when regexp_full_match(replace(trim(raw), ',', '.'), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)') then cast(replace(trim(raw), ',', '.') as double) end as as_number
from t""")
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    k = F.col("p_partkey") % 8
    raw = F.when(k == 0, "1 200").when(k == 1, "12,5").when(k == 2, "-12.9").when(k == 3, "").when(k == 4, "abc").when(k == 5, "1d").when(k == 6, price).otherwise(" 58.5 ")
    df = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    return df.select("p_partkey", S.to_long(F.col("raw")).alias("as_long"), S.to_double(F.col("raw")).alias("as_double"), S.to_number(F.col("raw")).alias("as_number"))


@query("""
select doc_id, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) as normed, len(regexp_extract_all(lower(text), '[а-яёa-z0-9]+')) as n_tokens from documents""")
def norm_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", S.norm(F.col("text")).alias("normed"), F.size(S.word_list(F.col("text"))).cast("long").alias("n_tokens"))


@query("""
with t as (select doc_id, regexp_extract_all(lower(text), '[а-яёa-z0-9]+') as w from documents)
select doc_id, case when len(w) < 4 then 0 else len(list_distinct([array_to_string(w[i:i+3], ' ') for i in range(1, len(w) - 2)])) end as n_shingles from t""")
def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select("doc_id", S.word_list(F.col("text")).alias("w"))
    return words.select("doc_id", F.size(S.shingles(F.col("w"))).cast("long").alias("n_shingles"))


@query(f"""
select id, case when house_num like '%,%' then null else replace(replace(lower(trim(house_num)), '\\', '/'), ' ', '') end as house,
  regexp_replace(url, '[^0-9]', '', 'g') as digits, case when lower(owner_name) <> 'хозяин' then lower(owner_name) end as owner from ({L})""")
def text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.listings(spark, sf_dir).select("id", S.clean_house(F.col("house_num")).alias("house"), S.digits_only(F.col("url")).alias("digits"), S.owner(F.col("owner_name")).alias("owner"))


_FLOORS = "case doc_id % 4 when 0 then concat(cast(floor as string), ' из 9') when 1 then cast(floor as string) when 2 then 'цоколь' end"


@query(f"select id, cast(floor as bigint) as f, case when doc_id % 4 = 0 and floor is not null then 9 end::bigint as total from ({L}) where doc_id % 4 < 2 union all select id, null, null from ({L}) where doc_id % 4 >= 2")
def floor_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = X.listings(spark, sf_dir).selectExpr("id", f"{_FLOORS} as t")
    return df.select("id", S.floor_pair(F.col("t")).alias("p")).select("id", F.col("p.floor").alias("f"), "p.total")


@query(f"""
with l as (select *, case when lower(owner_name) <> 'хозяин' then lower(owner_name) end as own from ({L}))
select a.id as a, b.id as b, round(2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.latitude - a.latitude) / 2), 2)
  + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2))), 3) as metres
from l a join l b on a.own = b.own and a.rooms = b.rooms and a.floor = b.floor and a.square_m2 = b.square_m2 and a.doc_id < b.doc_id""")
def haversine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of listings with an owner of their own that have the same owner, rooms, floor and area."""
    same = ["own", "rooms", "floor", "square_m2"]
    df = X.listings(spark, sf_dir).select("id", "doc_id", S.owner(F.col("owner_name")).alias("own"), *same[1:], "latitude", "longitude")
    j = df.alias("a").join(df.select("id", "doc_id", *same, "latitude", "longitude").alias("b"), same).filter("a.doc_id < b.doc_id")
    metres = S.haversine_m(F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude"))
    return j.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.round(metres, 3).alias("metres"))


@query(f"select doc_id, sha256(concat_ws('|', url, concat(url, '/2'))) as photos, case when doc_id % 30 in (28, 29) then true else false end as recent from ({L})")
def hashes_and_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = X.listings(spark, sf_dir)
    return df.select("doc_id", S.set_hash(F.array(F.concat("url", F.lit("/2")), F.col("url"))).alias("photos"), S.is_recent(F.col("created_at"), F.lit("2024-01-30T08:00:00+00:00")).alias("recent"))


# quality

_REASON = """case when price is null or rooms is null or square_m2 is null then 'incomplete' when storage <> '' and storage <> 'live' then 'storage' when price <= 0 then 'price'
  when square_m2 <= 0 then 'area' when square_m2 not between 15 and 400 then 'area_bounds' when price / square_m2 not between 1500 and 40000 then 'price_m2_bounds'
  when latitude is not null and longitude is not null and not (latitude between 50.5 and 52.0 and longitude between 70.5 and 72.5) then 'outside'
  when city <> '' and lower(city) not in ('astana') then 'city' end"""


@query(f"select id, {_REASON} as reason from ({LF})")
def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject(X.listings(spark, sf_dir, faults=True)).select("id", "reason")


@query(f"select {_REASON} as reason, count(*) as n from ({LF}) where {_REASON} is not null group by 1")
def quality_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.histogram(quality.reject(X.listings(spark, sf_dir, faults=True)))


@query(f"select count(*) as total, count({_REASON}) as rejected, count({_REASON}) / count(*) as rate, count({_REASON}) > 0.1 * count(*) as alarm from ({LF})")
def reject_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject_rate(quality.reject(X.listings(spark, sf_dir, faults=True)))


@query(f"""
select count(*) as total, sum(case when status = 'active' then 1 else 0 end)::bigint as active, sum(case when status = 'missing' then 1 else 0 end)::bigint as missing,
  sum(case when price is not null and rooms is not null and square_m2 is not null then 1 else 0 end)::bigint as complete from ({LF})""")
def registry_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.stats(X.listings(spark, sf_dir, faults=True))


# registry


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the listings as stored state."""
    return registry.coerced(X.listings(spark, sf_dir).filter("doc_id % 3 <> 0"))


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = table(spark, sf_dir, "events").filter("event_type = 'error'")
    return registry.count_failures(errors.select(F.col("user_id").cast("string").alias("id"), F.col("props").alias("error"), F.col("ts").alias("at")))


@query("select cast(user_id as varchar) as id, count(*) as attempts, arg_max(props, ts) as last_error, max(ts) as last_attempt_at from events where event_type = 'error' group by user_id")
def failure_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir)


_ATTEMPTS = "select cast(user_id as varchar) as id, count(*) as attempts from events where event_type = 'error' group by user_id"


@query(f"select id from ({_ATTEMPTS}) where attempts >= 4")
def gave_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.gave_up(_failures(spark, sf_dir))


@query(f"select l.id from ({LF}) l left join ({_ATTEMPTS}) f on f.id = l.id where (price is null or rooms is null or square_m2 is null) and coalesce(attempts, 0) < 4")
def refetch_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.refetch_queue(X.listings(spark, sf_dir, faults=True), _failures(spark, sf_dir))


@query(f"""
select l.id, case when l.doc_id % 3 = 0 then 'new' when (price is null or rooms is null or square_m2 is null) and coalesce(attempts, 0) < 4 then 'refetch' else 'price_only' end as work
from ({LF}) l left join ({_ATTEMPTS}) f on f.id = l.id""")
def split_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = X.listings(spark, sf_dir, faults=True)
    return registry.split_work(df, df.filter("doc_id % 3 <> 0"), _failures(spark, sf_dir))


_BATCH = f"select * exclude (price), price + 1000 as price, case when doc_id % 4 = 1 then null else city end as new_city from ({L}) where doc_id % 2 = 0"


@query(f"""
with o as (select * from ({L}) where doc_id % 3 <> 0), n as ({_BATCH})
select coalesce(n.id, o.id) as id, coalesce(n.price, o.price)::bigint as price, coalesce(n.owner_name, o.owner_name) as owner_name,
  case when n.id is not null then 'active' else o.status end as status, case when n.id is not null then '2024-03-01T00:00:00+00:00' else o.last_seen_at end as last_seen_at,
  case when o.id is not null then o.first_seen_at else '2024-03-01T00:00:00+00:00' end as first_seen_at, coalesce(n.house_num, o.house_num) as house_num
from o full join n on o.id = n.id""")
def upsert_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = X.listings(spark, sf_dir).filter("doc_id % 2 = 0").withColumn("price", F.col("price") + 1000)
    out = registry.upsert_full(_state(spark, sf_dir), batch, "2024-03-01T00:00:00+00:00")
    return out.select("id", "price", "owner_name", "status", "last_seen_at", "first_seen_at", "house_num")


@query(f"""
select l.id, coalesce(cast(p.price as bigint), l.price)::bigint as price, case when p.id is not null then '2024-03-01T00:00:00+00:00' else l.last_seen_at end as last_seen_at,
  case when p.id is not null then 'active' else l.status end as status
from (select * from ({L}) where doc_id % 3 <> 0) l left join (select cast(id as varchar) as id, trunc(arg_max(price, seq)) as price from ({P}) group by 1) p on p.id = l.id""")
def price_only_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = X.observations(spark, sf_dir).groupBy(F.col("id").cast("string").alias("id")).agg(F.max_by("price", "seq").alias("price"))
    return registry.update_prices(_state(spark, sf_dir), prices, "2024-03-01T00:00:00+00:00").select("id", "price", "last_seen_at", "status")


@query(f"""
select l.id, case when s.id is not null then '2024-03-01T00:00:00+00:00' else l.last_seen_at end as last_seen_at, case when s.id is not null then 'active' else l.status end as status
from (select * from ({L}) where doc_id % 3 <> 0) l left join (select distinct cast(doc_id as varchar) as id from labels) s on s.id = l.id""")
def touch_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return registry.touch_seen(_state(spark, sf_dir), seen, "2024-03-01T00:00:00+00:00").select("id", "last_seen_at", "status")


@query(f"""
select id, status = 'active' and id not in (select cast(doc_id as varchar) from labels) and last_seen_at < '2024-01-20T06:00:00+00:00' as newly_missing,
  case when status = 'missing' or (id not in (select cast(doc_id as varchar) from labels) and last_seen_at < '2024-01-20T06:00:00+00:00') then 'missing' else 'active' end as status
from ({L}) where doc_id % 3 <> 0""")
def mark_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return registry.mark_missing(_state(spark, sf_dir), seen, "2024-01-20T12:00:00+00:00", complete=True).select("id", "newly_missing", "status")


@query(f"""
select id, case when doc_id % 3 <> 0 then status else 'missing' end as status, case when doc_id % 3 <> 0 then last_seen_at else scraped_at end as last_seen_at from ({L})""")
def seed_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.seed(_state(spark, sf_dir), X.listings(spark, sf_dir), "2024-03-01T00:00:00+00:00").select("id", "status", "last_seen_at")


@query(f"""
select id, case when doc_id % 2 = 0 then 'active' else status end as status, case when doc_id % 2 = 0 then '2024-01-01T00:00:00+00:00' else last_seen_at end as last_seen_at
from ({L}) where doc_id % 3 <> 0 or doc_id % 2 = 0""")
def import_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.listings(spark, sf_dir).filter("doc_id % 2 = 0").drop("status", "last_seen_at")
    return registry.import_rows(_state(spark, sf_dir), rows, "2024-03-01T00:00:00+00:00").select("id", "status", "last_seen_at")


@query("select user_id, max(event_id) as event_id, arg_max(value, event_id) as value from events group by user_id")
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latest_wins(table(spark, sf_dir, "events"), "user_id", F.col("event_id")).select("user_id", "event_id", "value")


@query("select user_id, min(event_id) as event_id, arg_min(value, event_id) as value from events group by user_id")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.first_wins(table(spark, sf_dir, "events"), "user_id", F.col("event_id")).select("user_id", "event_id", "value")


_STREAK = "select *, sum(case when event_type <> 'error' then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as island from events"


@query(f"select user_id, island::bigint as island, count(*) as length from ({_STREAK}) where event_type = 'error' group by 1, 2")
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("event_type") != "error").alias("good"))
    return registry.streaks(e, "user_id", ["ts", "event_id"])


def _windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = X.observations(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    last = lambda df: df.groupBy("id").agg(F.max_by("price", "seq").alias("price"))
    return last(p.filter("observed_at >= '2024-01-16' and cast(id as bigint) % 5 <> 1")), last(p.filter("observed_at < '2024-01-16' and cast(id as bigint) % 5 <> 2"))


_WINDOW = f"select cast(id as varchar) as id, arg_max(price, seq) as price from ({P}) where observed_at >= '2024-01-16' and id % 5 <> 1 group by 1"
_KNOWN = f"select cast(id as varchar) as id, arg_max(price, seq) as price from ({P}) where observed_at < '2024-01-16' and id % 5 <> 2 group by 1"


@query(f"""
select w.id, case when k.id is null then 'new' else 'price_drop' end as reason, w.price, k.price as old_price from ({_WINDOW}) w left join ({_KNOWN}) k on k.id = w.id
where (k.id is null and cast(w.id as bigint) % 7 <> 0) or w.price < k.price""")
def window_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    window, known = _windows(spark, sf_dir)
    return registry.window_diff(window, known, window.filter("cast(id as bigint) % 7 = 0"))


@query(f"""
select w.id, case when cast(w.id as bigint) % 6 = 0 then k.price else w.price end as price from ({_WINDOW}) w left join ({_KNOWN}) k on k.id = w.id
where cast(w.id as bigint) % 6 <> 0 or k.id is not null""")
def window_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    window, known = _windows(spark, sf_dir)
    return registry.window_state(window, known, window.filter("cast(id as bigint) % 6 = 0"), complete=True)


# history

_LAG = f"select *, lag(price) over (partition by id order by observed_at, seq) as old_price from ({P})"
_POINTS = f"select *, case when old_price is null then 'start' when price < old_price then 'drop' else 'rise' end as kind from ({_LAG}) where old_price is null or abs(price - old_price) > 0.01"


@query(f"select id, seq, price, old_price, kind from ({_POINTS})")
def price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.compress(X.observations(spark, sf_dir), order=("observed_at", "seq")).select("id", "seq", "price", "old_price", "kind")


_NEWP = f"select cast(id as varchar) as id, trunc(arg_max(price, seq)) as new from ({P}) group by 1"


_CHANGES = f"""
with s as (select id, price::double as price, last_seen_at from ({L}) where doc_id % 3 <> 0), n as ({_NEWP}), h as ({X.RECORDED_SQL}),
last as (select id, arg_max(price, observed_at) as last from h group by id),
j as (select n.id, n.new, s.price as old, s.last_seen_at, last from n left join s on s.id = n.id left join last on last.id = n.id),
points as (
  select id, old as price, last_seen_at as observed_at from j where old is not null and last is null union all
  select id, new, '2024-03-01T00:00:00+00:00' from j where case when old is null then last is null or abs(last - new) > 0.01 else abs(old - new) > 0.01 end)"""


@query(f"{_CHANGES} select id, price, observed_at from points p where not exists (from h where h.id = p.id and h.observed_at = p.observed_at)")
def price_history_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir)[0]


@query(f"{_CHANGES} select id, 'price_drop' as reason, new as price, old as old_price, '2024-03-01T00:00:00+00:00' as observed_at from j where new < old - 0.01")
def price_drop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir)[1]


def _changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    prices = X.observations(spark, sf_dir).groupBy(F.col("id").cast("string").alias("id")).agg(F.max_by("price", "seq").alias("price"))
    return history.price_changes(_state(spark, sf_dir), X.recorded(spark, sf_dir), prices, "2024-03-01T00:00:00+00:00")


@query(f"{_CHANGES} select 500 + row_number() over (order by id) as event_id, id, new as price from j where new < old - 0.01")
def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.numbered(_changes(spark, sf_dir)[1], 500).select("event_id", "id", "price")


@query(f"""
select id, 'new' as reason, price::double as price, cast(null as double) as old_price, '2024-01-28T08:00:00+00:00' as observed_at from ({LF})
where doc_id % 3 = 0 and price is not null and rooms is not null and square_m2 is not null and created_at in ('2024-01-27', '2024-01-28')""")
def new_listing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.new_events(_state(spark, sf_dir), X.listings(spark, sf_dir, faults=True), "2024-01-28T08:00:00+00:00")


_DROPS = f"select seq as event_id, id, price, old_price from ({_POINTS}) where kind = 'drop'"


@query(f"select * from ({_DROPS}) where event_id > 1000 order by event_id limit 200")
def changes_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    drops = history.compress(X.observations(spark, sf_dir), order=("observed_at", "seq")).filter("kind = 'drop'")
    return history.changes_page(drops.select(F.col("seq").alias("event_id"), "id", "price", "old_price"), since=1000, limit=200)


@query(f"""
with probes as (select event_id, user_id as id, ts as at from events where event_type = 'view')
select event_id, p.id, h.price from probes p asof left join (select id, observed_at, arg_max(price, seq) as price from ({P}) group by 1, 2) h on h.id = p.id and p.at >= h.observed_at""")
def price_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    probes = table(spark, sf_dir, "events").filter("event_type = 'view'").select("event_id", F.col("user_id").alias("id"), F.col("ts").alias("at"))
    prices = X.observations(spark, sf_dir).groupBy("id", "observed_at").agg(F.max_by("price", "seq").alias("price"))
    return history.price_asof(probes, prices).select("event_id", "id", "price")


@query(f"select id, price, square_m2 from ({L}) order by doc_id limit 100 offset 50")
def table_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of a stored table with gapless numbers."""
    path = own_dir(spark, "numbered")
    segments.numbered(X.listings(spark, sf_dir), ["doc_id"], "ordinal").write.parquet(f"{path}/t")
    return serve.page(spark.read.parquet(f"{path}/t"), limit=100, offset=50).select("id", "price", "square_m2")


@query(f"select id, price, status from ({L}) where id = '42'")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.point(X.listings(spark, sf_dir), "42").select("id", "price", "status")


# index

_SERIES = ", ".join(f"('{m}', {v})" for m, v in X.SERIES)
_CAL = f"""
known as (select cast(month[1:4] as int) * 12 + cast(month[6:7] as int) - 1 as m, level from (values {_SERIES}) t(month, level)),
spans as (select m, level, lead(m) over (order by m) as m1, lead(level) over (order by m) as v1 from known),
cal as (select unnest(generate_series(m, coalesce(m1 - 1, m))) as mm, m, level, m1, v1 from spans),
calendar as (select mm as m, level + (coalesce(v1, level) - level) * coalesce((mm - m)::double / nullif(m1 - m, 0), 0) as cur, coalesce(v1, level) as nxt from cal),
ends as (select min(m) as lo, max(m) as hi from calendar),
od as (select o_orderkey, o_totalprice, cast(o_orderdate as date) as d, year(o_orderdate) * 12 + month(o_orderdate) - 1 as m from orders),
lev as (select o_orderkey, o_totalprice, case when od.m <= lo or od.m >= hi then cur else cur + (nxt - cur) * least(1.0, (day(d) - 1) / 30.44) end as level
  from od, ends, calendar where calendar.m = greatest(lo, least(hi, od.m)))"""


@query(f"with {_CAL} select o_orderkey, round(level, 6) as level from lev")
def index_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return monthly_index.with_level(o, monthly_index.levels(X.series(spark)), F.col("d")).select("o_orderkey", F.round("level", 6).alias("level"))


@query(f"""
with {_CAL}, target as (select cur + (nxt - cur) * least(1.0, 14 / 30.44) as t from calendar where m = 2000 * 12 + 5),
f as (select o_orderkey, o_totalprice, case when t / level between 0.5 and 2 then t / level else 1 end as factor from lev, target)
select o_orderkey, round(factor, 6) as factor, round(o_totalprice * factor, 2) as adjusted_price from f""")
def adjusted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("d"))
    out = monthly_index.with_factor(o, monthly_index.levels(X.series(spark)), F.col("d"), "2000-06-15")
    return out.select("o_orderkey", F.round("factor", 6).alias("factor"), F.round(F.col("o_totalprice") * F.col("factor"), 2).alias("adjusted_price"))


_MONTHS = "select strftime(cast(o_orderdate as date), '%Y-%m') as month, max(o_totalprice) as level from orders group by 1"


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series of the largest order of each month."""
    month = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM")
    return table(spark, sf_dir, "orders").groupBy(month.alias("month")).agg(F.max("o_totalprice").cast("string").alias("value")).withColumn("ordinal", F.col("month"))


@query(f"with s as ({_MONTHS}) select min(month) as first_month, max(month) as last_month, count(*) as points, (arg_max(level, month) / arg_min(level, month) - 1) * 100 as growth from s")
def index_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_index.describe(monthly_index.levels(_monthly(spark, sf_dir)))


# resolution

_AREA = "coalesce(cast(cast(sq as bigint) as varchar), '~')"
_KINDS = {
    "geo4": "(lat_u // 100) || ':' || (lon_u // 100)", "geo3_area": f"(lat_u // 1000) || ':' || (lon_u // 1000) || '|' || {_AREA}", "geo3_rooms": "(lat_u // 1000) || ':' || (lon_u // 1000) || '|' || rooms",
    "street_area": f"street_n || '|' || {_AREA}", "street_rooms": "street_n || '|' || rooms", "complex_area": f"complex_n || '|' || {_AREA}", "complex_rooms": "complex_n || '|' || rooms",
    "owner_area": f"owner_n || '|' || {_AREA}", "owner_rooms": "owner_n || '|' || rooms",
}


def _prep(rows: str) -> str:
    return f"""select id, square_m2 as sq, price as price_n, floor as floor_n, rooms, lat_u, lon_u, latitude as lat, longitude as lon,
  case when house_num not like '%,%' then house_num end as house, case when lower(owner_name) <> 'хозяин' then lower(owner_name) end as owner_n,
  nullif(trim(replace(lower(street), '  ', ' ')), '') as street_n, coalesce(nullif(replace(lower(complex_name), '  ', ' '), ''), nullif(lower(complex_alias), '')) as complex_n,
  full_description, created_at, scraped_at from ({rows})"""


def _keys(rows: str) -> str:
    return f"""
prep as ({_prep(rows)}),
keys as (
  select id, kind, key, rooms || '|' || {_AREA} || '|' || coalesce(cast(floor_n as varchar), '~') as refine from (
    select *, unnest([{", ".join(f"'{k}'" for k in _KINDS)}]) as kind, unnest([{", ".join(_KINDS.values())}]) as key from prep) where key is not null)"""


_KEYS = _keys(L)


def _parts(rows: str) -> str:
    return f"""{_keys(rows)},
whole as (select kind, key, count(*) as n from keys group by 1, 2 having count(*) > 1),
parts0 as (select k.id, k.kind, k.key, case when n <= 60 then '' else refine end as part from keys k join whole w on w.kind = k.kind and w.key = k.key),
parts as (select *, count(*) over (partition by kind, key, part) as size from parts0)"""


def _pairs(rows: str) -> str:
    return f"{_parts(rows)}, pairs as (select distinct a.id as a, b.id as b from parts a join parts b on a.kind = b.kind and a.key = b.key and a.part = b.part and a.id < b.id where a.size between 2 and 60)"


_PARTS, _PAIRS = _parts(L), _pairs(L)


@query(f"with {_KEYS} select id, kind, key from keys")
def block_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.block_keys(resolve.prepare(X.listings(spark, sf_dir))).select("id", "kind", "key")


@query(f"with {_PARTS} select kind, key, part, count(*) as size from parts group by 1, 2, 3")
def block_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = resolve.blocks(resolve.block_keys(resolve.prepare(X.listings(spark, sf_dir))))
    return parts.groupBy("kind", "key", "part").agg(F.count("*").alias("size"))


@query(f"with {_PARTS} select count(distinct (kind, key, part)) as skipped_blocks, count(*) as skipped_rows from parts where size > 60")
def skipped_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.skipped(resolve.blocks(resolve.block_keys(resolve.prepare(X.listings(spark, sf_dir)))))


@query(f"with {_PAIRS} select a, b from pairs")
def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.candidate_pairs(resolve.blocks(resolve.block_keys(resolve.prepare(X.listings(spark, sf_dir)))))


def _why(rows: str) -> str:
    return f"""{_pairs(rows)},
sh as (select id, case when len(w) < 4 then [] else list_distinct([array_to_string(w[i:i+3], ' ') for i in range(1, len(w) - 2)]) end as s
  from (select id, regexp_extract_all(lower(full_description), '[а-яёa-z0-9]+') as w from prep)),
base as (select p.a, p.b, case when x.house <> y.house then 'house'
    when not coalesce(2 * 6371000.0 * asin(sqrt(pow(sin(radians(y.lat - x.lat) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lon - x.lon) / 2), 2))) <= 30, false) then 'distance'
    when x.rooms <> y.rooms then 'rooms' when not coalesce(abs(x.sq - y.sq) <= greatest(3.0, 0.08 * least(x.sq, y.sq)), false) then 'area' when x.floor_n is null or y.floor_n is null then 'floor_unknown'
    when x.owner_n = y.owner_n and x.floor_n = y.floor_n and abs(x.sq - y.sq) <= greatest(2.0, 0.04 * least(x.sq, y.sq)) then 'A_owner'
    when x.owner_n = y.owner_n and x.floor_n = y.floor_n then 'owner_area' when x.owner_n = y.owner_n then 'owner_floor' when x.floor_n <> y.floor_n then 'floor' end as why,
    abs(x.price_n - y.price_n) / greatest(x.price_n, y.price_n) <= 0.02 and abs(x.sq - y.sq) <= greatest(2.0, 0.04 * least(x.sq, y.sq)) as firm
  from pairs p join prep x on x.id = p.a join prep y on y.id = p.b),
open_ as (select a, b, firm, len(list_intersect(x.s, y.s)) as i, len(x.s) as n, len(y.s) as m from base join sh x on x.id = a join sh y on y.id = b where why is null),
final as (select a, b, why from base where why is not null union all
  select a, b, case when n >= 8 and m >= 8 and i / (n + m - i) >= 0.35 then 'B_text' when firm then 'B_price' else 'unconfirmed' end from open_)"""


# Greedy cliques, one node after the other in rank order; grp is [node, members...] of the step, used what all steps took.
def _groups(rows: str) -> str:
    return f"""{_why(rows)},
hits as (select a, b from final where why in ('A_owner', 'B_text', 'B_price')),
ends as (select a as n, b as m from hits union all select b, a from hits),
deg as (select n, count(*) as d, list(m) as near from ends group by n),
ranked as (select n, near, row_number() over (order by d desc, md5(n), n) as r from deg),
steps as (select x.n, x.r, list([struct_pack(id := y.n, near := y.near)] order by y.r) as cands from ranked x join ends e on e.n = x.n join ranked y on y.n = e.m group by x.n, x.r),
walk(r, used, grp) as (
  select 0::bigint, []::varchar[], []::varchar[] union all
  select s.r, list_concat(w.used, s.grp), s.grp from walk w, lateral (
    select t.r, case when list_contains(w.used, t.n) then [] else list_transform(
      list_reduce(list_filter(t.cands, lambda c: not list_contains(w.used, c[1].id)),
        lambda acc, c: case when list_has_all(c[1].near, list_transform(acc, lambda x: x.id)) then list_concat(acc, c) else acc end,
        [struct_pack(id := t.n, near := []::varchar[])]), lambda x: x.id) end as found,
      case when len(found) > 1 then found else [] end as grp from steps t where t.r = w.r + 1) s),
members as (select grp[1] as clique, unnest(grp) as id, generate_subscripts(grp, 1) - 1 as place from walk where len(grp) > 1),
dated as (select m.*, coalesce(created_at, '') as created, coalesce(scraped_at, '') as scraped from members m join prep using (id)),
groups as (select clique, id, row_number() over (partition by clique order by created desc, scraped desc, place) = 1 as keep from dated)"""


_WHY = _why(L)


@query(f"with {_WHY} select a, b, why in ('A_owner', 'B_text', 'B_price') as ok, case when why in ('A_owner', 'B_text', 'B_price') then why[1] end as track, why from final")
def pair_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = cut(resolve.prepare(X.listings(spark, sf_dir)))
    return resolve.decisions(resolve.candidate_pairs(resolve.blocks(resolve.block_keys(prepared)), located=True), prepared)


@query(f"with {_WHY} select why, count(*) as n from final group by 1")
def decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_decisions(spark, sf_dir).groupBy("why").agg(F.count("*").alias("n"))


@query(f"with recursive {_groups(L)} select clique, id, keep from groups")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = cut(resolve.prepare(X.listings(spark, sf_dir)))
    hits = resolve.decisions(resolve.candidate_pairs(resolve.blocks(resolve.block_keys(prepared)), located=True), prepared).filter("ok")
    return resolve.survivors(resolve.cliques(hits), prepared)


_GOOD = f"select * from ({LF}) where ({_REASON}) is null"


@query(f"with recursive {_groups(_GOOD)} select id, price, square_m2, rooms, floor, created_at from ({_GOOD}) l where not exists (from groups g where g.id = l.id and not keep)")
def er_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: accepted listings without duplicates."""
    kept, _ = publish.curate(X.listings(spark, sf_dir, faults=True))
    return kept.select("id", "price", "square_m2", "rooms", "floor", "created_at")


@query(f"""
with recursive {_groups(L)} select (select count(*) from ({L})) as total, (select count(*) from pairs) as candidate_pairs, (select count(distinct clique) from groups) as groups,
  (select count(*) from groups where not keep) as dropped, (select count(distinct (kind, key, part)) from parts where size > 60) as skipped_blocks, (select count(*) from parts where size > 60) as skipped_rows""")
def er_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.dedupe(X.listings(spark, sf_dir))[1]


@query(f"""
with recursive {_groups(L)}, n as (select (select count(*) from ({L})) as total, (select count(*) from groups where not keep) as dropped),
told as (select g.clique, k.id as stays, string_agg(g.id || ' (' || f.why || ')', ', ' order by g.id) as goes from groups g join groups k on k.clique = g.clique and k.keep and not g.keep
  join final f on f.a = least(g.id, k.id) and f.b = greatest(g.id, k.id) group by 1, 2)
select 'count' as kind, 'total' as key, total::varchar as text from n union all select 'count', 'candidate_pairs', (select count(*) from pairs)::varchar union all
select 'count', 'groups', (select count(distinct clique) from groups)::varchar union all select 'count', 'dropped', dropped::varchar from n union all
select 'count', 'skipped_blocks', (select count(distinct (kind, key, part)) from parts where size > 60)::varchar union all select 'count', 'skipped_rows', (select count(*) from parts where size > 60)::varchar union all
select 'count', 'dropped_percent', printf('%.2f', dropped * 100 / greatest(1, total)::double) from n union all
select 'reason', why, count(*)::varchar from final group by 2 union all select 'group', clique, 'keep ' || stays || ': ' || goes from told""")
def dedupe_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a dedupe: counts, pairs by reason, and who stays and goes in each group."""
    return resolve.audit(X.listings(spark, sf_dir))


# publication and pages


@query(f"select sha256(string_agg(id || ':' || coalesce(price::varchar, 'None') || ':' || coalesce(cast(square_m2 as double)::varchar, 'None'), '|' order by id))[1:16] as version from ({LF})")
def version_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.version_hash(X.listings(spark, sf_dir, faults=True))


@query(f"""
with recursive {_groups(_GOOD)} select (select count(*) from ({_GOOD})) - (select count(*) from groups where not keep) as row_count, (select count(*) from ({LF})) as source_active,
  (select count({_REASON}) from ({LF})) as source_filtered, (select count(distinct clique) from groups) as groups_deduped, true as price_index_measured, '{len(X.SERIES)} points' as price_index_note""")
def published_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The meta row of a version that is built and published for it."""
    folder = own_dir(spark, "published")
    publish.build(X.listings(spark, sf_dir, faults=True), X.series(spark), folder, "2024-03-01T00:00:00+00:00")
    return serve.read_meta(spark, folder).drop("version", "built_at")


@query("""
select event_id, case when k % 2 = 0 then case when k * 7 > 14400 then 'broken' else 'starting' end when k * 5 > 14400 then 'stale' else 'ok' end as state,
  case when (k % 2 = 0 and k * 7 > 14400) or (k % 2 = 1 and k * 5 > 14400) then 503 else 200 end as code from (select event_id, event_id % 5000 as k from events)""")
def health_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a service at many moments, by the age of its version and how long it has been up."""
    n = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 5000).alias("k"))
    return n.select("event_id", serve.health(F.col("k") % 2 == 1, F.col("k") * 5, F.col("k") * 7).alias("h")).select("event_id", "h.state", "h.code")


@query("select page_id, nullif(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '') as title from pages")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", pages.title_of(F.col("html")).alias("title"))


@query("select page_id, unnest(regexp_extract_all(html, '<a [^>]*href=\"([^\"]*)\"', 1)) as href from pages")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.explode(pages.links_of(F.col("html"))).alias("href"))


_PAGE = "concat('<script>window.digitalData = {\"listing\":{\"pagesCount\":', cast(page_id % 4 as string), '}};</script><script>window.data = {\"advert\":{\"title\":\"t', cast(page_id as string), '\",\"price\":', cast(page_id * 10 as string), '}};</script>')"


@query("select page_id, cast(nullif(page_id % 4, 0) as integer) as n_pages, 't' || page_id as title, cast(page_id * 10 as varchar) as price from pages")
def page_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").selectExpr("page_id", f"concat(html, {_PAGE}) as html")
    return p.select("page_id", pages.pages_count(F.col("html")).alias("n_pages"), pages.payload(F.col("html")).alias("d")).select("page_id", "n_pages", "d.advert.title", "d.advert.price")


_CARDS = "concat('<div class=\"x a-card\" data-id=\"', cast(page_id as string), '\"><p><b class=\"a-card__price\">', cast(page_id as string), ' <i>500</i> ₸</b></p></div><div class=\"a-card\" data-id=\"p', cast(page_id as string), '\"></div>')"


@query("""
select cast(page_id as varchar) as id, 'u/' || page_id as url, cast(page_id || '500' as bigint) as price, page_id as page_number from pages
union all select 'p' || page_id, 'u/p' || page_id, null, page_id from pages""")
def list_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.parse_list(_list_pages(spark, sf_dir), url_prefix="u/")


def _list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with two cards each behind their own content."""
    return table(spark, sf_dir, "pages").selectExpr("page_id as page_number", f"concat(html, {_CARDS}) as html")


@query("select doc_id as id from documents intersect select doc_id from labels")
def ids_in_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")).intersect(table(spark, sf_dir, "labels").select("doc_id"))


@query("select doc_id as id from documents except select doc_id from labels")
def ids_not_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")).distinct()
    return docs.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")), "id", "left_anti")


@query("select coalesce(p.page_id, l.doc_id) as id, case when p.page_id is null then 'label' else 'page' end as origin from pages p full join (select distinct doc_id from labels) l on l.doc_id = p.page_id")
def ids_of_either(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, a = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return registry.union_first(p.select(F.col("page_id").alias("id"), F.lit("page").alias("origin")), a.select(F.col("doc_id").alias("id"), F.lit("label").alias("origin")))


# rules of scans and runs


@query(f"""
select n as page_number, case when n % 5 = 0 then null when n % 5 = 1 then nullif(n - 1, 0) else n end as total_pages, n % 3 <> 0 as ok, n % 3 = 0 and n % 5 = 1 and n > 1 as ended
from (select page_id as n from pages)""")
def list_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a scan may conclude from list pages: some without cards, some that say how many pages there are."""
    n = table(spark, sf_dir, "pages").select(F.col("page_id").alias("page_number"), "html")
    count = "case when page_number % 5 = 0 then '' else concat('<script>window.digitalData = {\"listing\":{\"pagesCount\":', case when page_number % 5 = 1 then page_number - 1 else page_number end, '}};</script>') end"
    card = "case when page_number % 3 <> 0 then '<div class=\"a-card\" data-id=\"1\"></div>' else '' end"
    return pages.list_outcomes(n.selectExpr("page_number", f"concat(html, {count}, {card}) as html")).withColumn("total_pages", F.col("total_pages").cast("long"))


@query(f"""
with b as (select * from ({L}) where doc_id % 2 = 0),
n as (select id, price + 2 as price, city from b union all select id, price + 1, null from b where doc_id % 4 = 0)
select coalesce(o.id, n.id) as id, coalesce(n.price, o.price) as price, coalesce(n.city, o.city) as city from (select * from ({L}) where doc_id % 3 <> 0) o
full join (select id, arg_max(price, price) as price, max(city) as city from n group by id) n on n.id = o.id""")
def upsert_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that repeats ids: an older record, then the newest one, without its city, as well as rows without an id."""
    rows = X.listings(spark, sf_dir).filter("doc_id % 2 = 0")
    old = rows.filter("doc_id % 4 = 0").withColumns({"price": F.col("price") + 1, "city": F.lit(None).cast("string"), "scraped_at": F.lit("2024-01-01")})
    new = rows.withColumns({"price": F.col("price") + 2, "scraped_at": F.lit("2024-02-01")})
    none = rows.withColumn("id", F.lit(None).cast("string"))
    return registry.upsert_full(_state(spark, sf_dir), new.unionByName(old).unionByName(none), "2024-03-01T00:00:00+00:00").select("id", "price", "city")


@query(f"""
select l.id from ({LF}) l left join ({_ATTEMPTS}) f on f.id = l.id
where (price is null or rooms is null or square_m2 is null) and coalesce(attempts, 0) < 4 and l.id in (select cast(doc_id as varchar) from labels)""")
def refetch_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return registry.refetch_queue(X.listings(spark, sf_dir, faults=True), _failures(spark, sf_dir), wanted)


@query(f"""
select event_id, user_id from (select *, count(*) filter (event_type = 'error') over (partition by user_id, island) as n from ({_STREAK})) where event_type = 'error' and n < 3""")
def counted_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("event_type") != "error").alias("good"))
    return registry.counted_failures(e, "user_id", ["ts", "event_id"]).select("event_id", "user_id")


_KIND = "case event_type when 'error' then 'network' when 'view' then 'bad' when 'signup' then case when event_id % 40 = 7 then 'blocked' else 'ok' end else 'ok' end"
_RUN = f"""
with o as (select user_id, event_id, ts, {_KIND} as kind from events),
a as (select *, sum((kind <> 'network')::int) over w as answers, sum((kind = 'ok')::int) over w as goods from o window w as (partition by user_id order by ts, event_id rows unbounded preceding)),
b as (select *, sum((kind = 'network')::int) over (partition by user_id, answers order by ts, event_id rows unbounded preceding) as net, sum((kind = 'bad')::int) over (partition by user_id, goods order by ts, event_id rows unbounded preceding) as bad from a),
c as (select *, kind = 'network' and net % 2 = 0 as tripped from b),
d as (select *, sum(tripped::int) over (partition by user_id order by ts, event_id rows unbounded preceding) as trips from c),
e as (select *, case when kind = 'blocked' then 'blocked' when kind = 'bad' and bad >= 3 then 'layout_changed' when tripped and trips >= 2 then 'network' end as ended from d),
f as (select *, count(ended) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as over_ from e)"""


@query(f"""{_RUN}
select user_id, count(*) filter (kind = 'ok') as done, count(*) filter (kind in ('bad', 'network')) as failed, count(*) filter (tripped) as trips, max(ended) as ended,
  case max(ended) when 'blocked' then 2 when 'layout_changed' then 3 else 0 end as code from f where over_ = 0 group by 1""")
def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' events as runs over cards: what each run got done before it was blocked, met a changed layout, or gave up on the network; and its code."""
    o = table(spark, sf_dir, "events").selectExpr("user_id", "event_id", "ts", f"{_KIND} as kind")
    return registry.run_results(registry.processed(o, "user_id", ["ts", "event_id"], breaker=2, trips=2), "user_id")


@query(f"select id, 'new' as reason, price, cast(null as double) as old_price from ({_WINDOW})")
def window_all_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id of the window is new; a warm-up adds nothing."""
    window, known = _windows(spark, sf_dir)
    nothing = registry.window_diff(window, known, window, warmup=True).unionByName(registry.window_diff(window, known.limit(0), window.limit(0)))
    return registry.window_diff(window, known, window, all_new=True).unionByName(nothing)


@query(f"""
select d.id, d.reason, d.price, d.old_price, nullif(l.street, '') as street, l.status from (
  select w.id, 'price_drop' as reason, w.price, k.price as old_price from ({_WINDOW}) w join ({_KNOWN}) k on k.id = w.id where w.price < k.price) d
left join (select * from ({L}) where doc_id % 3 <> 0) l on l.id = d.id""")
def enriched_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    window, known = _windows(spark, sf_dir)
    drops = registry.window_diff(window, known, window).filter("reason = 'price_drop'")
    return registry.enrich_drops(drops, _state(spark, sf_dir)).select("id", "reason", "price", "old_price", "street", "status")


@query("select event_id, epoch(date_trunc('second', ts))::bigint as at from events")
def moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO texts with Z, an offset, none, or junk after the seconds."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    tail = F.element_at(F.array(F.lit("Z"), F.lit("+00:00"), F.lit(""), F.lit(" junk")), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", S.moment(F.concat(text, tail)).cast("long").alias("at"))


@query("select event_id, event_id % 2 = 0 and 1705406400 - floor(epoch(ts))::bigint <= 10800 as fresh from events")
def snapshot_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots finished at the events' times, every odd one incomplete; asked about at noon of 16 January."""
    finished = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return table(spark, sf_dir, "events").select("event_id", registry.is_fresh(F.col("event_id") % 2 == 0, finished, "2024-01-16T12:00:00+00:00").alias("fresh"))


# closeness, buckets and digests

_HAV = "2 * 6371000.0 * asin(sqrt(least(1, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"
_PLACES = f"select latitude as lat, longitude as lon, count(*) as n from ({L}) where latitude is not null group by 1, 2"


@query(f"""
with p as ({_PLACES}) select a.lat as lat_a, a.lon as lon_a, a.n as n_a, b.lat as lat_b, b.lon as lon_b, b.n as n_b, round({_HAV}, 3) as metres
from p a join p b on (a.lat < b.lat or (a.lat = b.lat and a.lon < b.lon)) and {_HAV} <= 2500""")
def near_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All places of listings up to 2.5 km apart."""
    both = close.near(cut(close.places(X.listings(spark, sf_dir))), 2500)
    return both.withColumn("metres", F.round("metres", 3))


@query(f"""
with p as ({_PLACES}), s as (select a.lat, a.lon, sum(b.n)::bigint - 1 as n from p a join p b on {_HAV} <= 15 group by 1, 2)
select l.id, s.n as n_near from ({L}) l left join s on s.lat = l.latitude and s.lon = l.longitude""")
def near_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many other listings are within 15 m of each."""
    return close.neighbours(X.listings(spark, sf_dir), 15).select("id", "n_near")


@query(f"""
with c as (select floor, square_m2, price, count(*) as n from ({L}) where floor is not null and square_m2 is not null group by 1, 2, 3),
s as (select a.floor, a.square_m2, a.price, sum(b.n)::bigint - 1 as n from c a join c b on a.floor = b.floor and abs(a.square_m2 - b.square_m2) <= greatest(3, least(a.square_m2, b.square_m2) * 0.08)
  and abs(a.price - b.price) / greatest(a.price, b.price)::double <= 0.02 group by 1, 2, 3)
select l.id, s.n as n_alike from ({L}) l left join s using (floor, square_m2, price)""")
def alike_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many other listings of the same floor have a close area and a close price."""
    return close.alike(X.listings(spark, sf_dir)).select("id", "n_alike")


@query(f"""
select id, (case when doc_id % 5 = 0 then price + 7 else price end)::bigint as price, case when doc_id % 5 = 0 then 'active' else status end as status from ({L}) where doc_id % 3 <> 0 and doc_id % 11 <> 0""")
def bucketed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State after three commits to a bucketed store: all listings, a batch of prices, a batch of deleted ids; then its buckets are compacted."""
    folder, listings = own_dir(spark, "buckets"), X.listings(spark, sf_dir)
    now = lambda: keyed.read(spark, folder, "listings", schema.LISTING)
    keyed.commit(spark, folder, {"listings": _state(spark, sf_dir)}, buckets=16)
    prices = listings.filter("doc_id % 5 = 0").select("id", (F.col("price") + 7).alias("price"))
    keyed.commit(spark, folder, {"listings": keyed.changed(registry.update_prices(now(), prices, "2024-03-01T00:00:00+00:00"), now())}, buckets=16)
    keyed.commit(spark, folder, {}, {"listings": listings.filter("doc_id % 11 = 0")}, buckets=16)
    keyed.compact(spark, folder, "listings", schema.LISTING, most_deltas=1)
    return now().select("id", "price", "status")


def _leaf_sql(rows: str) -> str:
    line = "length(id) || ':' || id || coalesce(length(price::varchar) || ':' || price, '-')"
    sums = " || ':' || ".join(f"sum(('0x' || substr(h, {15 * k + 1}, 15))::bigint)" for k in range(4))
    return f"select sha256(id)[1:3] as prefix, count(*) as n, sha256(count(*) || ':' || {sums}) as d from (select *, sha256({line}) as h from ({rows})) group by 1"


@query(f"""
with a as ({_leaf_sql(f"select id, price::bigint as price from ({L})")}), b as ({_leaf_sql(f"select id, (case when doc_id % 50 = 3 then price + 1 else price end)::bigint as price from ({L}) where doc_id % 70 <> 4")})
select prefix, coalesce(a.n, 0) as n_old, coalesce(b.n, 0) as n_new from a full join b using (prefix) where a.d is distinct from b.d""")
def changed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges of ids in which two versions differ: some prices changed, some rows gone."""
    old = X.listings(spark, sf_dir)
    new = old.filter("doc_id % 70 <> 4").withColumn("price", F.when(F.col("doc_id") % 50 == 3, F.col("price") + 1).otherwise(F.col("price")))
    trees = [cut(digest.tree(df, "id", ["id", "price"])) for df in (old, new)]
    return digest.changed(*trees)


# detail pages, files and versions

_DETAIL = """concat('<script>window.data = {"advert":{"title":"t', k, '","price":', k * 10, ',"rooms":2,"square":58.5,"address":{"city":"Astana","street":"S', k % 7, '"},"map":{"lat":51.1,"lon":71.4},',
  case when k % 3 = 0 then '"photos":[{"src":"b"},{"src":"a"},{}],' else '' end, '"complexId":', k % 5, ',"ownerName":"own', k, '"},"adverts":[{"priceM2":', k, ',"createdAt":"2024-01-02","addedAt":"2024-01-03","owner":{"title":"',
  case when k % 2 = 0 then '' else 'title' end, '","isChecked":', case when k % 2 = 0 then 'true' else 'false' end, '}}]};</script>',
  '<div class="offer__info-item" data-name="flat.floor"><div class="offer__advert-short-info"> ', k % 9 + 1, ' из 9</div></div>',
  '<div class="offer__info-item" data-name="flat.wc"><div class="offer__advert-short-info">two</div></div>',
  '<div class="offer__info-item" data-name="map.complex"><a href="/complex/show/city/alias', k % 5, '/">Name ', k % 5, '</a></div><div class="js-description">free <b>text ', k, '</b></div>')"""


def _detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with an advert behind their own content; every fourth has none."""
    return table(spark, sf_dir, "pages").selectExpr("page_id as id", "page_id as k", "html").selectExpr("id", f"case when k % 4 = 1 then html else concat(html, {_DETAIL}) end as html")


@query("""
select cast(k as varchar) as id, 'u/' || k as url, 't' || k as title, nullif(k * 10, 0)::bigint as price, 2::bigint as rooms, 58.5 as square_m2, (k % 9 + 1)::bigint as floor, 9::bigint as floor_total, 'S' || (k % 7) as street,
  (k % 5)::bigint as complex_id, 'alias' || (k % 5) as complex_alias, 'Name ' || (k % 5) as complex_name, 'two' as bathrooms_count, 'free text ' || k as full_description,
  case when k % 3 = 0 then 2 else 0 end::bigint as photo_count, case when k % 3 = 0 then sha256('a|b') end as photo_set_hash, case when k % 2 = 0 then 'own' || k else 'title' end as owner_name,
  case when k % 2 = 0 then 1 else 0 end::bigint as is_identity_confirmed, k::bigint as price_m2, '2024-01-03' as added_at from (select page_id as k from pages) where k % 4 <> 1""")
def detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = pages.parse_detail(_detail_pages(spark, sf_dir), "now", url_prefix="u/")
    return good.select("id", "url", "title", "price", "rooms", "square_m2", "floor", "floor_total", "street", "complex_id", "complex_alias", "complex_name", "bathrooms_count", "full_description", "photo_count", "photo_set_hash", "owner_name", "is_identity_confirmed", "price_m2", "added_at")


_BROKEN = """case k % 12 when 1 then html when 5 then concat(html, '<script>window.data = {"advert":{"title":};</script>') else concat(html, '<script>window.data = {"other":{}};</script>') end"""


@query("select cast(page_id as varchar) as id, case page_id % 12 when 1 then 'no data' when 5 then 'bad JSON' else 'no advert' end as reason from pages where page_id % 4 = 1")
def quarantined_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that give no listing, and why: without data, with broken data, or without an advert in it."""
    pages_ = _detail_pages(spark, sf_dir).withColumn("k", F.col("id"))
    broken = pages_.filter("k % 4 = 1").selectExpr("id", f"{_BROKEN} as html")
    return pages.parse_detail(pages_.filter("k % 4 <> 1").select("id", "html").unionByName(broken), "now")[1]


@query("""
select cast(k as varchar) as id, 't' || k as title, (k * 10)::bigint as price, 'own' || k as owner, case when k % 2 = 0 then 'true' else 'false' end as checked,
  case when k % 2 = 1 then k * 1.5 end as score, case when k % 2 = 1 then 'p' || k end as plan from (select page_id as k from pages) where k % 4 <> 1""")
def landed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of stored variants: known ones, and ones that the parser's struct doesn't have."""
    path = own_dir(spark, "landed")
    extra = """replace(html, '"advert":{', concat('"advert":{', case when id % 2 = 1 then concat('"rank":{"score":', id * 1.5, ',"plan":"p', id, '"},') else '' end))"""
    pages.landed(_detail_pages(spark, sf_dir).selectExpr("id", f"{extra} as html")).select("id", "data").write.parquet(f"{path}/t")
    d, get = spark.read.parquet(f"{path}/t").filter("data is not null"), pages.field
    v = F.col("data")
    return d.select(
        F.col("id").cast("string").alias("id"), get(v, "$.advert.title").alias("title"), get(v, "$.advert.price", "long").alias("price"), get(v, "$.advert.ownerName").alias("owner"),
        get(v, "$.adverts[0].owner.isChecked").alias("checked"), get(v, "$.advert.rank.score", "double").alias("score"), get(v, "$.advert.rank.plan").alias("plan"),
    )


@query(ORACLE["detail_rows"])
def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings of detail pages, by the variants that were stored when they landed."""
    path = own_dir(spark, "landed")
    pages.landed(_detail_pages(spark, sf_dir)).write.parquet(f"{path}/t")
    good, _ = pages.parse_detail(spark.read.parquet(f"{path}/t"), "now", url_prefix="u/", data="data")
    return good.select(*detail_rows(spark, sf_dir).columns)


# list pages page_id: every tenth is empty, two cards each otherwise, one of them on many pages; all say that there are 40 pages
_LISTED = """concat(html, '<script>window.digitalData = {"listing":{"pagesCount":40}};</script>', case when page_id % 10 <> 3 then concat('<div class="a-card" data-id="', cast(page_id % 50 as string),
  '"><b class="a-card__price">', cast(page_id as string), '</b></div><div class="a-card" data-id="p', cast(page_id as string), '"></div>') else '' end)"""


def _merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    listed = table(spark, sf_dir, "pages").selectExpr("page_id as page_number", f"{_LISTED} as html")
    return registry.merge_pages(pages.parse_list(listed), pages.list_outcomes(listed))


@query("""
select cast(page_id % 50 as varchar) as id, max(page_id) as price, max(page_id) as page_number from pages where page_id % 10 <> 3 group by 1
union all select 'p' || page_id, null, page_id from pages where page_id % 10 <> 3""")
def merged_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of a list scan: the last page of an id wins."""
    return _merged(spark, sf_dir)[0].select("id", "price", "page_number")


@query("""
with e as (select coalesce(min(page_id), 1e9) as e from pages where page_id % 10 = 3 and page_id > 40)
select 40::bigint as total_pages, count(*) filter (page_id % 10 <> 3) as pages_read, string_agg(page_id, ',' order by page_id) filter (page_id % 10 = 3) as skipped,
  count(*) filter (page_id % 10 = 3) = 0 as complete, 0 as code from pages, e where page_id < e""")
def merged_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a list scan read and missed up to the empty page after its last one, and its result's code."""
    meta = registry.list_result(_merged(spark, sf_dir)[1])
    return meta.select(F.col("total_pages").cast("long").alias("total_pages"), "pages_read", F.array_join(F.col("skipped_pages").cast("array<string>"), ",").alias("skipped"), "complete", "code")


@query("select page_id, contains(html, 'cookie') or contains(html, 'the') as flagged from pages")
def challenge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", pages.is_challenge(F.col("html"), ["cookie", "the"]).alias("flagged"))


@query(f"select id, price::bigint as price, square_m2, nullif(full_description, '') as full_description, nullif(street, '') as street from ({LF})")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings exported to CSV and read back: texts with line ends and quotes, unknown columns dropped, types restored."""
    path = own_dir(spark, "csv")
    rows = X.listings(spark, sf_dir, faults=True)
    sinks.export_csv(rows, f"{path}/out", [c for c in rows.columns if c != "lat_u"])
    known, _ = tables.known_columns(tables.read_csv(spark, f"{path}/out"))
    return registry.coerced(known).select("id", "price", "square_m2", "full_description", "street")


@query(f"select month, level from ({_MONTHS}) order by month")
def series_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest order of each month as an index series: written to its file (a row a month) in another order, with rows that don't count, and read back in month order."""
    path = own_dir(spark, "series")
    values = [r.asDict() for r in _monthly(spark, sf_dir).select("month", "value").orderBy(F.desc("month")).collect()]
    sinks.write_text(spark, f"{path}/s.json", json.dumps({"values": [*values, {"month": None, "value": 1}, {"month": "1999-13", "value": -1}]}))
    return monthly_index.rows(monthly_index.levels(tables.read_series(spark, f"{path}/s.json")))


@query("select o_orderkey, year(o_orderdate) * 12 + month(o_orderdate) - 1 - (2001 * 12) > 3 as stale from orders")
def stale_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the series is stale at the dates of orders."""
    last = monthly_index.levels(X.series(spark)).agg(F.max(S.month_key_index(F.col("month"))).alias("m"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d")).join(F.broadcast(last))  # one row
    return o.select("o_orderkey", monthly_index.over_stale(S.month_index(F.col("d")), F.col("m")).alias("stale"))


@query(f"select id, price::bigint as price from ({L}) where doc_id % 3 <> 0 and status = 'active'")
def committed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The active listings of a committed generation."""
    folder = own_dir(spark, "state")
    state.commit(spark, folder, state.load(spark, folder) | {"listings": _state(spark, sf_dir)})
    return tables.read_state(spark, f"{tables.read_pointer(spark, folder)['path']}/listings", active_only=True).select("id", "price")


@query("select 'v' || i as version, count(*) as n from range(5) t(i), documents where (i >= 2 or i = 0) and doc_id % 5 <= i group by 1")
def retained_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of five growing versions of the documents' ids the three newest and the current one, the oldest, are kept."""
    folder, ids, kept = own_dir(spark, "versions"), table(spark, sf_dir, "documents").select("doc_id"), None
    for i in range(5):
        sinks.write_version(folder, f"v{i}", {"t": ids.filter(F.col("doc_id") % 5 <= i)}, lambda _: False)
    sinks.clean_versions(spark, folder, "v0")
    for v in (f"v{i}" for i in range(5) if sinks.exists(spark, f"{folder}/v{i}")):
        rows = spark.read.parquet(f"{folder}/{v}/t").select(F.lit(v).alias("version"))
        kept = rows if kept is None else kept.unionByName(rows)
    return kept.groupBy("version").agg(F.count("*").alias("n"))


@query(f"""
with recursive {_groups(_GOOD)} select id, price::bigint as price from ({_GOOD}) l where id in (select max(id) from ({_GOOD}) x where not exists (from groups g where g.id = x.id and not keep))""")
def published_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row read by its id from a published version: that of its last page, whose rows are stored by id."""
    folder = own_dir(spark, "published")
    pointer = publish.build(X.listings(spark, sf_dir, faults=True), X.series(spark), folder, "2024-03-01T00:00:00+00:00")
    page = serve.read_table(spark, folder, limit=1, offset=pointer["row_count"] - 1)
    row = serve.read_listing(spark, folder, json.loads(page["rows"][0])["id"])
    return spark.createDataFrame([(row["id"], row["price"])], "id string, price long")


@query(f"select observed_at, price from ({X.RECORDED_SQL}) where id = '42' or id = '43' order by observed_at")
def listing_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = X.recorded(spark, sf_dir)
    return history.price_history_for(h, "42").unionByName(history.price_history_for(h, "43")).select("observed_at", "price")


@query(f"select id, 'r: ' || case when reason = 'area_bounds' then 'area outside [15, 400]' when reason = 'price_m2_bounds' then 'price a square metre outside [1500, 40000]' end as why from (select id, {_REASON} as reason from ({LF})) where reason like '%bounds'")
def reason_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.reject(X.listings(spark, sf_dir, faults=True)).filter("reason like '%bounds'")
    return rows.select("id", F.concat(F.lit("r: "), quality.reason_text(F.col("reason"))).alias("why"))


@query("""
select o_orderkey, case when k >= 3600 then (k // 3600) || 'h ' || lpad((k % 3600 // 60)::varchar, 2, '0') || 'm' else (k // 60) || 'm ' || lpad((k % 60)::varchar, 2, '0') || 's' end as took,
  strftime(timestamp '2024-03-01 12:00:00' + to_seconds(k), '%Y-%m-%dT%H:%M:%S+00:00') as at from (select o_orderkey, o_orderkey % 20000 as k from orders)""")
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 20000).cast("int").alias("k"))
    at = F.lit("2024-03-01T12:00:00+00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("k").cast("decimal(18,6)"))
    return n.select("o_orderkey", S.duration_text(F.col("k")).alias("took"), S.iso(at).alias("at"))


@query(f"select cast(id as varchar) as id, seq, price, old_price, kind from ({_POINTS})")
def streamed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change points as a stream finds them, stored once, and a batch replayed on top."""
    folder, name = own_dir(spark, "stream"), "events.parquet"
    kinds = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(kinds).parquet(f"{sf_dir}/*{name}").filter("event_type = 'purchase'")
    rows = stream.select(F.col("user_id").cast("string").alias("id"), F.col("value").alias("price"), F.col("ts").cast("timestamp").alias("observed_at"), F.col("event_id").alias("seq"))
    sink = feeds.append_once(f"{folder}/out", ["id", "seq"])
    feeds.price_changes(rows).writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    sink(cut(out.filter("batch_id = 0").drop("batch_id")), 0)
    return spark.read.parquet(f"{folder}/out").select("id", "seq", "price", "old_price", "kind")


def _run(stream: DataFrame, folder: str, sink) -> None:
    """Run a stream over all that is there, from its checkpoint on."""
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()


@query(f"select cast(id as varchar) as id, seq, price, old_price, kind from ({_POINTS})")
def stored_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change points of a stream that stops after a third of the time and starts again from its checkpoint; kept in a bucketed store with the last prices."""
    folder, rows = own_dir(spark, "stored"), X.observations(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    sink = feeds.stored_changes(f"{folder}/store", buckets=8)
    for i, part in enumerate(("observed_at < '2024-01-11'", "observed_at >= '2024-01-11'")):
        rows.filter(part).write.parquet(f"{folder}/in/{i}")
        _run(spark.readStream.schema(rows.schema).parquet(f"{folder}/in/*"), folder, sink)
    return feeds.read_changes(spark, f"{folder}/store").select("id", "seq", "price", "old_price", "kind")


@query("""
select user_id as id, cast(ts as date) as day, min(case when event_id % 3 = 0 then 1 else 2 end) as step from events where event_type = 'purchase' and event_id % 3 < 2 group by 1, 2""")
def first_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases by user and day as a stream stores them: the second run, from the first one's checkpoint, adds only keys that aren't there yet."""
    folder, e = own_dir(spark, "first"), table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    rows = e.select(F.col("user_id").alias("id"), F.to_date("ts").alias("day"), (F.col("event_id") % 3 + 1).cast("int").alias("step"))
    for step in (1, 2):
        rows.filter(F.col("step") == step).write.parquet(f"{folder}/in/{step}")
        _run(spark.readStream.schema(rows.schema).parquet(f"{folder}/in/*"), folder, feeds.append_new(f"{folder}/out", ["id", "day"], buckets=8))
    return spark.read.parquet(f"{folder}/out").select("id", "day", "step")


@query("""
with s as (select user_id as id, epoch_ms(ts) as t from events), w as (select max(t) - 86400000 as w from s), o as (select id, t, lead(t) over (partition by id order by t) as n from s, w where t <= w)
select cast(id as varchar) as id, 'missing' as reason, t + 43200000 as at_ms from o, w where coalesce(n - t > 43200000, t + 43200000 <= w)
union all select cast(id as varchar), 'revived', n from o where n - t > 43200000""")
def missing_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users who weren't seen for twelve hours, and when they came back, by timers of a stream; what the watermark hasn't passed is still open."""
    folder, name = own_dir(spark, "timeline"), "events.parquet"
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/*{name}")
    out = feeds.missing_timeline(stream.select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("seen_at")), "1 day", 12 * 3600)
    with feeds.timers(spark):
        _run(out, folder, feeds.append_once(f"{folder}/out", ["id", "reason", "at_ms"]))
    return spark.read.parquet(f"{folder}/out").select("id", "reason", "at_ms")


_LOG = f"""{_CHANGES}, a as (select row_number() over (order by id) as event_id, id, 'price_drop' as reason, new as price from j where new < old - 0.01),
b as (select (select count(*) from a) + row_number() over (order by id) as event_id, id, 'new' as reason, price::double as price from ({LF})
  where doc_id % 3 = 0 and price is not null and rooms is not null and square_m2 is not null and created_at in ('2024-01-27', '2024-01-28'))"""


@query(f"{_LOG} select * from a where event_id > 20 union all select * from b where event_id > 20")
def feed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed after its 20th event, as a stream reads it: drops are appended and read, then new listings, from the checkpoint on."""
    folder = own_dir(spark, "feed")
    batches = (_changes(spark, sf_dir)[1], history.new_events(_state(spark, sf_dir), X.listings(spark, sf_dir, faults=True), "2024-01-28T08:00:00+00:00"))
    for events in batches:
        feed.append(events, f"{folder}/log", ["id"])
        _run(feed.read_stream(spark, f"{folder}/log", 20), folder, feeds.append_once(f"{folder}/out", ["event_id"]))
    return spark.read.parquet(f"{folder}/out").select("event_id", "id", "reason", "price")
