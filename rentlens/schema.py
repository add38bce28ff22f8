"""Fixed column lists and types of a listing row."""

from __future__ import annotations

from pyspark.sql import types as T

#: The columns that come from the site, in their order.
SITE_COLUMNS = [
    "id", "url", "title", "price", "price_m2_text", "price_m2", "rooms", "square_m2", "floor", "floor_total", "district", "city",
    "street", "house_num", "latitude", "longitude", "complex_id", "complex_alias", "complex_name", "furniture", "rent_renovation",
    "priv_dorm", "bathrooms_count", "kitchen_studio", "suited_for", "full_description", "photo_urls", "photo_count",
    "photo_set_hash", "seller_type", "owner_name", "is_identity_confirmed", "published_date", "created_at", "added_at", "storage", "scraped_at",
]
LIFECYCLE_COLUMNS = ["first_seen_at", "last_seen_at", "status"]
LISTING_COLUMNS = SITE_COLUMNS + LIFECYCLE_COLUMNS
LONG_COLUMNS = {"price", "price_m2", "rooms", "floor", "floor_total", "complex_id", "photo_count", "is_identity_confirmed"}
DOUBLE_COLUMNS = {"square_m2", "latitude", "longitude"}
REQUIRED = ("price", "rooms", "square_m2")
#: Columns of old seed files that are known and ignored.
IGNORED_SEED_COLUMNS = ["finish_type", "red_flags", "premium_markers", "extra_attributes", "requires_manual_review", "llm_skipped_error", "is_live", "is_installment_segment"]


def kind(column: str) -> T.DataType:
    if column in LONG_COLUMNS:
        return T.LongType()
    return T.DoubleType() if column in DOUBLE_COLUMNS else T.StringType()


LISTING = T.StructType([T.StructField(c, kind(c)) for c in LISTING_COLUMNS])
HISTORY = T.StructType([T.StructField("id", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("observed_at", T.StringType())])
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()), T.StructField("id", T.StringType()), T.StructField("reason", T.StringType()),
        T.StructField("price", T.DoubleType()), T.StructField("old_price", T.DoubleType()), T.StructField("observed_at", T.StringType()),
    ]
)
FAILURES = T.StructType([T.StructField("id", T.StringType()), T.StructField("attempts", T.LongType()), T.StructField("last_error", T.StringType()), T.StructField("last_attempt_at", T.StringType())])
