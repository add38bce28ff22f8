"""Landed HTML pages to rows.

JSON payloads and flags are native expressions. What depends on nesting (cards, attribute blocks) is one Arrow-batched pass
with the standard library's HTML parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..session import ship

#: The pages' class names, attribute names and the payload's shape.
CARD, CARD_PRICE, INFO, INFO_VALUE, DESCRIPTION, PRICE = "a-card", "a-card__price", "offer__info-item", "offer__advert-short-info", "js-description", "offer__price"
VOID = set("area base br col embed hr img input link meta source track wbr".split())
PAYLOAD = (
    "advert struct<title:string,price:string,rooms:string,square:string,storage:string,complexId:string,ownerName:string,"
    "address:struct<district:string,city:string,street:string,house_num:string>,map:struct<lat:string,lon:string>,photos:array<struct<src:string>>>,"
    "adverts array<struct<priceM2Text:string,priceM2:string,createdAt:string,addedAt:string,owner:struct<type:string,title:string,isChecked:string>>>"
)
INFO_COLUMNS = {"furniture": "live.furniture", "rent_renovation": "flat.rent_renovation", "priv_dorm": "flat.priv_dorm", "kitchen_studio": "flat.kitchen_studio", "suited_for": "flat.suited_for"}
BATHROOMS = ["flat.bathrooms", "flat.wc", "live.bathrooms"]


class _Node:
    def __init__(self, tag: str, attrs: dict, parent: _Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def has(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()

    def walk(self):
        """All tags below, in order; without recursion, as pages may nest to any depth."""
        todo = list(reversed(self.children))
        while todo:
            c = todo.pop()
            if isinstance(c, _Node):
                yield c
                todo.extend(reversed(c.children))

    def texts(self):
        todo = list(reversed(self.children))
        while todo:
            c = todo.pop()
            if isinstance(c, _Node):
                todo.extend(reversed(c.children))
            else:
                yield c

    def text(self, join: str = "") -> str:
        return join.join(x for x in (t.strip() for t in self.texts()) if x)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__()
        self.root = self.at = _Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(_Node(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _tree(html: str) -> _Node:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def _digits(text: str) -> str | None:
    return re.sub("[^0-9]", "", text) or None


def list_cards(html: str | None) -> list[dict]:
    """id and price digits of each card; the last of an id on a page wins."""
    out: dict[str, dict] = {}
    for n in _tree(html or "").walk():
        if n.tag == "div" and n.has(CARD) and n.attrs.get("data-id"):
            price = next((m for m in n.walk() if m.has(CARD_PRICE)), None)
            out[n.attrs["data-id"]] = {"id": n.attrs["data-id"], "price": _digits(price.text()) if price else None}
    return list(out.values())


def detail_blocks(html: str | None) -> dict:
    """Attribute map, complex link, description and shown price of a detail page."""
    nodes = list(_tree(html or "").walk())
    info, href, name = {}, None, None
    for n in nodes:
        if n.has(INFO) and "data-name" in n.attrs:
            value = next((m for m in n.walk() if m.has(INFO_VALUE)), None)
            info[n.attrs["data-name"] or ""] = value.text() if value else None
            if n.attrs["data-name"] == "map.complex" and href is None:
                link = next((m for m in n.walk() if m.tag == "a" and "/complex/show/" in (m.attrs.get("href") or "")), None)
                href, name = (link.attrs["href"], link.text()) if link else (None, None)
    description = next((n for n in nodes if n.has(DESCRIPTION)), None)
    price = next((n for n in nodes if n.has(PRICE)), None)
    return {"info": list(info.items()), "href": href, "complex": name, "description": description.text(" ") if description else None, "price": _digits(price.text()) if price else None}


def _mapped(pages: DataFrame, html: str, name: str, kind: T.DataType, arrow: pa.DataType, parse) -> DataFrame:
    """pages with what parse makes of each page; null for a page that it can't take, with the error's text in `name`_error, as one bad page must not stop the rest."""
    ship(pages.sparkSession)
    error = f"{name}_error"

    def guarded(h: str | None):
        try:
            return parse(h), None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"[:200]

    others = [c for c in pages.columns if c not in (name, error)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [guarded(h) for h in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array([m for m, _ in made], arrow), pa.array([e for _, e in made], pa.string())], [*others, name, error])

    return pages.select(others).mapInArrow(run, T.StructType([*(pages.schema[c] for c in others), T.StructField(name, kind), T.StructField(error, T.StringType())]))


def _carded(pages: DataFrame, html: str, page: str) -> DataFrame:
    kind = T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("price", T.StringType())]))
    arrow = pa.list_(pa.struct([("id", pa.string()), ("price", pa.string())]))
    return _mapped(pages.select(page, html), html, "cards", kind, arrow, list_cards)


def parse_list(pages: DataFrame, html: str = "html", page: str = "page_number", url_prefix: str = "") -> DataFrame:
    """(id, url, price, page_number) for each card of each page; see list_outcomes for pages without one."""
    c = _carded(pages, html, page).select(F.col(page).alias("page_number"), F.explode("cards").alias("c"))
    return c.select("c.id", F.concat(F.lit(url_prefix), F.col("c.id")).alias("url"), F.col("c.price").try_cast("long").alias("price"), "page_number")


def list_outcomes(pages: DataFrame, html: str = "html", page: str = "page_number") -> DataFrame:
    """(page_number, total_pages, ok, ended): what the scan may conclude from each list page.

    ok: it has cards. An empty page ends the list only if its own count says that there are fewer pages than its number; otherwise it was not read."""
    n = F.coalesce(F.size("cards"), F.lit(0))
    seen = _carded(pages, html, page).select(F.col(page).alias("page_number"), pages_count(F.col(html)).alias("total_pages"), n.alias("n"))
    ended = (F.col("n") <= 0) & F.coalesce(F.col("total_pages") < F.col("page_number"), F.lit(False))
    return seen.select("page_number", "total_pages", (F.col("n") > 0).alias("ok"), ended.alias("ended"))


def pages_count(html: Column) -> Column:
    """Number of list pages from the embedded JSON; zero, junk or none is null."""
    payload = F.regexp_extract(html, r"(?s)window\.digitalData\s*=\s*(\{.*?\});", 1)
    return F.nullif(F.get_json_object(payload, "$.listing.pagesCount").try_cast("int"), F.lit(0))


def payload_text(html: Column) -> Column:
    """The page's data object as JSON text."""
    strict = F.regexp_extract(html, r"(?s)window\.data\s*=\s*(\{.*?\});\s*</script>", 1)
    loose = F.regexp_extract(html, r"window\.data\s*=\s*(\{.*\});", 1)
    return S.first_text(strict, loose)


def payload(html: Column) -> Column:
    """The data object as a struct; bad JSON is null."""
    return F.from_json(payload_text(html), PAYLOAD, {"mode": "PERMISSIVE"})


def landed(pages: DataFrame, html: str = "html", name: str = "data") -> DataFrame:
    """pages with the data object as a variant, parsed once, for a table that is stored: all fields are kept, also those that nobody knows yet. Bad JSON is null."""
    return pages.withColumn(name, F.try_parse_json(payload_text(F.col(html))))


def field(data: Column, path: str, kind: str = "string") -> Column:
    """A field of a variant by its JSON path; null where it is missing or of another kind."""
    return F.try_variant_get(data, path, kind)


def _struct_of(data: Column) -> Column:
    """The known part of a variant as the struct that payload makes, field by field, as one odd field must not cost the others."""
    kind = T.StructType.fromDDL(PAYLOAD)

    def of(value: Column, t: T.DataType) -> Column:
        if isinstance(t, T.StructType):
            there = F.try_variant_get(value, "$", "map<string, variant>").isNotNull()
            return F.when(there, F.struct(*[of(F.try_variant_get(value, f"$.{f.name}", "variant"), f.dataType).alias(f.name) for f in t]))
        if isinstance(t, T.ArrayType):
            return F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: of(x, t.elementType))
        return F.try_variant_get(value, "$", "string")

    return of(data, kind)


def reason_of(html: Column) -> Column:
    """Why a page gives no advert: no data, bad JSON, or no advert in it."""
    text = payload_text(html)
    return F.when(F.coalesce(text, F.lit("")) == "", "no data").when(F.try_parse_json(text).isNull(), "bad JSON").otherwise("no advert")


def is_challenge(html: Column, markers: list[str]) -> Column:
    """Whether a landed page is a challenge page by one of the markers given."""
    out = F.lit(False)
    for m in markers:
        out = out | html.contains(m)
    return F.coalesce(out, F.lit(False))


def title_of(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, "(?s)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def links_of(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('<a [^>]*href="([^"]*)"'), 1)


def parse_detail(pages: DataFrame, scraped_at: str, page_id: str = "id", html: str = "html", url_prefix: str = "", data: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(listing rows, quarantine): pages without an advert, or that can't be parsed, are set aside by id and reason (no data, bad JSON, no advert, or the parser's error).

    data names a variant column of landed pages, which is then read instead of the page's JSON."""
    text, both = T.StringType(), T.StructType([T.StructField("_1", T.StringType()), T.StructField("_2", T.StringType())])
    kind = T.StructType([T.StructField("info", T.ArrayType(both)), *[T.StructField(c, text) for c in ("href", "complex", "description", "price")]])
    arrow = pa.struct([("info", pa.list_(pa.struct([("_1", pa.string()), ("_2", pa.string())]))), *[(c, pa.string()) for c in ("href", "complex", "description", "price")]])

    def blocks(h: str | None) -> dict:
        b = detail_blocks(h)
        return b | {"info": [{"_1": k, "_2": v} for k, v in b["info"]]}

    known = payload(F.col(html)) if data is None else _struct_of(F.col(data))
    # typed columns first, as variants don't go through Arrow
    read = pages.select(F.col(page_id).cast("string").alias("id"), F.col(html).alias("html"), known.alias("d"))
    found = _mapped(read, "html", "b", kind, arrow, blocks)
    d = found.select("id", "d", "b", F.map_from_entries("b.info").alias("info"), F.coalesce("b_error", reason_of(F.col("html"))).alias("reason"))
    good = F.col("d.advert").isNotNull() & F.col("b").isNotNull()
    ad, extra = F.col("d.advert"), F.get(F.col("d.adverts"), F.lit(0))
    owner = extra["owner"]
    photos = F.coalesce(F.filter(F.transform(ad["photos"], lambda p: p["src"]), lambda s: s.isNotNull() & (s != "")), F.array().cast("array<string>"))
    floors = S.floor_pair(F.try_element_at("info", F.lit("flat.floor")))
    price = F.nullif(S.to_long(ad["price"]), F.lit(0))
    checked = F.when(owner["isChecked"] == "true", 1).when(owner["isChecked"] == "false", 0).otherwise(S.to_long(owner["isChecked"])).cast("long")
    columns = {
        "id": F.col("id"), "url": F.concat(F.lit(url_prefix), F.col("id")), "title": ad["title"], "price": F.coalesce(price, F.col("b.price").try_cast("long")), "price_m2_text": extra["priceM2Text"],
        "price_m2": S.to_long(extra["priceM2"]), "rooms": S.to_long(ad["rooms"]), "square_m2": S.to_double(ad["square"]), "floor": floors["floor"], "floor_total": floors["total"],
        "district": ad["address"]["district"], "city": ad["address"]["city"], "street": ad["address"]["street"], "house_num": ad["address"]["house_num"], "latitude": S.to_double(ad["map"]["lat"]), "longitude": S.to_double(ad["map"]["lon"]),
        "complex_id": S.to_long(ad["complexId"]), "complex_alias": S.complex_alias(F.col("b.href")), "complex_name": F.col("b.complex"),
        **{c: F.try_element_at("info", F.lit(k)) for c, k in INFO_COLUMNS.items()}, "bathrooms_count": S.first_text(*[F.try_element_at("info", F.lit(k)) for k in BATHROOMS]),
        "full_description": F.col("b.description"), "photo_urls": F.to_json(photos), "photo_count": F.size(photos).cast("long"), "photo_set_hash": S.set_hash(photos), "seller_type": owner["type"],
        "owner_name": S.first_text(owner["title"], ad["ownerName"]), "is_identity_confirmed": checked, "published_date": extra["addedAt"], "created_at": extra["createdAt"], "added_at": extra["addedAt"], "storage": ad["storage"], "scraped_at": F.lit(scraped_at),
    }
    from ..schema import SITE_COLUMNS

    return d.filter(good).select(*[columns[c].alias(c) for c in SITE_COLUMNS]), d.filter(~good).select("id", "reason")
