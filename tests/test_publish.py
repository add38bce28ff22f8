import json

import pytest
from pyspark.sql import functions as F

from rentlens import fixtures, schema
from rentlens.plans import publish, serve
from rentlens.sources import pages, sinks, tables
from rentlens.streaming import feeds
from tests.oracle import SMALL

DETAIL = """<script id="jsdata">window.data = {"advert":{"title":"t","price":350000,"rooms":2,"square":58,
 "address":{"city":"Astana","street":"S","house_num":"9/1"},"map":{"lat":51.1,"lon":71.4},
 "photos":[{"src":"b"},{"src":"a"},{}],"complexId":7,"storage":"live"},
 "adverts":[{"priceM2":6034,"createdAt":"2026-07-17","addedAt":"2026-07-17","owner":{"title":"Хозяин","isChecked":true}}]};</script>
<div class="offer__info-item" data-name="flat.floor"><div class="offer__advert-short-info">3 из 9</div></div>
<div class="offer__info-item" data-name="map.complex"><a href="/complex/show/city/alias/">Name</a></div>
<div class="js-description">free <b>text</b></div>"""


def test_detail_page(spark):
    df = spark.createDataFrame([("7", DETAIL), ("8", "<html>none</html>"), ("9", None)], "id string, html string")
    good, bad = pages.parse_detail(df, "now", url_prefix="u/")
    r = good.first()
    assert good.columns == schema.SITE_COLUMNS
    assert (r["floor"], r["floor_total"], r["complex_alias"], r["complex_name"], r["photo_count"], r["is_identity_confirmed"], r["seller_type"]) == (3, 9, "alias", "Name", 2, 1, None)
    assert r["photo_set_hash"] == "".join(f"{b:02x}" for b in __import__("hashlib").sha256(b"a|b").digest())
    assert (r["price"], r["square_m2"], r["full_description"], r["price_m2"]) == (350000, 58.0, "free text", 6034)
    assert sorted(x["id"] for x in bad.collect()) == ["8", "9"]


def test_list_page(spark):
    html = '<script>window.digitalData = {"listing":{"pagesCount":3}};</script><div class="a-card" data-id="1"><div class="a-card__price">350 000 ₸</div></div><div class="a-card" data-id="2"></div><div class="a-card"></div>'
    df = spark.createDataFrame([(1, html), (2, None)], "page_number int, html string")
    assert sorted((r["id"], r["price"]) for r in pages.parse_list(df).collect()) == [("1", 350000), ("2", None)]
    assert [r[0] for r in df.select(pages.pages_count(F.col("html"))).collect()] == [3, None]
    assert [r[0] for r in df.select(pages.is_challenge(F.col("html"), ["pagesCount"])).collect()] == [True, False]


def test_guards():
    with pytest.raises(publish.Refused):
        publish.guard(9, None)
    with pytest.raises(publish.Refused):
        publish.guard(74, 100)
    publish.guard(75, 100)
    publish.guard(10, 99)


def test_build_and_serve(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(tables.NotPublished):
        serve.read_meta(spark, folder)
    rows = fixtures.listings(spark, SMALL, faults=True)
    first = publish.build(rows, fixtures.series(spark), folder, "t1")
    again = publish.build(rows, fixtures.series(spark), folder, "t2")
    assert first["version"] == again["version"] and publish.is_valid(spark, again["path"])
    meta = serve.read_meta(spark, folder).first()
    assert meta["built_at"] == "t2" and meta["row_count"] == first["row_count"] and meta["source_active"] == 200 and meta["price_index_measured"]
    seen, offset = [], 0
    while True:
        page = serve.read_table(spark, folder, limit=40, offset=offset)
        seen += [json.loads(r)["id"] for r in page["rows"]]
        offset += page["returned"]
        if page["returned"] < 40:
            break
    assert len(seen) == len(set(seen)) == first["row_count"]
    assert serve.read_listing(spark, folder, seen[0])["id"] == seen[0]
    with pytest.raises(KeyError):
        serve.read_listing(spark, folder, "none")
    assert [r["month"] for r in serve.read_price_index(spark, folder).collect()] == [m for m, _ in fixtures.SERIES]
    with pytest.raises(ValueError):
        serve.read_table(spark, folder, limit=501)


def test_damaged_version_is_written_anew(spark, tmp_path):
    """A version folder that is not whole is replaced, though its name says that it has these contents."""
    import shutil

    folder, rows = str(tmp_path), fixtures.listings(spark, SMALL)
    first = publish.build(rows, fixtures.series(spark), folder, "t1")
    for part in ("meta", "baseline"):
        shutil.rmtree(f"{first['path']}/{part}")
        assert not publish.is_valid(spark, first["path"])
        again = publish.build(rows, fixtures.series(spark), folder, "t2")
        assert again["path"] == first["path"] and publish.is_valid(spark, again["path"])
    assert not [p.name for p in tmp_path.iterdir() if p.is_dir() and p.name != first["version"]]
    assert serve.read_table(spark, folder, limit=1)["total"] == first["row_count"]


def test_pages_that_cannot_be_parsed(spark):
    deep = "<div>" * 5000 + DETAIL + "</div>" * 5000
    df = spark.createDataFrame([("7", deep), ("8", "<![if x" + DETAIL), ("9", DETAIL)], "id string, html string")
    good, bad = pages.parse_detail(df, "now")
    assert {"7", "9"} <= {r["id"] for r in good.collect()} and len(good.collect()) + len(bad.collect()) == 3
    assert good.filter("id = '7'").first()["floor"] == 3


def test_backup(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    assert sinks.backup(spark, f"{tmp_path}/a.csv") == f"{tmp_path}/a_before_dedup.csv"
    (tmp_path / "a.csv").write_text("id\n2\n")
    sinks.backup(spark, f"{tmp_path}/a.csv")
    assert (tmp_path / "a_before_dedup.csv").read_text() == "id\n1\n"


def test_changes(spark):
    events = spark.createDataFrame([(i, str(i), "new", 1.0, None, "t") for i in range(1, 6)], schema.EVENTS)
    page = serve.read_changes(events, since=1, limit=3)
    assert [r["event_id"] for r in page["rows"]] == [2, 3, 4] and page["next_since"] == 4
    assert serve.read_changes(events, since=9)["next_since"] == 9


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "quoted"\ntext'), ("2", None)], "id string, full_description string")
    sinks.export_csv(df, f"{tmp_path}/out")
    back, unknown = tables.known_columns(tables.read_csv(spark, f"{tmp_path}/out").withColumn("odd", F.lit("x")).withColumn("is_live", F.lit("y")))
    assert unknown == ["odd"]
    assert {r["id"]: r["full_description"] for r in back.collect()} == {"1": 'a "quoted"\ntext', "2": None}


def test_series_reader(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"city":"x","values":[{"month":"2024-01","value":5,"approx":true},{"month":"2024-02"},{"value":1}]}')
    assert [(r["month"], r["value"], r["approx"]) for r in tables.read_series(spark, f"{tmp_path}/s.json").collect()] == [("2024-01", "5", True), ("2024-02", None, False), (None, "1", False)]


def test_stream_equals_batch(spark, tmp_path):
    from rentlens.operators import history

    obs = fixtures.observations(spark, SMALL).withColumn("id", F.col("id").cast("string"))
    batch = {(r["id"], r["seq"], r["kind"]) for r in history.compress(obs, order=("observed_at", "seq")).collect()}
    src, ordered = tmp_path / "in", obs.orderBy("observed_at", "seq").toPandas()
    src.mkdir()
    import os

    for i in range(4):
        part = ordered.iloc[i * len(ordered) // 4 : (i + 1) * len(ordered) // 4]
        spark.createDataFrame(part, obs.schema).coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        f = next((tmp_path / f"p{i}").glob("*.parquet"))
        f.rename(src / f"{i}.parquet")
        os.utime(src / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(obs.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    sink = feeds.append_once(str(tmp_path / "out"), ["id", "seq"])
    q = feeds.price_changes(stream).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = [(r["id"], r["seq"], r["kind"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == len(batch) and set(got) == batch
    # a replayed batch adds nothing
    sink(spark.read.parquet(str(tmp_path / "out")).filter("batch_id = 1").drop("batch_id"), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(batch)
