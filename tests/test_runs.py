"""Runs over cards, the audit of a dedupe, landed payloads."""

import random

import pytest
from pyspark.sql import functions as F

from rentlens import __main__ as commands
from rentlens import fixtures
from rentlens.operators import registry, resolve
from rentlens.session import cut
from rentlens.sources import pages, sinks
from tests.oracle import SMALL


def simulate(kinds, breaker, trips, streak):
    """One run, card by card: what it got to, its trips and how it ended."""
    net = bad = tripped = 0
    for i, kind in enumerate(kinds):
        if kind == "blocked":
            return i + 1, tripped, "blocked"
        if kind == "network":
            net += 1
            if net == breaker:
                net, tripped = 0, tripped + 1
                if tripped == trips:
                    return i + 1, tripped, "network"
            continue
        net = 0
        bad = bad + 1 if kind == "bad" else 0
        if bad == streak:
            return i + 1, tripped, "layout_changed"
    return len(kinds), tripped, None


@pytest.mark.parametrize("most_rows", [20, 10**6])
def test_runs_against_a_simulation(spark, most_rows):
    rng = random.Random(8)
    runs = {f"r{i}": rng.choices(["ok", "bad", "network", "blocked"], [6, 3 * rng.random(), 8 * rng.random(), 0.1], k=rng.randint(1, 60)) for i in range(40)}
    rows = [(r, i, f"{r}-{i}", k) for r, kinds in runs.items() for i, k in enumerate(kinds)]
    df = spark.createDataFrame(rows, "run string, at int, id string, kind string").repartition(3)
    how = {"breaker": 3, "trips": 2, "streak": 3, "most_rows": most_rows}
    done = cut(registry.processed(df, "run", ["at"], **how))
    assert done.columns == ["run", "at", "id", "kind", "trip", "ended"]
    got = {r["run"]: r for r in registry.run_results(done, "run").collect()}
    n = {r["run"]: r["count"] for r in done.groupBy("run").count().collect()}
    endings = set()
    for run, kinds in runs.items():
        upto, trips, ended = simulate(kinds, 3, 2, 3)
        r, seen = got[run], kinds[:upto]
        assert (n[run], r["trips"], r["ended"], r["done"], r["failed"]) == (upto, trips, ended, seen.count("ok"), seen.count("bad") + seen.count("network")), run
        assert r["code"] == {"blocked": 2, "layout_changed": 3}.get(ended, 0)
        endings.add(ended)
    assert endings == {None, "blocked", "network", "layout_changed"}
    details = df.select("id", F.lit(1).alias("price"), F.lit(1).alias("rooms"), F.when(F.col("at") == 2, None).otherwise(1.0).alias("square_m2"))
    complete, bad, results = registry.window_details(df, details, "run", ["at"], **how | {"most_rows": 10**6})
    assert {r["id"] for r in bad.collect()} == {r["id"] for r in done.filter("kind = 'bad'").collect()} and results.count() == len(runs)
    assert {r["id"] for r in complete.collect()} == {r["id"] for r in done.filter("kind = 'ok' and at <> 2").collect()}
    assert registry.run_results(registry.processed(df.limit(0), "run", ["at"]), "run").count() == 0


def test_audit_of_a_file(spark, tmp_path, capsys):
    rows = fixtures.listings(spark, SMALL)
    sinks.export_csv(rows.withColumn("price", F.col("price").cast("long")), f"{tmp_path}/in", [c for c in rows.columns if c not in ("doc_id", "lat_u", "lon_u")])
    commands.main(["dedupe", f"{tmp_path}/in", "--dry-run"])
    told = [line.split("\t") for line in capsys.readouterr().out.splitlines() if "\t" in line]
    counts = {k: v for kind, k, v in told if kind == "count"}
    assert counts["total"] == "200" and int(counts["groups"]) == sum(kind == "group" for kind, _, _ in told) > 0
    assert sum(int(v) for kind, _, v in told if kind == "reason") == int(counts["candidate_pairs"])
    dropped = [x for kind, _, v in told if kind == "group" for x in v.split(": ")[1].split(", ")]
    assert len(dropped) == int(counts["dropped"]) and all(x.endswith((" (A_owner)", " (B_text)", " (B_price)")) for x in dropped)
    assert resolve.audit(rows.limit(0)).filter("kind = 'count' and key = 'total'").first()["text"] == "0"


ODD = [
    '{"advert":{"title":"a","price":1500,"rooms":"2","photos":[{"src":"x"},{},null]},"adverts":[{"priceM2":7,"owner":{"isChecked":true}}]}',
    '{"advert":{"title":{"odd":1},"price":[1],"map":"none","photos":"none"},"adverts":{"a":1}}',
    '{"advert":{},"adverts":[]}', '{"advert":null}', '{"advert":{"price":1.50,"square":"58,5","address":{"city":"A"}},"new":{"deep":[1,{"x":"y"}]}}', '{"advert":}', "[1]", '{"a":1}{"b":2}', "",
]


def test_variants_hold_what_structs_hold(spark):
    """Well-formed payloads give the same rows either way; odd fields cost only themselves; unknown fields can be read."""
    df = spark.createDataFrame([(str(i), f"<script>window.data = {x};</script>") for i, x in enumerate(ODD)], "id string, html string")
    stored = pages.landed(df)
    by_struct, by_variant = (pages.parse_detail(d, "now", data=c)[0] for d, c in ((df, None), (stored, "data")))
    a, b = ({r["id"]: r for r in x.collect()} for x in (by_struct, by_variant))
    assert a["0"] == b["0"] and a["2"] == b["2"] and b["4"]["city"] == "A" and b["4"]["square_m2"] == 58.5
    assert b["1"]["price"] is None and b["1"]["photo_count"] == 0
    assert stored.filter("id = 4").select(pages.field(F.col("data"), "$.new.deep[1].x").alias("x")).first()["x"] == "y"
    why = {r["id"]: r["reason"] for r in pages.parse_detail(df, "now")[1].collect()}
    assert why["3"] == why["7"] == "no advert" or why["7"] == "bad JSON"
    assert why["5"] == "bad JSON" and why["8"] in ("no data", "bad JSON")
