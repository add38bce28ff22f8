import pytest
from pyspark.sql import functions as F

from rentlens import schema
from rentlens.functions import scalars as S
from rentlens.operators import history, monthly_index, quality, registry, resolve

NOW = "2024-03-01T00:00:00+00:00"


def rows(spark, *dicts):
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema.LISTING) for d in dicts], schema.LISTING)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_coercion(spark):
    ints = {"1 200": 1200, "1 200": 1200, "12,5": None, "12.9": 12, "-1.9": -1, "": None, "abc": None, "1d": None, "0x1p3": None, "1e400": None}
    for raw, want in ints.items():
        assert one(spark, S.to_long(F.lit(raw))) == want, raw
    assert one(spark, S.to_double(F.lit("58,5"))) == 58.5
    assert one(spark, S.to_double(F.lit("1 200.5"))) == 1200.5
    assert one(spark, S.to_number(F.lit(" 58,5 "))) == 58.5
    assert one(spark, S.to_number(F.lit("1 200"))) is None
    assert one(spark, S.to_number(F.lit("NaN"))) is None


def test_texts(spark):
    assert tuple(one(spark, S.floor_pair(F.lit("3 из 9")))) == (3, 9)
    assert tuple(one(spark, S.floor_pair(F.lit("5")))) == (5, None)
    assert tuple(one(spark, S.floor_pair(F.lit("цоколь")))) == (None, None)
    assert one(spark, S.clean_house(F.lit(" 9\\1 A "))) == "9/1a"
    assert one(spark, S.clean_house(F.lit("9/1,_9/2"))) is None
    assert one(spark, S.norm(F.lit("  A b\n C "))) == "a b c"
    assert one(spark, S.norm(F.lit(None))) == ""
    assert one(spark, F.size(S.shingles(S.word_list(F.lit("a b c"))))) == 0
    assert one(spark, F.size(S.shingles(S.word_list(F.lit("a b c d a b c d"))))) == 4
    assert one(spark, S.duration_text(F.lit(3720))) == "1h 02m"


def test_null_coordinates(spark):
    assert one(spark, S.haversine_m(F.lit(51.0), F.lit(None).cast("double"), F.lit(51.0), F.lit(71.0))) is None


def test_moments(spark):
    want = {"2024-01-02T03:04:05Z": 1704164645, "2024-01-02T03:04:05+05:00": 1704146645, "2024-01-02 03:04:05": 1704164645, "2024-01-02T03:04:05.5xyz": 1704164645, "2024": None, "junk": None, "": None}
    for text, at in want.items():
        assert one(spark, S.moment(F.lit(text)).cast("long")) == at, text


def test_upsert_keeps_old_values(spark):
    state = rows(spark, {"id": "1", "street": "S", "price": 100, "status": "missing", "first_seen_at": "a", "last_seen_at": "b"})
    out = registry.upsert_full(state, spark.createDataFrame([("1", None, "200"), ("2", "T", "5")], "id string, street string, price string"), NOW)
    got = {r["id"]: r for r in out.collect()}
    assert (got["1"]["street"], got["1"]["price"], got["1"]["status"], got["1"]["first_seen_at"], got["1"]["last_seen_at"]) == ("S", 200, "active", "a", NOW)
    assert got["2"]["first_seen_at"] == NOW
    again = registry.upsert_full(out, spark.createDataFrame([("1", None, "200")], "id string, street string, price string"), NOW)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_missing(spark):
    state = rows(spark, {"id": "1", "status": "active"}, {"id": "2", "last_seen_at": "2024-02-01T00:00:00+00:00"}, {"id": "3", "status": "active", "last_seen_at": "2024-02-29T23:00:00+00:00"}, {"id": "4", "status": "active"})
    seen = spark.createDataFrame([("4",)], "id string")
    got = {r["id"]: (r["status"], r["newly_missing"]) for r in registry.mark_missing(state, seen, NOW, complete=True).collect()}
    assert got == {"1": ("missing", True), "2": ("missing", True), "3": ("active", False), "4": ("active", False)}
    assert registry.mark_missing(state, seen, NOW, complete=False).filter("newly_missing").count() == 0
    assert registry.mark_missing(state, seen.limit(0), NOW, complete=True).filter("newly_missing").count() == 0


def test_price_history(spark):
    state = rows(spark, {"id": "1", "price": 100, "last_seen_at": "2024-02-01T00:00:00+00:00"}, {"id": "2", "price": 100})
    known = spark.createDataFrame([("2", 100.0, "2024-01-01T00:00:00+00:00"), ("3", 7.0, "2024-01-01T00:00:00+00:00")], schema.HISTORY)
    prices = spark.createDataFrame([("1", "90"), ("2", "100"), ("3", "7"), ("4", None)], "id string, price string")
    delta, drops = history.price_changes(state, known, prices, NOW)
    assert sorted(map(tuple, delta.collect())) == [("1", 90.0, NOW), ("1", 100.0, "2024-02-01T00:00:00+00:00")]
    assert [tuple(r) for r in drops.collect()] == [("1", "price_drop", 90.0, 100.0, NOW)]
    loose, _ = history.price_changes(state, known, prices, NOW, strict=False)
    assert ("3", 7.0, NOW) in map(tuple, loose.collect())
    numbered = history.numbered(drops, 41).collect()
    assert [r["event_id"] for r in numbered] == [42]


def test_start_points_keep_the_median(spark):
    obs = spark.createDataFrame([(i, 100.0, 1) for i in range(1000)] + [(i, 110.0 if i < 100 else 100.0, 2) for i in range(1000)], "id long, price double, observed_at int")
    points = history.compress(obs)
    assert points.count() == 1100
    probes = spark.createDataFrame([(i, 3) for i in range(1000)], "id long, at int")
    assert history.price_asof(probes, points).agg(F.expr("percentile(price, 0.5)")).first()[0] == 100.0


def test_pages_and_failures(spark):
    parsed = spark.createDataFrame([("1", 1), ("2", 1), ("1", 2)], "id string, page_number int")
    pages = spark.createDataFrame([(1, 2, True), (2, 2, True)], "page_number int, total_pages int, ok boolean")
    snap, meta = registry.merge_pages(parsed, pages)
    assert {r["id"]: r["page_number"] for r in snap.collect()} == {"1": 2, "2": 1}
    assert meta.first()["complete"]
    bad = registry.merge_pages(parsed, spark.createDataFrame([(1, 2, True), (2, 2, False)], pages.schema))[1].first()
    assert not bad["complete"] and bad["skipped_pages"] == [2]
    ledger = registry.count_failures(spark.createDataFrame([("1", "e" * 600, "b")], "id string, error string, at string"), spark.createDataFrame([("1", 3, "x", "a"), ("2", 1, "y", "a")], schema.FAILURES))
    got = {r["id"]: (r["attempts"], len(r["last_error"])) for r in ledger.collect()}
    assert got == {"1": (4, 500), "2": (1, 1)}
    assert [r["id"] for r in registry.gave_up(ledger).collect()] == ["1"]
    assert [r["id"] for r in registry.clear_failures(ledger, parsed).collect()] == []


def test_quality_cases(spark):
    good = {"price": 300000, "rooms": 2, "square_m2": 58.0}
    cases = [({}, None), ({"price": None}, "incomplete"), ({"storage": "archive"}, "storage"), ({"price": 0}, "price"), ({"square_m2": 9.0}, "area_bounds"), ({"price": 53534}, "price_m2_bounds"), ({"latitude": 50.27, "longitude": 57.19}, "outside"), ({"latitude": 10.0}, None), ({"city": "X"}, "city"), ({"city": " ASTANA "}, None)]
    df = rows(spark, *[{**good, **c, "id": str(i)} for i, (c, _) in enumerate(cases)])
    got = {r["id"]: r["reason"] for r in quality.reject(df).collect()}
    assert got == {str(i): w for i, (_, w) in enumerate(cases)}
    missing = quality.reject(rows(spark, {**good, "id": "1", "status": "missing"}), quality.Bounds(include_missing=False))
    assert missing.first()["reason"] == "missing"


def decide(spark, a, b):
    base = {"latitude": 51.1, "longitude": 71.4, "rooms": 2, "square_m2": 58.0, "price": 450000, "floor": 3, "owner_name": "Хозяин"}
    p = resolve.prepare(rows(spark, {**base, **a, "id": "1"}, {**base, **b, "id": "2"}))
    r = resolve.decisions(spark.createDataFrame([("1", "2")], "a string, b string"), p).first()
    return r["ok"], r["why"]


def test_decisions(spark):
    assert decide(spark, {}, {"square_m2": 57.0}) == (True, "B_price")
    assert decide(spark, {"house_num": "9"}, {"house_num": "10"}) == (False, "house")
    assert decide(spark, {"house_num": "9"}, {}) == (True, "B_price")
    assert decide(spark, {"longitude": None}, {}) == (False, "distance")
    assert decide(spark, {"rooms": 1}, {"rooms": 2, "square_m2": 62.0}) == (False, "rooms")
    assert decide(spark, {"floor": None, "owner_name": "x"}, {"owner_name": "x"}) == (False, "floor_unknown")
    assert decide(spark, {"owner_name": "agency", "rooms": 4, "square_m2": 160.0, "price": 700000}, {"owner_name": "agency", "rooms": 4, "square_m2": 170.0, "price": 800000}) == (False, "owner_area")
    assert decide(spark, {"owner_name": "anna"}, {"owner_name": "Anna "}) == (True, "A_owner")
    text = " ".join(f"w{i}" for i in range(30))
    assert decide(spark, {"full_description": text, "price": 1}, {"full_description": text + " end", "price": 9}) == (True, "B_text")


def one_by_one(hits):
    """Greedy cliques, a node after the other by degree and digest."""
    import hashlib

    near = {}
    for a, b in hits:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    rank = sorted(near, key=lambda n: (-len(near[n]), hashlib.md5(str(n).encode()).hexdigest()))
    used, out = set(), set()
    for n in rank:
        if n not in used:
            group = [n]
            for m in rank:
                if m in near[n] and m not in used and all(m in near[g] for g in group):
                    group.append(m)
            if len(group) > 1:
                used.update(group)
                out.add((n, *group[1:]))
    return out


def test_cliques_in_rounds(spark):
    """Components of any size give what one choice after the other gives, also if none fits a task."""
    import random

    random.seed(6)
    edges = {tuple(sorted(random.sample(range(60), 2))) for _ in range(160)} | {(i, i + 1) for i in range(100, 160)} | {(200, 201), (201, 202), (200, 202)}
    hits = spark.createDataFrame([*edges, (200, 201)], "a long, b long")
    for bound in (200_000, 40, 1):
        got = {}
        for r in resolve.cliques(hits, task_hits=bound).orderBy("place").collect():
            got.setdefault(r["clique"], []).append(r["id"])
        assert {tuple(g) for g in got.values()} == one_by_one(edges)


def test_text_bound_changes_nothing(spark):
    """Decisions with the size bound are those of the plain similarity, and tracks only name them."""
    import random

    random.seed(1)
    words = [f"w{i}" for i in range(40)]
    base = {"latitude": 51.1, "longitude": 71.4, "rooms": 2, "square_m2": 58.0, "floor": 3}
    df = rows(spark, *[{**base, "id": str(i), "price": random.choice([100, 101, 200]), "full_description": " ".join(words[: random.randint(5, 40)])} for i in range(25)])
    p = resolve.prepare(df)
    pairs = resolve.candidate_pairs(resolve.blocks(resolve.block_keys(p)))
    got = {(r["a"], r["b"]): r for r in resolve.decisions(pairs, p).collect()}
    assert {k: r["ok"] for k, r in got.items()} == {(r["a"], r["b"]): r["ok"] for r in resolve.decisions(pairs, p, tracks=False).collect()}
    n = {r["id"]: (max(0, len(r["full_description"].split()) - 3), r["price"]) for r in df.collect()}
    for (a, b), r in got.items():
        (x, pa), (y, pb) = n[a], n[b]
        alike = min(x, y) >= 8 and min(x, y) / max(x, y) >= 0.35
        assert r["why"] == ("B_text" if alike else "B_price" if abs(pa - pb) / max(pa, pb) <= 0.02 else "unconfirmed")


def test_cliques(spark):
    hits = spark.createDataFrame([(1, 2), (2, 3), (5, 6), (6, 7), (5, 7)], "a long, b long")
    groups = {}
    for r in resolve.cliques(hits).collect():
        groups.setdefault(r["clique"], set()).add(r["id"])
    edges = {tuple(sorted(e)) for e in [(1, 2), (2, 3), (5, 6), (6, 7), (5, 7)]}
    for g in groups.values():
        assert all((a, b) in edges for a in g for b in g if a < b)
    assert {5, 6, 7} in groups.values() and {1, 2, 3} not in groups.values()
    assert sum(map(len, groups.values())) == 5


def test_big_block_is_refined(spark):
    df = rows(spark, *[{"id": str(i), "latitude": 51.1, "longitude": 71.4, "rooms": 1, "square_m2": 20.0 + i, "floor": 1} for i in range(61)], {"id": "x", "latitude": 51.1, "longitude": 71.4, "rooms": 1, "square_m2": 20.0, "floor": 1})
    pairs = resolve.candidate_pairs(resolve.blocks(resolve.block_keys(resolve.prepare(df))))
    assert pairs.filter("a = '0' and b = 'x'").count() == 1


def test_index(spark):
    two = spark.createDataFrame([(0, "2024-01", "1"), (1, "2024-02", "2")], "ordinal int, month string, value string")
    assert monthly_index.levels(two).count() == 0
    df = spark.createDataFrame([("2024-01-10",), (None,)], "d string")
    assert [r["factor"] for r in monthly_index.with_factor(df, monthly_index.levels(two), F.col("d").cast("date"), "2024-02-01").collect()] == [1.0, 1.0]
    series = spark.createDataFrame([(0, "2026-06", "5602"), (1, "2026-07", "5800"), (2, "2026-08", "6079"), (3, "bad", "-1"), (4, "2026-08", "6079")], two.schema)
    levels = monthly_index.levels(series)
    dates = spark.createDataFrame([("2026-06-01", 5602.0), ("2026-07-01", 5800.0), ("2026-08-20", 6079.0), ("2026-05-10", 5602.0), ("2026-07-01T00:30:00+05:00", 5800.0)], "d string, want double")
    for r in monthly_index.with_level(dates, levels, S.own_date(F.col("d"))).collect():
        assert r["level"] == r["want"]
    assert one(spark, monthly_index.guarded(F.lit(2.5))) == 1.0
    assert monthly_index.is_stale(levels, "2027-01-01").first()["stale"]


def test_mistyped_month(spark):
    """A month far from the others raises instead of filling a calendar."""
    series = spark.createDataFrame([("2024-01", 1.0), ("2024-02", 1.1), ("9024-03", 1.2)], "month string, level double")
    with pytest.raises(Exception, match="no month for too long"):
        monthly_index.calendar(series).collect()
