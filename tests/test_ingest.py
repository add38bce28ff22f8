import pytest
from pyspark.sql import functions as F

from rentlens import schema
from rentlens.functions import sql
from rentlens.operators import graph, registry
from rentlens.plans import ingest
from rentlens.sources import pages, sinks, state, tables


def test_runs(spark, tmp_path):
    folder = str(tmp_path)
    detail = lambda *rows: spark.createDataFrame(list(rows), "id string, price string, rooms string, square_m2 string, created_at string, street string")
    listed = lambda *rows: spark.createDataFrame(list(rows), "id string, price string")
    t1, t2, t3 = (f"2024-03-0{d}T00:00:00+00:00" for d in (1, 2, 3))
    first = ingest.apply_run(state.load(spark, folder), detail(("1", "100", "2", "50", "2024-03-01", "S"), ("2", "200", "2", "50", "2023-01-01", None)), listed(("1", "100"), ("2", "200")), t1, complete=True)
    assert state.commit(spark, folder, first) == 1
    attempts = spark.createDataFrame([("9", "timeout", t2), ("1", "x", t2)], "id string, error string, at string")
    second = ingest.apply_run(state.load(spark, folder), detail(("1", "90", "2", "50", "2024-03-01", None)), listed(("1", "90")), t2, complete=True, attempts=attempts)
    assert state.commit(spark, folder, second) == 2
    third = ingest.apply_run(state.load(spark, folder), detail(), listed(("2", None)), t3, complete=True)
    assert state.commit(spark, folder, third) == 3
    now = state.load(spark, folder)
    rows = {r["id"]: r for r in now["listings"].collect()}
    assert (rows["1"]["street"], rows["1"]["price"], rows["1"]["status"], rows["1"]["first_seen_at"]) == ("S", 90, "missing", t1)
    assert (rows["2"]["price"], rows["2"]["status"], rows["2"]["last_seen_at"]) == (200, "active", t3)
    assert [(r["event_id"], r["id"], r["reason"], r["old_price"]) for r in now["events"].orderBy("event_id").collect()] == [(1, "1", "new", None), (2, "1", "price_drop", 100.0)]
    assert sorted((r["id"], r["price"], r["observed_at"]) for r in now["history"].collect()) == [("1", 90.0, t2), ("1", 100.0, t1), ("2", 200.0, t1)]
    assert [(r["id"], r["attempts"]) for r in now["failures"].collect()] == [("9", 1)]
    assert now["listings"].columns == schema.LISTING_COLUMNS


def test_commit_after_a_crash(spark, tmp_path):
    """A run that wrote its generation but not the pointer must not win over the next commit."""
    folder, empty = str(tmp_path), state.load(spark, str(tmp_path))
    row = lambda i: empty["failures"].unionByName(spark.createDataFrame([(i, 1, "e", "t")], schema.FAILURES))
    assert state.commit(spark, folder, empty | {"failures": row("old")}) == 1
    real = sinks.write_text
    sinks.write_text = lambda *_: (_ for _ in ()).throw(OSError("crash"))
    try:
        with pytest.raises(OSError):
            state.commit(spark, folder, empty | {"failures": row("crashed")})
    finally:
        sinks.write_text = real
    assert [r["id"] for r in state.load(spark, folder)["failures"].collect()] == ["old"]
    assert state.commit(spark, folder, empty | {"failures": row("new")}) == 2
    assert [r["id"] for r in state.load(spark, folder)["failures"].collect()] == ["new"]
    # many commits keep a few folders, the current one among them
    for _ in range(3):
        state.commit(spark, folder, empty | {"failures": row("last")})
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("gen-")]) == 3
    assert [r["id"] for r in state.load(spark, folder)["failures"].collect()] == ["last"]


def test_damaged_pointer_is_not_an_empty_store(spark, tmp_path):
    (tmp_path / "latest.json").write_text("{")
    with pytest.raises(tables.DamagedPointer):
        state.load(spark, str(tmp_path))


def test_repeated_and_null_ids(spark):
    details = spark.createDataFrame([("1", "100", "A", "t1"), ("1", "90", None, "t2"), (None, "5", "B", "t1"), ("1", "90", None, "t2")], "id string, price string, street string, scraped_at string")
    out = registry.upsert_full(spark.createDataFrame([], schema.LISTING), details, "now").collect()
    assert [(r["id"], r["price"], r["street"]) for r in out] == [("1", 90, "A")]
    held = registry.upsert_full(spark.createDataFrame([], schema.LISTING), details.filter("scraped_at = 't1'"), "now")
    prices = spark.createDataFrame([("1", "7", 1), ("1", "5", 2), (None, "3", 3), ("1", None, 3)], "id string, price string, at int")
    assert [(r["id"], r["price"]) for r in registry.update_prices(held, prices, "now", "at").collect()] == [("1", 5)]
    assert [(r["id"], r["price"]) for r in registry.update_prices(held, prices, "now").collect()] == [("1", 7)]


def test_window_rules(spark):
    window = spark.createDataFrame([("1", 5.0), ("2", 9.0)], "id string, price double")
    known = spark.createDataFrame([("1", 7.0)], window.schema)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    none = window.limit(0)
    assert rows(registry.window_diff(window, known, none)) == [("1", "price_drop", 5.0, 7.0), ("2", "new", 9.0, None)]
    assert rows(registry.window_diff(window, none, none)) == [] == rows(registry.window_diff(window, known, none, warmup=True))
    assert rows(registry.window_diff(window, none, none, all_new=True)) == [("1", "new", 5.0, None), ("2", "new", 9.0, None)]


def test_list_ends(spark):
    """An empty page ends the list only if it says itself that there are fewer pages."""
    card, count = '<div class="a-card" data-id="{0}"></div>', '<script>window.digitalData = {{"listing":{{"pagesCount":{0}}}}};</script>'
    full = [(i, count.format(3) + card.format(i)) for i in (1, 2)]
    for last, complete, skipped in [(count.format(2), True, []), (count.format(3), False, [3]), ("", False, [3]), (None, False, [3]), (count.format(3) + card.format(3), True, [])]:
        df = spark.createDataFrame([*full, (3, last)], "page_number int, html string")
        meta = registry.merge_pages(pages.parse_list(df), pages.list_outcomes(df))[1].first()
        assert (meta["complete"], meta["skipped_pages"], meta["total_pages"]) == (complete, skipped, 3), last


def test_pending_failures(spark):
    rows = [("r", 1, False), ("r", 2, False), ("r", 3, True), ("r", 4, False), ("r", 5, False), ("r", 6, False), ("q", 1, True), ("q", 2, False)]
    df = spark.createDataFrame(rows, "run string, n int, good boolean")
    assert sorted((r["run"], r["n"]) for r in registry.counted_failures(df, "run", ["n"]).collect()) == [("q", 2), ("r", 1), ("r", 2)]


def test_sql_functions(spark):
    sql.register(spark)
    r = spark.sql(r"select haversine_m(51.1, 71.4, 51.1, 71.4) as a, norm_text(' A  b ') as b, clean_house(' 9\\1 A ') as c, clean_house('1,2') as d, jaccard(array('a','b'), array('b')) as e").first()
    assert tuple(r) == (0.0, "a b", "9/1a", None, 0.5)


def test_components(spark):
    import random

    random.seed(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(random.randint(100, 300), random.randint(100, 300)) for _ in range(120)] + [(1000, i) for i in range(1001, 1100)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    random.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(5).unionByName(spark.createDataFrame([(None, 3), (7, 7)], "a long, b long"))
    for bound in (1_000_000, 40):
        got = {r["node"]: r["component"] for r in graph.components(df, task_edges=bound).collect()}
        assert got == {n: find(n) for n in parent if n in got} and set(got) == {n for a, b in edges if a != b for n in (a, b)}
    assert graph.components(df.limit(0)).count() == 0
    assert df.filter(F.col("a").isNull()).count() == 1
