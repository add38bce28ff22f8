"""Keys that hold most of the rows: the same results, and no task that holds them all."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from rentlens.operators import graph, history, registry, resolve, segments
from rentlens.queries import ORACLE, QUERIES
from tests.oracle import SMALL, connect, same
from tests.plans import plan, recording_cuts, small_parts


def tuples(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def points(spark):
    """90% of the rows on one id; ids without history, nulls, a null id."""
    rng = random.Random(2)
    ids = ["hot"] * 900 + [f"k{i}" for i in range(60)] + ["two"] * 38 + [None] * 2
    rows = [(k, i, None if rng.random() < 0.2 else float(rng.randint(1, 4)), rng.random() < 0.4) for i, k in enumerate(rng.sample(ids, len(ids)))]
    return spark.createDataFrame(rows, "id string, t int, price double, good boolean").repartition(4).cache()


@pytest.mark.parametrize("most", [40, 10**6])
def test_running_values(spark, points, most):
    want = {}
    for kind in ("last", "previous", "sum"):
        got = segments.running(points.filter("price is not null") if kind == "previous" else points, "id", ["t"], F.col("price"), kind, "v", most)
        assert got.columns == ["id", "t", "price", "good", "v"]
        rows, state, want = tuples(got, "id", "t", "price", "v"), {}, []
        for k, t, p, _ in sorted(rows, key=lambda r: (r[0] or "", r[1])):
            before = state.get(k)
            now = before if p is None else p if kind != "sum" or before is None else before + p
            want.append((k, t, p, before if kind == "previous" else now))
            state[k] = now
        assert rows == sorted(want, key=repr)
    assert segments.running(points.limit(0), "id", ["t"], F.col("price"), "last", "v", most).count() == 0


@pytest.mark.parametrize("most", [30])
def test_operators_in_segments(points, most):
    probes = points.select("id", F.col("t").alias("at"))
    calls = [
        lambda m: history.compress(points.withColumnRenamed("t", "observed_at"), most=m),
        lambda m: history.price_asof(probes, points.select("id", F.col("t").alias("observed_at"), "price").filter("observed_at % 3 = 0"), most=m),
        lambda m: registry.streaks(points, "id", ["t"], most_rows=m),
        lambda m: registry.counted_failures(points, "id", ["t"], most_rows=m),
    ]
    for call in calls:
        assert tuples(call(most)) == tuples(call(10**6))


@pytest.mark.parametrize("name", ["price_asof", "price_points", "failure_streaks", "counted_failures"])
def test_queries_in_segments(spark, monkeypatch, name):
    """The registered queries equal their SQL when nearly every key counts as hot."""
    for module, function in ((history, "compress"), (history, "price_asof"), (registry, "streaks"), (registry, "counted_failures")):
        real = getattr(module, function)
        monkeypatch.setattr(module, function, lambda *a, f=real, **k: f(*a, **k | ({"most": 9} if f.__module__.endswith("history") else {"most_rows": 9})))
    same(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name])


def test_tasks_of_a_hot_key_are_even(spark):
    """90% of 200,000 rows on one id: no task of the window over its segments has above twice the median's rows."""
    rows = spark.range(200_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("id"), F.col("id").alias("t"), (F.hash("id") % 5).cast("double").alias("price"))
    hot = rows.filter("id = 'hot'")
    dealt = segments.segmented(hot, "id", ["t"], 16)
    n = [r["count"] for r in dealt.repartitionById(16, F.col(segments.SEGMENT)).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    assert len(n) == 16 and max(n) <= 2 * statistics.median(n)
    plain, cut = (segments.running(rows, "id", ["t"], F.col("price"), "last", "v", most) for most in (10**6, 20_000))
    assert "Window" in plan(cut) and plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()


def test_hub(spark, monkeypatch):
    """A star with a chain behind it, in rounds: the hub's edges are split between tasks."""
    n = 6000
    ids = spark.range(1, n)
    edges = ids.select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).unionByName(ids.select(F.col("id").alias("a"), (F.col("id") + n).alias("b"))).repartition(8)
    plans = recording_cuts(graph, monkeypatch)
    with small_parts(spark):
        out = graph.components(edges, task_edges=1000).collect()
    assert {r["component"] for r in out} == {0} and len(out) == 2 * n - 1
    assert any("skew=true" in p for p in plans)


def test_hot_block(spark):
    keys = spark.range(6000).select("id", F.lit("geo4").alias("kind"), F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") / 30).cast("int"))).alias("key"), (F.col("id") % 700).cast("string").alias("refine")).repartition(8)
    with small_parts(spark):
        out = resolve.blocks(keys)
        rows = out.collect()
        assert "skew=true" in plan(out)
    hot = [r for r in rows if r["key"] == "hot"]
    assert len(hot) == 4800 and {r["part"] for r in hot} == {str(i) for i in range(700) if i % 10 < 8} and all(r["size"] in (8, 9) for r in hot)


def test_blocks_without_a_cap(spark):
    """Every pair of a block, however large, in chunks."""
    keys = spark.range(150).select("id", F.lit("geo4").alias("kind"), F.when(F.col("id") < 100, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("key"), F.lit("same").alias("refine"))
    capped = resolve.blocks(keys)
    assert resolve.skipped(capped).first()["skipped_rows"] == 100
    parts = resolve.blocks(keys, None)
    assert resolve.skipped(parts, None).first()["skipped_rows"] == 0
    want = sorted((a, b) for a in range(150) for b in range(a + 1, 150) if (a < 100 and b < 100) or (a >= 100 and a % 20 == b % 20))
    for chunk in (7, 1000):
        assert sorted(map(tuple, resolve.candidate_pairs(parts, None, chunk).collect())) == want
    assert len(want) > resolve.candidate_pairs(capped).count() > 0


def test_best_rows_are_chosen_before_the_shuffle(spark):
    """The first or last row of a key: a window group limit on both sides of the exchange."""
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    out = registry.latest_wins(df, "k", F.col("id"))
    assert sorted(map(tuple, out.collect())) == [(0, 99), (1, 97), (2, 98)] and plan(out).count("WindowGroupLimit") >= 2
