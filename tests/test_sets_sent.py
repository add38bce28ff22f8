"""Shingle sets go to a block once for each row, not once for each pair."""

import random

import pytest
from pyspark.sql import functions as F

from rentlens import queries
from rentlens.operators import resolve
from tests.plans import small_parts

BASE = {"latitude": 51.1, "longitude": 71.4, "rooms": 2, "square_m2": 58.0, "floor": 3}


def listings(spark, n, seed):
    """Rows of one building, all in the same blocks, whose texts are alike, equal, or not."""
    rng, words = random.Random(seed), [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.sample(words, 20) + words[: rng.choice([0, 15, 40])]) for _ in range(n)]
    texts[1], texts[2], texts[3] = texts[0], "", "a b c"
    return spark.createDataFrame([(str(i), t, float(100 * (1 + i % 3)), *BASE.values()) for i, t in enumerate(texts)], "id string, full_description string, price double, latitude double, longitude double, rooms long, square_m2 double, floor long")


def jaccard(x, y):
    a, b = ({tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (x.split(), y.split()))
    return len(a & b) / len(a | b) if min(len(a), len(b)) >= 8 else 0


@pytest.mark.parametrize("max_block", [60, None])
def test_located_pairs_decide_alike(spark, max_block):
    """The same decisions with and without places, and as plain Python finds them, also in chunks."""
    df = listings(spark, 24, 5)
    p, of = resolve.prepare(df), {r["id"]: r for r in df.collect()}
    parts = resolve.blocks(resolve.block_keys(p), max_block)
    plain, located = (resolve.candidate_pairs(parts, max_block, 5, located=x) for x in (False, True))
    assert plain.columns == ["a", "b"] and located.columns == ["a", "b", "block"]
    got = [{(r["a"], r["b"]): r["why"] for r in resolve.decisions(x, p).collect()} for x in (plain, located)]
    assert got[0] == got[1] and len(got[0]) == located.count() == 24 * 23 // 2
    for (a, b), why in got[1].items():
        alike = jaccard(of[a]["full_description"], of[b]["full_description"]) >= 0.35
        assert why == ("B_text" if alike else "B_price" if of[a]["price"] == of[b]["price"] else "unconfirmed")
    assert {"B_text", "B_price", "unconfirmed"} == set(got[1].values())


def sent(node):
    """Bytes that the exchanges of a plan that ran have dealt out."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return sent(node.executedPlan())
    inner = [node.plan()] if "QueryStage" in node.nodeName() else [node.children().apply(i) for i in range(node.children().size())]
    own = node.metrics().apply("dataSize").value() if node.nodeName() == "Exchange" else 0
    return own + sum(map(sent, inner))


def long_texts(spark, n, words):
    """Rows of one block with prices and texts of their own, but for two that are alike."""
    texts = spark.range(n).select(F.col("id").cast("string").alias("id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(words)), lambda i: F.concat(F.lit("w"), F.when((F.col("id") == 1) & (i < words * 0.8), 0).otherwise(F.col("id")), F.lit("x"), i))).alias("full_description"))
    return texts.select("*", F.pow(F.lit(2.0), F.col("id").cast("int")).alias("price"), *[F.lit(v).alias(c) for c, v in BASE.items()])


def test_a_set_is_sent_once_for_a_block(spark, monkeypatch):
    """50 long texts make 1,225 pairs to read in one block: what is sent follows the 50 texts."""
    n, words = 50, 3000
    df = long_texts(spark, n, words)
    monkeypatch.setattr(queries.X, "listings", lambda *_, **__: df)
    with small_parts(spark):
        out = queries.QUERIES["pair_decisions"](spark, "")
        assert {r["why"] for r in out.collect()} == {"unconfirmed", "B_text"} and out.count() == n * (n - 1) // 2
    assert n * words * 8 < sent(out._jdf.queryExecution().executedPlan()) < 4 * n * words * 8


def test_a_dedupe_sends_a_set_once_for_a_block(spark, monkeypatch):
    """The same of all that a dedupe writes on its way, as er_stats and published versions do."""
    n, words, total, real = 50, 3000, [], resolve.cut
    df = long_texts(spark, n, words)

    def cut(made):
        out = real(made)
        total.append(sent(made._jdf.queryExecution().executedPlan()))
        return out

    monkeypatch.setattr(resolve, "cut", cut)
    with small_parts(spark):
        monkeypatch.setattr(queries.X, "listings", lambda *_, **__: df)
        assert queries.QUERIES["er_stats"](spark, "").first()["candidate_pairs"] == n * (n - 1) // 2
    assert n * words * 8 < sum(total) < 6 * n * words * 8


@pytest.mark.parametrize("name", ["published_meta", "published_listing"])
def test_a_published_version_sends_a_set_once_for_a_block(spark, monkeypatch, name):
    """The same of the build of a version: all rows are good ones, with prices apart."""
    n, words, total, real = 50, 3000, [], resolve.cut
    price = F.round(100_000 * F.pow(F.lit(1.05), F.col("id").cast("int"))).cast("long")
    texts = {"city": "Astana", "storage": "live", "status": "active"}
    df = long_texts(spark, n, words).withColumn("price", price).select("*", *[F.lit(v).alias(c) for c, v in texts.items()])

    def cut(made):
        out = real(made)
        total.append(sent(made._jdf.queryExecution().executedPlan()))
        return out

    monkeypatch.setattr(resolve, "cut", cut)
    with small_parts(spark):
        monkeypatch.setattr(queries.X, "listings", lambda *_, **__: df)
        row = queries.QUERIES[name](spark, "").first()
        assert row["row_count"] == n - 1 if name == "published_meta" else row["id"] == "9"
    assert n * words * 8 < sum(total) < 6 * n * words * 8
