"""Mined URL rules against all token sets, by brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from rentlens.llm import url_filters


def brute_rules(rows, min_support, min_rows, min_lift, min_score):
    """rows: (tokens, blocked, held_out). The rules that the module's docstring describes, from every subset of every row's tokens."""
    rows = [r for r in rows if r[0]]
    learn = [(frozenset(t), b) for t, b, h in rows if not h]
    test = [(frozenset(t), b) for t, b, h in rows if h]
    share, held_share = (sum(b for _, b in x) / len(x) for x in (learn, test))
    least = max(min_rows, min_support * len(learn))
    single = {}
    for t, _ in learn:
        for x in t:
            single[x] = single.get(x, 0) + 1
    frequent = {x for x, n in single.items() if n >= least}

    def says_the_same(x, others):  # a domain that has the rows of one below it, no others
        return x.startswith("host:") and any(o.startswith("host:") and o.endswith("." + x[5:]) and single[o] == single[x] for o in others)

    support = {}
    for t, b in learn:
        some = [x for x in t & frequent if not says_the_same(x, t & frequent)]
        for k in range(1, len(some) + 1):
            for c in combinations(sorted(some), k):
                support[c, b] = support.get((c, b), 0) + 1
    need = -(-min_support * len(learn) // 1)
    found = {}
    for (c, b), n in support.items():
        below = any(x.startswith("host:") and y.startswith("host:") and y.endswith("." + x[5:]) for x in c for y in c)
        if n >= need and not below:
            set_ = frozenset(c)
            n, bad = (sum(f(b) for t, b in learn if set_ <= t) for f in (lambda b: 1, int))
            hn, hbad = (sum(f(b) for t, b in test if set_ <= t) for f in (lambda b: 1, int))
            lifted = lambda rate, usual: rate >= min_lift * usual if b else min_lift * rate <= usual
            strength = (bad - n * share) / (n * share * (1 - share)) ** 0.5 * (1 if b else -1)
            if n >= least and strength >= min_score and lifted(bad / n, share) and hn and lifted(hbad / hn, held_share):
                found[c, "block" if b else "allow"] = (n, strength)
    return {(c, v): n for (c, v), (n, s) in found.items() if not any(len(c) > 1 and (p, v) in found and found[p, v][1] >= s for p in combinations(c, len(c) - 1))}


@pytest.mark.parametrize("seed,max_items", [(1, None), (2, None), (3, None), (1, 8)])
def test_mining_is_complete(spark, seed, max_items):
    """With and without tokens to spare, the rules are exactly those that brute force finds; planted ones among them."""
    rng = random.Random(seed)
    words = [f"path:w{i}" for i in range(9)] + ["key:id", "key:ref"]
    rows = []
    for _ in range(900):
        site = rng.choice(["a.shop.example", "b.shop.example", "news.example", "blog.test"])
        hosts = [f"host:{'.'.join(site.split('.')[i:])}" for i in range(len(site.split(".")))]
        tokens = sorted({*hosts, *rng.sample(words, rng.randint(0, 4 if max_items else 6))})
        bad = 0.8 if {"path:w1", "path:w2"} <= set(tokens) else 0.75 if "host:blog.test" in tokens and "key:ref" in tokens else 0.1 if site.startswith("news") else 0.35
        rows.append((tokens, rng.random() < bad, rng.random() < 1 / 3))
    how = {"min_support": 0.01, "min_rows": 10, "min_lift": 1.25, "min_score": 2.0}
    df = spark.createDataFrame(rows, "tokens array<string>, blocked boolean, held_out boolean")
    got = {(tuple(r["rule_tokens"]), r["verdict"]): r["n_rows"] for r in url_filters.mine(df, max_items=max_items, **how).collect()}
    want = brute_rules(rows, **how)
    assert got == want and any(v == "block" for _, v in want) and any(v == "allow" for _, v in want) and any(len(c) > 1 for c, _ in want)


def test_rules_beyond_the_usual_number_of_items(spark):
    """A rule whose tokens all tell little alone, in long URLs, is found without a bound on items; words with digits on request."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        words = [f"path:x{k}" for k in range(12) if rng.random() < 0.75]
        tokens = sorted({*words, *(["path:page2"] if rng.random() < 0.3 else [])})
        rows.append((tokens, rng.random() < (0.95 if {"path:x0", "path:page2"} <= set(tokens) else 0.2), i % 3 == 0))
    df = spark.createDataFrame(rows, "tokens array<string>, blocked boolean, held_out boolean")
    found = {(tuple(r["rule_tokens"]), r["verdict"]) for r in url_filters.mine(df, max_items=None, min_support=0.15).collect()}
    assert (("path:page2", "path:x0"), "block") in found
    urls = spark.createDataFrame([("http://h.example/v1/page2/a",)], "url string").select(url_filters.tokens(F.col("url")).alias("few"), url_filters.tokens(F.col("url"), True).alias("all")).first()
    assert urls["few"] == ["host:example", "host:h.example", "path:a", "scheme:http"] and set(urls["all"]) - set(urls["few"]) == {"path:v1", "path:page2"}
