"""Mining without a bound: rules that the eight tokens that tell most don't hold, and words that come together."""

import random

from rentlens.llm import url_filters
from tests.llm.test_rules import brute_rules

KIND = "tokens array<string>, blocked boolean, held_out boolean"


def found(rules):
    return {(tuple(r["rule_tokens"]), r["verdict"]): r["n_rows"] for r in rules.collect()}


def test_no_token_is_left_out(spark):
    """Nine words tell more alone than the two that only tell together; the rules are those of brute force, by default."""
    rng, rows = random.Random(5), []
    for i in range(900):
        words = {f"path:x{k}" for k in range(9) if rng.random() < 0.9}
        pair = {t for t in ("path:y", "path:z") if rng.random() < 0.5}
        bad = 0 if len(words) < 9 else 0.1 if len(pair) == 1 else 0.95
        rows.append((sorted(words | pair), rng.random() < bad, i % 3 == 0))
    how = {"min_support": 0.05, "min_rows": 10, "min_lift": 1.25, "min_score": 2.0}
    df, pair = spark.createDataFrame(rows, KIND), (("path:y", "path:z"), "block")
    want = brute_rules(rows, **how)
    assert found(url_filters.mine(df, **how)) == want and pair in want
    assert pair not in found(url_filters.mine(df, max_items=8, **how))


def test_words_that_come_together(spark):
    """Tokens of the same URLs make the rules that they make one by one; where only the held-out URLs tell them apart they are different."""
    rng, rows = random.Random(3), []
    for i in range(900):
        held, tokens = i % 3 == 0, {f"key:k{rng.randrange(4)}"}
        tokens |= {"path:a", "path:b", "path:c"} if rng.random() < 0.4 else set()
        tokens |= {"path:d", "key:d"} if rng.random() < 0.4 else set()
        tokens |= {"path:e"} if "path:d" in tokens and not (held and rng.random() < 0.5) else set()
        bad = 0.8 if {"path:a", "path:d"} <= tokens else 0.5 if "path:a" in tokens else 0.2
        rows.append((sorted(tokens), rng.random() < bad, held))
    how = {"min_support": 0.01, "min_rows": 10, "min_lift": 1.25, "min_score": 2.0}
    got, want = found(url_filters.mine(spark.createDataFrame(rows, KIND), **how)), brute_rules(rows, **how)
    assert got == want and {(("path:a", "path:d"), "block"), (("key:d", "path:c"), "block"), (("path:b", "path:e"), "block")} <= set(want)
