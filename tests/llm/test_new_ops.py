"""Hard negatives, token counts and fill-in-the-middle."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rentlens.llm import fill_in_middle, hard_negatives, token_counts
from rentlens.llm.queries import ORACLE, QUERIES, vocabulary
from tests.oracle import SMALL, connect, same

VEC = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_fill_in_middle"])
def test_matches_sql(spark, name):
    same(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name])


# hard negatives


def brute_negatives(rows, k=5, lower=80, upper=100):
    seen = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            seen[i] = min(seen.get(i, (label, v, q)), (label, v, q))
    out = []
    for a in seen:
        if a % 10 == 0:
            score = {i: sum(x * y for x, y in zip(seen[a][2], seen[i][2])) for i in seen if i != a and len(seen[i][2]) == len(seen[a][2])}
            ranked = sorted(score, key=lambda i: (-score[i], i))
            for p in [i for i in ranked if seen[i][0] == seen[a][0]][:k]:
                found = [i for i in ranked if seen[i][0] != seen[a][0] and lower * score[p] <= 100 * score[i] <= upper * score[p]][:k]
                out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(found)]
    return sorted(out)


def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in (base[i % 6] + rng.normal(size=8) * 0.2).round(2)], int(rng.integers(0, 3)) if i % 3 else 1) for i in range(300)]
    rows += [(300 + i, [0.5] * 8, i % 2) for i in range(20)]  # ties
    rows += [(330, None, 1), (340, [None] * 8, 1), (350, [float("nan")] * 8, 1), (360, [float("inf")] + [0.0] * 7, 1), (370, [0.1] * 8, None), (None, [0.1] * 8, 1)]
    rows += [(10, [0.9] * 8, 0), (10, [0.9] * 8, 0), (11, [0.1] * 8, 2), (380, [1.0, 2.0], 0), (381, [1.0, 2.0], 0), (382, [1.0, 1.5], 1), (390, [], 0), (391, [], 1), (392, [], 0)]
    return rows


@pytest.mark.parametrize("how", [{}, {"elements": 400, "least_rows": 8}, {"elements": 40, "least_rows": 4, "lower": 50}])
def test_hard_negatives(spark, how):
    rows = vectors()
    df = spark.createDataFrame(rows, VEC).withColumns({"anchor_id": F.lit("mine"), "limits": F.lit(1), "id": F.lit(2)})
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lower=how.get("lower", 80))


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VEC), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1)], VEC), F.col("vec_id") % 10 == 0).count() == 0


def test_scores_are_exact():
    big = np.floor(np.array([[2.0**27 + 1, 3.0]]))
    assert hard_negatives._scores(big, big)[0, 0] == (2**27 + 1) ** 2 + 9
    with pytest.raises(OverflowError):
        hard_negatives._scores(big * 4, big * 4)


# token counts


def strings(rng, n):
    words = ["the", " of", "isn't", "  ", "\n\n", "\t", "12345", "日本語", "\U0001f600", "été", "!!!", "<|endoftext|>", "<|endo", "ftext|>", "don't've", " ", "　", "'s", "a" * 40, "ab" * 30, " " * 50, "=" * 60, "'" * 45, "9" * 50, "中" * 40, "\U0001f600" * 20]
    for _ in range(n):
        yield "".join(rng.choice(words) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(1, 120)))


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    return lambda text: len(tok.encode(text, add_special_tokens=False).ids)


def test_chunks_against_library(library):
    counter = token_counts.Counter(vocabulary("byte_bpe_50k.json"), chunk=1, overlap=1)  # the least that is allowed
    assert counter.chunk < 130
    rng = random.Random(5)
    for text in strings(rng, 1500):
        assert counter.chunked(text) == library(text), text


@pytest.mark.parametrize("unit", ["a", "w", "ab", "abcab", " ", "  x", "\n", "日", "\U0001f600", "=", "'", "-=", "7", "́", "<", "<|endoftext|>", "aé"])
def test_periodic_texts(library, unit):
    text = unit * (200_000 // len(unit))
    counter = token_counts.load(vocabulary("byte_bpe_50k.json"))
    assert counter.quick and len(text) > counter.chunk
    for t in (text, "x" + text, " ." + text + "s end"):
        assert counter.count(t) == library(t)


def test_quick_engine_on_all_characters(library):
    counter = token_counts.load(vocabulary("byte_bpe_50k.json"))
    points = [chr(i) for i in range(1, 0x30000) if not 0xD800 <= i < 0xE000]
    for i in range(0, len(points), 500):
        part = points[i : i + 500]
        for text in ("".join(part), " ".join(part), "a".join(part), "1".join(part), "! ".join(part)):
            assert counter.count(text) == library(text)


def test_token_counts(spark, library):
    texts = [None, "", "hello", " <|endoftext|> x", *strings(random.Random(9), 20), "word " * 20_000, "word " * 20_000, "z" * 70_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"n_bytes": F.lit("old"), "body": F.lit(1)})
    out = token_counts.count_tokens(df, vocabulary("byte_bpe_50k.json"))
    assert out.columns == ["doc_id", "text", "body", "n_bytes", "n_tokens", "over_limit"]
    for r in out.collect():
        n = library(r["text"] or "")
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((r["text"] or "").encode()), n > 512)
    assert token_counts.count_tokens(df.limit(0), vocabulary("byte_bpe_50k.json")).count() == 0
    with pytest.raises(ValueError):
        token_counts.Counter(vocabulary("word_bpe_49k.json"))


def test_token_counts_query(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op12_token_counts"](spark, SMALL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: library(t) for i, t in texts.items()} and len(rows) == len(texts)


# fill-in-the-middle


def brute_fim(doc_id, text, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def fim_texts():
    rng = random.Random(4)
    bits = ["\n", "\n\n", "line", "é", "日本", "\U0001f600", "<", "P>", "<P", "<<S", ">", "<X>", "\r", " ", "\x00", " ", "x" * 30]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    out += [None, "", "\n", "a", "a\n", "\n\n\n", "a<P>b", "<<M>", "<P<S>", "<P\n>", "\U0001f600" * 3000, "日\n" * 2000, "x" * 5000 + "<S>", "y" * 509 + "<M>" + "y" * 600]
    out += ["z" * k + "<P>" for k in range(500, 520)] + ["é" * k + "\n" + "é" * k for k in range(250, 262)] + ["same\ntext\n"] * 3
    return out


@pytest.mark.parametrize("how", [{}, {"lane": 1}, {"lane": 7, "percent": 60, "spm_percent": 20}])
def test_fill_in_middle(spark, how):
    texts = fim_texts()
    rows = [(i if i != 5 else None, t, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, plain long").withColumn("n", F.lit("old"))
    out = fill_in_middle.transform(df, **how).withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form")))
    assert out.columns == ["doc_id", "text", "plain", "n", "form", "prefix_chars", "middle_chars", "output", "back"]
    got = {r["plain"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, t, k in rows:
        r = got[k]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute_fim(i, t, how.get("percent", 100), how.get("spm_percent", 50)), t
        assert r["back"] == (t or "")
    assert fill_in_middle.transform(df.limit(0)).count() == 0


def test_other_sentinels(spark):
    marks = ("<|a|>", "<|ab|>", "||")
    df = spark.createDataFrame([(1, "one\ntwo\nthree"), (2, "x<|a|>"), (3, "<|ab|"), (4, "|\n|"), (5, "a||")], "doc_id long, text string")
    out = fill_in_middle.transform(df, sentinels=marks).withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"), marks)).collect()
    assert [r["form"] == "plain" for r in out] == [False, True, False, False, True]
    assert all(r["back"] == r["text"] for r in out if r["doc_id"] in (1, 2, 5))
