"""Embedding near-dedup, n-gram join and the pipeline."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rentlens.llm import embedding_dedup, ngram_join
from rentlens.llm.queries import OP8_SQL, QUERIES
from tests.oracle import SMALL, connect, same

VEC = "vec_id long, embedding array<float>, label int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_join(docs):
    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, roots(sets, links)


def edited(rng, words, share):
    return [rng.choice("qwertyuiop") * 3 + str(rng.random()) if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def texts():
    """Near copies at all distances, long chains, a passage that many share, copies and odd cases."""
    rng = random.Random(8)
    out = []
    for base in range(6):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(8, 200))]
        for _ in range(14):
            out.append(" ".join(edited(rng, words, rng.choice([0, 0.005, 0.01, 0.02, 0.03]))))
    passage = [f"p{i}" for i in range(60)]
    out += [" ".join(passage + [f"u{rng.random()}" for _ in range(rng.choice([2, 8, 30]))]) for _ in range(40)]
    chain = [f"c{i}" for i in range(100)]
    for k in range(20):
        chain[k * 5] = f"d{k}"
        out.append(" ".join(chain))
    out += ["One two three", "one TWO  three", "one two three four", "", None, " \n ", "a b c d e", "a b c d e f", "a b c d e"]
    return list(enumerate(out))


def test_join_of_common_shingles(spark, texts, monkeypatch):
    """Shingles that count as too common for a run give the same components."""
    monkeypatch.setattr(ngram_join, "HOT", 6)
    monkeypatch.setattr(ngram_join, "HOT_MEANS", 0)
    _, want = brute_join(texts)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.link(df).collect()} == want


@pytest.mark.parametrize("how", [{}, {"heavy_docs": 5, "heavy_shingles": 900}, {"heavy_docs": 4, "heavy_shingles": 500, "rounds": 1}])
def test_join_against_brute_force(spark, texts, how):
    sets, want = brute_join(texts)
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"node": F.lit("mine"), "n": F.lit(1)})
    got = {r["doc_id"]: r for r in ngram_join.link(df, **how).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_join_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "other words than those here"), (2, "a b c d e f"), (None, "a b c d e f"), (5, None)]
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(-1, 2, None), (1, 2, 1), (1, 2, 1), (2, 1, 1), (2, 2, 1), (5, 0, 5)]
    a, b = [" ".join(f"{x}{i}" for i in range(50)) for x in "ab"]
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, b + " fin"), (5, "own words here and there again")]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}
    assert ngram_join.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("how", [{}, {"heavy_docs": 4, "heavy_shingles": 400}])
def test_join_of_repeated_ids(spark, texts, how):
    """Ids that stand on several texts, blank ones among them, link as if their texts were linked; against brute force."""
    rng = random.Random(12)
    rows = [(i, t) for i, t in texts] + [(rng.randint(0, 100), t) for _, t in rng.sample(texts, 12)] + [(3, ""), (4, " "), (90, None)]
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(i, j) for x, (i, a) in enumerate(sets) for j, b in sets[x + 1 :] if a and b and 100 * len(a & b) >= 80 * len(a | b)]
    want = roots({i for i, _ in rows}, links)
    for r in ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect():
        assert r["component_id"] == want[r["doc_id"]]


def test_join_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    sets, want = brute_join(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op10_ngram_join"](spark, SMALL).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_long_words_and_texts():
    a, b = "x" * 500, "x" * 499 + "y"
    assert ngram_join.word_hashes(a)[0] != ngram_join.word_hashes(b)[0]
    assert len(ngram_join.word_hashes(f" {a}\n{b}\t{a} ")) == 3
    assert len(ngram_join.shingles(" ".join(map(str, range(50_000))))) == 49_996


def brute_vectors(rows, threshold=0.98):
    ok = {i: (np.array(v, float), lab) for i, v, lab in rows if v and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = []
    for a in ok:
        for b in ok:
            (x, p), (y, q) = ok[a], ok[b]
            if a < b and p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.append((a, b))
    counts = {i: sum(i in link for link in links) for i, _, _ in rows}
    return links, counts, roots([i for i, _, _ in rows], links)


@pytest.mark.parametrize("how", [{}, {"most": 12, "n_pivots": 16, "near": 6, "shared": 2}])
def test_vectors_against_brute_force(spark, how):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        base = rng.normal(size=32)
        rows += [(len(rows) + k, (base + rng.normal(size=32) * s).astype(np.float32).tolist(), int(c % 3)) for k, s in enumerate([0, 0, 0.05, 0.1, 0.15, 0.2, 1])]
    rows += [(900 + k, rows[0][1], 0) for k in range(30)]
    links, counts, want = brute_vectors(rows)
    got = {r["vec_id"]: r for r in embedding_dedup.link(spark.createDataFrame(rows, VEC).withColumn("node", F.lit("mine")), **how).collect()}
    found = sum(r["n_links"] for r in got.values()) / 2
    assert found <= len(links) and found >= 0.97 * len(links)
    if not how:
        assert {i: r["n_links"] for i, r in got.items()} == counts
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_pivots_are_spread():
    """A crowd of near copies gives one pivot."""
    rng = np.random.default_rng(3)
    crowd = np.eye(8)[0] + rng.normal(size=(500, 8)) * 0.01
    sample = np.vstack([crowd, np.eye(8)])
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    pivots = embedding_dedup._spread(sample, 100)
    assert len(pivots) == 8 and (pivots @ pivots.T - np.eye(8)).max() < embedding_dedup.SPREAD


def test_vectors_of_one_crowd(spark):
    """A label whose vectors are nearly all near copies of one: lists beyond `most` are filed again and cut into blocks; no link is lost."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=24)
    rows = [(i, (base + rng.normal(size=24) * 0.03).astype(np.float32).tolist(), 1) for i in range(150)] + [(200 + i, rng.normal(size=24).astype(np.float32).tolist(), 1) for i in range(60)]
    links, counts, want = brute_vectors(rows)
    got = {r["vec_id"]: r for r in embedding_dedup.link(spark.createDataFrame(rows, VEC), most=20).collect()}
    assert len(links) > 10_000 and sum(r["n_links"] for r in got.values()) >= 0.999 * 2 * len(links)
    assert {i: r["component_id"] for i, r in got.items()} == want


def planted(rng, dim=48):
    """Vectors with links of all kinds: small groups at every distance around the threshold, chains of links just above it, crowds, copies, and many without one."""
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    out = [rng.normal(size=(2500, dim))]
    for size in rng.integers(2, 9, 400):
        base = unit(rng.normal(size=dim))
        out.append(unit(base + rng.normal(size=(size, dim)) * rng.choice([0.005, 0.01, 0.0145, 0.02])))
    for _ in range(40):  # each link turns by the angle of a cosine of 0.981
        v, chain = unit(rng.normal(size=dim)), []
        for _ in range(12):
            w = rng.normal(size=dim)
            w = unit(w - (w @ v) * v)
            v = 0.981 * v + (1 - 0.981**2) ** 0.5 * w
            chain.append(v)
        out.append(np.array(chain))
    for size in (300, 700):
        out.append(unit(unit(rng.normal(size=dim)) + rng.normal(size=(size, dim)) * 0.014))
    v = np.vstack(out)
    v = np.vstack((v, v[:50], v[:50] * 3.0)).astype(np.float32)
    return v, np.where(np.arange(len(v)) % 17 == 5, 1, 0)


def test_planted_links(spark):
    """Recall over several thousand vectors with planted links, at the parameters of the query: at least 0.99 of all links, and none that isn't one."""
    v, labels = planted(np.random.default_rng(11))
    df = spark.createDataFrame([(i, x.tolist(), int(p)) for i, (x, p) in enumerate(zip(v, labels))], VEC)
    got = {r["vec_id"]: r for r in embedding_dedup.link(df).collect()}
    w = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    links = (w @ w.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(links, False)
    want = links.sum(axis=1)
    counts = np.array([got[i]["n_links"] for i in range(len(v))])
    assert len(v) > 5000 and want.sum() > 100_000 and (counts <= want).all()
    few = want < 20  # small groups and chains, which the crowds' many links would hide
    assert counts.sum() >= 0.99 * want.sum() and counts[few].sum() >= 0.99 * want[few].sum() and want[few].sum() > 3000
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in range(len(v)))


def test_pivots_in_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    sample = rng.normal(size=(600, 4))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    want = []
    for x in sample:
        if len(want) < 80 and all(x @ y < embedding_dedup.SPREAD for y in want):
            want.append(x)
    for block in (1, 7, 600):
        assert np.allclose(embedding_dedup._spread(sample, 80, block), want)


def test_vector_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 1), (11, [], 1), (12, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, VEC)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.link(df).collect()}
    assert got == {i: (0, i, True) for i in range(3, 12)} | {1: (2, 1, True), 2: (2, 1, False), 12: (2, 1, False)}
    odd = embedding_dedup.link(spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], VEC)).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in odd) == [(-1, 0, None, False), (1, 1, 1, True), (1, 1, 1, True)]
    assert embedding_dedup.link(df.limit(0)).count() == 0


def test_vector_query(spark):
    same(QUERIES["op8_embedding_dedup"](spark, SMALL), connect(SMALL), OP8_SQL)


@pytest.mark.parametrize("path", ["/root/testdata/sf0.1", "/root/testdata/check_s", "/root/testdata/check_h"])
def test_vector_recall(spark, path):
    """Recall against brute force over all pairs of a label; the check tables have hundreds of thousands of links, one of them most in one group."""
    if not os.path.exists(path):
        pytest.skip("no such table")
    t = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    t = t[t["embedding"].map(lambda x: x is not None and len(x) > 0 and bool(np.isfinite(np.array(x, float)).all()) and bool(np.any(x))) & t["label"].notna()]
    want = 0
    for _, rows in t.groupby("label"):
        v = np.stack(rows["embedding"]).astype(float)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        want += int((v @ v.T >= 0.98).sum()) - len(v)
    got = QUERIES["op8_embedding_dedup"](spark, path).toPandas()["n_links"].sum()
    assert 0.999 * want <= got <= want


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(3)
    words = [f"wort{i}" for i in range(400)]

    def prose(n):
        return "\n".join(" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(n))

    clean = [prose(8) for _ in range(12)]
    parts = [" ".join(rng.choice(words) for _ in range(20)) + "." for _ in range(30)]
    # every third sentence begins with another word: no window of three is the same
    long, near = " ".join(parts), " ".join("other " + x.partition(" ")[2] if i % 3 == 0 else x for i, x in enumerate(parts))
    shared = prose(4)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    rows += [(20, long, "en", "s", len(long)), (21, near, "en", "s", len(near)), (22, clean[0], "en", "s", 1), (23, clean[1] + "\n" + shared, "en", None, 1), (24, clean[2] + "\n" + shared, None, "s", 1)]
    rows += [(40, prose(9), "en", "s", 1), (40, prose(7), "en", "s", 1), (None, prose(8), "en", "s", 1), (41, near, "en", "s", 1), (41, prose(9), "en", "s", 1)]  # repeated ids with texts of their own, and one whose text came before
    rows += [(30, None, "en", "s", 0), (31, "", None, None, None), (32, "123 456 " * 60, "en", "s", 1), (33, "THE!! BIG!! " * 40, "en", "s", 1), (None, prose(9), "en", "s", 1), (20, long, "en", "s", len(long))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"kept": F.lit("k"), "n_lines": F.lit(1)})
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == columns
            kept[name] = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in docs.collect())
            assert docs.filter("n_chars <> length(text)").count() == 0 or name == "language_id"
    assert not {30, 31, 32} & set(kept["language_id"]) and 33 in kept["language_id"]
    assert 33 not in kept["quality_rules"] and set(range(12)) <= set(kept["quality_rules"])
    assert 22 not in kept["line_dedup"] and {-1, *range(12), 20, 21, 23} <= set(kept["line_dedup"])
    assert kept["ngram_jaccard_join"].count(40) == 2 and kept["ngram_jaccard_join"].count(-1) == 2 and kept["ngram_jaccard_join"].count(41) == 1
    assert kept["ngram_jaccard_join"].count(20) == 1 and 21 not in kept["ngram_jaccard_join"] and {-1, *range(12)} <= set(kept["ngram_jaccard_join"])
    assert {r["doc_id"] for r in docs.collect()} == {None if i == -1 else i for i in kept["ngram_jaccard_join"]}


BLANK = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The stock phrases that occur in the test tables, and the ends of sentences.
STOCK = re.compile(r"(^|[^\w])(all rights reserved|licensed under|released under)([^\w]|$)")
ENDS = re.compile("(?<=[.!?\u2026\u0964\u061f][ \t])|(?<=[\u3002\uff01\uff1f])")


def plain_repeated(texts):
    """The lines of up to 120 characters that the texts show between 20 different neighbours, and a 2,000th of the texts, in plain Python."""
    around = {}
    for text in texts:
        lines, seen = [x for x in (x.strip(BLANK) for x in (text or "").split("\n")) if x], set()
        for i, x in enumerate(lines):
            if len(x) <= 120 and x not in seen:
                seen.add(x)
                around.setdefault(x, set()).add((lines[i - 1] if i else None, lines[i + 1] if i + 1 < len(lines) else None))
    return {x for x, n in around.items() if len(n) >= max(20, len(texts) / 2000)}


def plain_rules(text, repeated):
    """The text that the quality rules leave, or None, in plain Python."""
    words, lines = WORD.findall(text), text.split("\n")
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {i + j for i in places for j in range(3)}
    left, lost = [], 0
    for i, line in enumerate(lines):
        n = len(WORD.findall(line))
        ended = re.search("[.!?:;\u2026][\"')\\]\u00bb\u201d]*$", line.rstrip(BLANK)[-4:])
        after = lines[i + 1].lstrip(" \t")[:1] if i + 1 < len(lines) else ""
        bars = sum(line.count(c) for c in "|>·•»")
        bad = n > 0 and (
            (not ended and not (n >= 6 and after.islower())) or len(line) - len(line.replace("!!", "").replace("??", "")) >= n
            or 3 * sum(line.count(c) for c in "#*$%&|<>") >= n or (bars >= 3 and 4 * bars >= n) or bool(STOCK.search(line.lower())) or line.strip(BLANK) in repeated
        )
        if bad:
            lost += sum(map(len, WORD.findall(line)))
        else:
            left.append(line)
    good = len(words) >= 50 and 100 * len(covered) <= 50 * len(words) and 2 * lost <= sum(map(len, words))
    return "\n".join(left) if good else None


def plain_dedup(docs):
    """The texts without later windows of three sentences, in plain Python; documents in the order of their ids."""
    first, out = set(), {}
    for i in sorted(docs):
        units = [(u, k) for k, line in enumerate(docs[i].split("\n")) for u in ENDS.split(line)]
        full = [k for k, (u, _) in enumerate(units) if u.strip(BLANK)]
        gone = set()
        for k in range(len(full) - 2):
            window = tuple(units[x][0].strip(BLANK) for x in full[k : k + 3])
            if window in first:
                gone |= set(full[k : k + 3])
            first.add(window)
        text, line = "", None
        for k, (u, own) in enumerate(units):
            if k not in gone:
                text += ("\n" if line is not None and own != line else "") + u
                line = own
        if text.strip(BLANK):
            out[i] = text
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    """Each stage's rows on the smallest tables are what plain Python makes of the rows before it."""
    docs, folder = spark.read.parquet(f"{SMALL}/documents.parquet"), str(tmp_path)
    texts = {r["doc_id"]: (r["text"], r["lang"]) for r in docs.collect()}
    model = corpus_pipeline.lid.train(docs, "text", "lang")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        made[name] = docs.collect()
    of = {n: {r["doc_id"]: r["text"] for r in made[n]} for n in ("language_id", "quality_rules", "line_dedup", "ngram_jaccard_join")}
    want = {}
    for i, (text, lang) in texts.items():
        (pred,), (score,) = model.predict([text])
        if pred != "und" and (score >= corpus_pipeline.FITS if lang is None else lang == pred or score < corpus_pipeline.REFUTED):
            want[i] = text
    assert of["language_id"] == want
    repeated = plain_repeated(list(want.values()))
    want = {i: t for i, t in ((i, plain_rules(t, repeated)) for i, t in want.items()) if t is not None}
    assert of["quality_rules"] == want and 0 < len(want) < len(texts)
    want = plain_dedup(want)
    assert of["line_dedup"] == want
    _, groups = brute_join(want.items())
    assert of["ngram_jaccard_join"] == {i: t for i, t in want.items() if groups[i] == i}
    from rentlens.llm.queries import vocabulary
    from tests.llm.test_token_ops import checked, plain_tokenizer

    rows = [{"doc_id": i, "text": t} for i, t in of["ngram_jaccard_join"].items()]
    assert checked(made["best_fit_packing"], rows, plain_tokenizer(vocabulary("word_bpe_49k.json")), 2048) <= 1.02 * sum(r["length"] for r in made["best_fit_packing"]) / 2048 + 1


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
        assert empty.count() == 0
