"""Packing, token files and byte-level BPE."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rentlens.llm import byte_bpe, packing, token_files
from rentlens.llm.queries import QUERIES
from rentlens.llm.word_bpe import WordBpe
from tests.oracle import SMALL

WORDS = P.path("word_bpe_49k.json")
BYTES = P.path("byte_bpe_multi_50k.tiktoken")
DOC = "doc_id long, text string"
CASES = [(3, "hello world, it's 2024!"), (1, None), (2, ""), (5, "ab " * 6000), (3, "hello world, it's 2024!"), (None, "x y"), (9, "naïve Ünï 日本 <|endoftext|> ''s"), (4, "   \n\t ")]


def plain_tokenizer(path):
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def plain():
    return plain_tokenizer(WORDS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(CASES, DOC).withColumns({"piece": F.lit("mine"), "length": F.lit(0), "ids": F.lit("x")})


def test_word_bpe_equals_library(plain):
    random.seed(4)
    bpe, bits = WordBpe(WORDS), ["the", "ing", "É", "ß", " ", "  ", "\n", "'s", "'re", "'", "!!", "9", "½", "'ll've", "日", "\x85", "\xa0", "<|endoftext|>", "Tion", "x"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 40))) for _ in range(600)]
    assert bpe.quick is not None
    assert [a.tolist() for a in bpe.encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_bins():
    random.seed(1)
    bins, used = packing.Bins(100, 8), {}
    for _ in range(3000):
        n = random.randint(1, 100)
        b, at = bins.place(n)
        assert used.get(b, 0) == at and at + n <= 100
        used[b] = at + n
        assert bins.n_open == sum(map(len, bins.free)) <= 8
    assert packing.Bins(10, 2).place(10) == (0, 0)


def checked(rows, docs, plain, size):
    ids = {}
    for r in docs:
        ids.setdefault(r["doc_id"], np.array(plain.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4"))
    places = {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["start"] == r["piece"] * size
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, n in sorted(p):
            assert offset == at
            at += n
        assert at <= size
    assert sum(r["length"] for r in rows) == sum(len(ids[r["doc_id"]]) for r in docs)
    return len(places)


def test_packing(spark, docs, plain):
    rows = packing.pack(docs, WORDS).collect()
    checked(rows, docs.collect(), plain, 2048)
    assert packing.pack(docs.limit(0), WORDS).count() == 0


def test_packing_query(spark, plain):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = QUERIES["op3_packing"](spark, SMALL).collect()
    assert checked(rows, docs, plain, 2048) <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


def test_packing_in_groups(spark, plain):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = packing.pack(docs, WORDS, size=256, open_bins=16, group_pieces=100).collect()
    checked(rows, docs.collect(), plain, 256)


def test_packing_more_bins_than_open(spark, plain):
    docs = spark.createDataFrame([(i, "ab " * (i * 37 % 60)) for i in range(2000)], DOC)
    rows = packing.pack(docs, WORDS, size=128, open_bins=64).collect()
    n = checked(rows, docs.collect(), plain, 128)
    assert 64 < n <= 1.02 * sum(r["length"] for r in rows) / 128


def test_packing_blocks():
    import pyarrow as pa

    for sizes in ([0, 3, 9, 1, 0], [4, 4], [2], []):
        at, batches = 0, []
        for k in sizes:
            batches.append(pa.record_batch([pa.array(range(at, at + k), pa.int64())], ["x"]))
            at += k
        got = [t.column("x").to_pylist() for t in packing.blocks(iter(batches), 4)]
        assert got == [list(range(i, min(i + 4, at))) for i in range(0, at, 4)]


def test_index():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 5000).astype(np.uint64))
    index = token_files.Index.parse(memoryview(token_files.Index.build(keys, np.arange(len(keys))).dump()))
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert (index.find(keys + np.uint64(1)) >= 0).sum() <= 2
    none = token_files.Index.parse(memoryview(token_files.Index.build(keys[:0], np.arange(0)).dump()))
    assert (none.find(keys[:3]) == -1).all()


def test_token_files(spark, docs, plain, tmp_path):
    path = f"file://{tmp_path}/set"
    manifest = token_files.write(docs, path, WORDS, partitions=3, shard_ids=100)
    assert len(manifest["shards"]) > 1
    got = token_files.read(spark, path).orderBy("start").collect()
    want, start = [], 0
    for key, text in sorted(CASES, key=lambda c: (c[0] is not None, c[0] or 0)):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    reader = token_files.Reader(path)
    for key, text in CASES:
        assert reader[key].tolist() == plain.encode(text or "", add_special_tokens=False).ids + [2]
    with pytest.raises(KeyError):
        reader[777]
    empty = f"file://{tmp_path}/empty"
    token_files.write(docs.limit(0), empty, WORDS)
    assert token_files.read(spark, empty).count() == 0
    with pytest.raises(KeyError):
        token_files.Reader(empty)[1]


def test_token_files_read_through_the_index(spark, docs, tmp_path):
    """Rows come from where the index leads: one that leads elsewhere gives other rows, or an error, not the file's order."""
    path = f"file://{tmp_path}/set"
    token_files.write(docs, path, WORDS, partitions=1)
    manifest = token_files.Reader(path).manifest
    name = f"{tmp_path}/set/{manifest['shards'][0]['name']}.idx"
    raw, right = open(name, "rb").read(), {(r["doc_id"], r["start"]) for r in token_files.read(spark, path).collect()}
    n = len(set(k for k, _ in CASES))
    values = np.frombuffer(raw[-8 * n :], "<i8")
    repeated = sorted(k for k, _ in CASES if k is not None).index(3) + 1
    alone = [i for i, v in enumerate(values) if v != repeated]
    swapped = values.copy()
    swapped[alone[:2]] = values[alone[1::-1]]
    open(name, "wb").write(raw[: -8 * n] + swapped.tobytes())
    assert {(r["doc_id"], r["start"]) for r in token_files.read(spark, path).collect()} != right
    open(name, "wb").write(raw[: -8 * n] + np.zeros(n, "<i8").tobytes())
    with pytest.raises(Exception, match="lead to each stored document"):
        token_files.read(spark, path).collect()


def test_repeated_keys_have_an_order(spark, tmp_path):
    """Rows that repeat a key with other texts are stored in one order, whatever order they come in."""
    rows = [(1, "some words"), (1, "other words"), (1, ""), (2, "x"), (1, "some words")]
    made = []
    for i, order in enumerate((rows, rows[::-1])):
        token_files.write(spark.createDataFrame(order, DOC), f"file://{tmp_path}/{i}", WORDS, partitions=2)
        made.append([tuple(r) for r in token_files.read(spark, f"file://{tmp_path}/{i}").orderBy("start").collect()])
    assert made[0] == made[1] and len(made[0]) == 5


def test_long_text_among_short_ones(plain):
    bpe, texts = WordBpe(WORDS), ["a b", "word and more, " * 150_000, "c", "日本", "x" * 10]
    assert [len(a) for a in bpe.encode(texts)] == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_files_query(spark, plain):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    got = QUERIES["op5_token_files"](spark, SMALL).orderBy("doc_id").collect()
    ids = [np.array(e.ids + [2], "<u4") for e in plain.encode_batch([d["text"] for d in docs], add_special_tokens=False)]
    starts = np.append(0, np.cumsum([len(i) for i in ids]))[:-1]
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == [(d["doc_id"], int(s), len(i), zlib.crc32(i.tobytes())) for d, s, i in zip(docs, starts, ids)]


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("leaf", [8, 4096])
def test_byte_bpe_equals_library(monkeypatch, leaf):
    monkeypatch.setattr(byte_bpe, "LEAF", leaf)
    own, lib = byte_bpe.ByteBpe(byte_bpe.read_ranks(BYTES), P.PATTERN), library()
    random.seed(leaf)
    for k in range(1500):
        letters = ["ab e", "aabehtinsé日 '\n\t09!.?ſ   'll're", "aaaaaaab", "tion he"][k % 4]
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 150)))
        text = text.replace(" ", "") if k % 5 == 0 else text
        ids = own.encode(text)
        assert ids == lib.encode_ordinary(text)
        assert own.decode(ids) == text.encode()
    assert own.encode("x" * 50_000) == lib.encode_ordinary("x" * 50_000)


def test_byte_bpe_columns(spark, docs):
    lib = library()
    ids = byte_bpe.encode_column(docs, BYTES, P.PATTERN)
    out = byte_bpe.decode_column(ids, BYTES, P.PATTERN).collect()
    assert len(out) == len(CASES) and ids.columns.count("ids") == 1
    for r in out:
        assert r["ids"] == lib.encode_ordinary(r["text"] or "") and bytes(r["bytes"]) == (r["text"] or "").encode()
    assert byte_bpe.encode_column(docs.limit(0), BYTES, P.PATTERN).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r["bytes"]) for r in byte_bpe.decode_column(nulls, BYTES, P.PATTERN).collect()] == [b"", b""]


def test_byte_bpe_query(spark):
    import hashlib

    lib, docs = library(), {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op9_byte_bpe"](spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = lib.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest())
