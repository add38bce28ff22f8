"""A corpus pipeline of five stages: language ID, quality rules, line dedup, n-gram Jaccard join, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each one's rows as Parquet to the
shared folder and reads them back as the next one's docs. All but the last return the columns of their docs, with text
and n_chars as the stage leaves them.

Nulls, empty tables and repeated rows: a null or blank text has no letter, so the first stage drops it; rows with a null id are
documents like any other; of rows that repeat id and text, the join keeps one. Texts of any length are processed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm import language_id as lid
from rentlens.llm import ngram_join, packing
from rentlens.llm.line_dedup import OUTPUT as DEDUP_OUTPUT
from rentlens.llm.line_dedup import dedup_lines
from rentlens.llm.quality_rules import OUTPUT, apply_rules
from rentlens.llm.queries import vocabulary
from rentlens.llm.text import free_name
from rentlens.session import cut, own_dir, remove, ship, table

#: Least scores of a prediction that overrides a given language, and of one that stands for a missing one.
REFUTED, FITS = 0.99, 0.55


def _retexted(docs: DataFrame, out: DataFrame, text: Column) -> DataFrame:
    """The columns of docs with a new text and its length."""
    new = {"text": text, **({"n_chars": F.length(text).cast("long")} if "n_chars" in docs.columns else {})}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; of the others those whose language the text refutes (another one is predicted with a score of at
    least REFUTED), and those without a language that none fits (a score below FITS). A missing lang is filled in.

    Without any labelled row there is no model: texts with a letter stay and lang stays null. Ties between languages score one half, so
    they refute nothing. Texts of any length are parsed whole; repeated rows get equal decisions."""
    ship(spark)
    model = lid.train(docs, "text", "lang")
    if not model.langs:
        return docs.filter(F.col("text").rlike("\\p{L}"))
    pred, score = free_name(docs, "predicted"), free_name(docs, "fit")
    out = lid.identify(docs, model, names=(pred, score)).filter(F.col(pred) != "und")
    given, fit = F.col("lang"), F.col(score)
    good = F.when(given.isNull(), fit >= FITS).otherwise((given == F.col(pred)) | (fit < REFUTED))
    filled = F.coalesce("lang", pred).alias("lang")
    return out.filter(good).select(*[filled if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def _through(docs: DataFrame, made: list[str], stage) -> DataFrame:
    """docs with the text that stage(df) puts into clean_text, under a filter of its own; columns named like its results are kept."""
    own = {c: free_name(docs, f"own_{c}") for c in docs.columns if c in made}
    out = stage(docs.withColumnsRenamed(own))
    clean = free_name(docs, "clean")
    return _retexted(docs, out.withColumnRenamed("clean_text", clean).drop(*made).withColumnsRenamed({b: a for a, b in own.items()}), F.col(clean))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines are removed; documents that fail go. Rows are judged one by one, texts of any length whole, so ties and repeats don't matter; null and empty texts go."""
    return _through(docs, OUTPUT, lambda df: apply_rules(df).filter("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-sentence windows are removed, also inside lines; documents left without a word go.

    The first occurrence is that of the smallest id, then text hash, then place; rows that repeat id and text get the same result."""
    return _through(docs, DEDUP_OUTPUT, lambda df: dedup_lines(df, sentences=True).filter(F.col("clean_text").rlike("[^\\x20\\x09-\\x0D]")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id.

    Documents are texts: where rows repeat an id or have none, one text keeps the id and each other one gets a key from its hash, larger
    than other ids, so that no text is lost with its id. Rows that repeat id and text are one document, of which one row stays."""
    ship(spark)
    key, low = free_name(docs, "key"), free_name(docs, "low")
    hashed = F.xxhash64("doc_id", "text")
    again = cut(docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").select("doc_id"))
    unique = again.isEmpty()
    if unique:
        keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    else:
        of = free_name(docs, "of")
        ids = again.withColumnRenamed("doc_id", of)
        lows = docs.join(ids, F.col("doc_id").eqNullSafe(F.col(of))).groupBy(of).agg(F.min(hashed).alias(low))
        marked = docs.join(lows, F.col("doc_id").eqNullSafe(F.col(of)), "left")
        own = F.col(low).isNotNull() & (F.col("doc_id").isNull() | (hashed != F.col(low)))
        keyed = marked.withColumn(key, F.when(own, F.lit(1 << 62) + F.shiftrightunsigned(hashed, 2)).otherwise(F.col("doc_id").cast("long"))).drop(of)
    classes = cut(ngram_join.link(keyed, key))
    gone = classes.filter("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct()
    kept = keyed.join(gone, key, "left_anti")
    if not unique:
        kept = kept.filter(F.col(low).isNull()).unionByName(kept.filter(F.col(low).isNotNull()).dropDuplicates([key]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place; long texts are cut, no row is left out. Equal pieces go in any order."""
    ship(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express language ID or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's rows go when the next one's are written; the last one's with the driver."""
    docs, folder = table(spark, sf_dir, "documents"), own_dir(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return docs
