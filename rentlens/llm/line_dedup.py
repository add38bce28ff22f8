"""Line dedup by overlapping three-line windows, in native DataFrame functions only.

The lines of a document that have a word form windows of three consecutive ones (trimmed; blank
lines in between don't matter). A window's 128-bit hash is looked for in the whole corpus; its
first occurrence, by (document id, text hash, line), stays, and every later one is removed: the
covered positions of all later windows of a document are merged and those lines go.

Two aggregations only, both with map-side partial sums: one finds the first occurrence of each
repeated hash, one gathers a document's positions. The join between them has its hot side
on repeated hashes. The first occurrences are written to the checkpoint folder before it: a sort-merge join of two plain shuffles is one
whose hot partitions adaptive execution splits, a join to an aggregation of the same keys isn't.

Null and empty texts, and documents of fewer than three lines with a word, have no window and stay as
they are (null text: empty). Rows that repeat both id and text count as one document: none of
them is later than the other, so they get the same result. A null id is an id like any other, before all others.
With sentences, the units are the sentences of each line instead of whole lines, so that repeated passages inside
long lines, and the ends of passages that begin or end inside a line, are found too; a line goes when all its sentences went.
A window that overlaps its own first occurrence (one line many times over) is a later one. Texts of any length are taken whole. Other
columns of the input pass through, whatever their names; columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import text as T
from .text import free_name

WINDOW = 3
OUTPUT = ["n_lines", "n_removed", "clean_text"]
#: Where a sentence ends inside a line: its mark and the blank after it stay with it.
SENTENCE_END = "(?<=[.!?\\x{2026}\\x{0964}\\x{061F}][ \\t])|(?<=[\\x{3002}\\x{FF01}\\x{FF1F}])"


def _units(text: Column, sentences: bool) -> Column:
    """Structs (x text, l number of its line) of all units."""
    if not sentences:
        return F.transform(T.lines(text), lambda x, l: F.struct(x.alias("x"), l.alias("l")))
    return F.flatten(F.transform(T.lines(text), lambda x, l: F.transform(F.split(x, SENTENCE_END, -1), lambda s: F.struct(s.alias("x"), l.alias("l")))))


def _full_units(text: Column, sentences: bool) -> Column:
    """Structs (line trimmed, i place among all units) of the units with a word."""
    units = F.transform(_units(text, sentences), lambda u, i: F.struct(F.trim(F.translate(u["x"], "\t\x0b\x0c\r", "    ")).alias("line"), i.alias("i")))
    return F.filter(units, lambda x: F.length(x["line"]) > 0)


def _windows(text: Column, sentences: bool) -> Column:
    """Structs (h1, h2, k) of each window; k counts units with a word."""

    def of(ls: Column) -> Column:
        def one(k: Column) -> Column:
            cols = [F.get(ls, k + j)["line"] for j in range(WINDOW)]
            return F.struct(F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit(1), *cols).alias("h2"), k.alias("k"))

        return F.when(F.size(ls) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(ls) - WINDOW), one))

    return T.let(_full_units(text, sentences), of)


def _joined(units: Column) -> Column:
    """Text of units in order; a new line starts where the line number changes."""
    return F.array_join(F.transform(units, lambda u, i: F.concat(F.when(F.get(units, i - 1)["l"] != u["l"], "\n").otherwise(""), u["x"])), "")


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, sentences: bool = False) -> DataFrame:
    """df with n_lines (units with a word), n_removed, and clean_text without the removed units."""
    body = F.col(f"`{text}`")
    key = df.select(F.col(f"`{doc_id}`").alias("d"), F.xxhash64(body).alias("t"), body.alias("x"))
    seen = key.select("d", "t", F.explode(_windows(F.col("x"), sentences)).alias("w")).select("d", "t", "w.h1", "w.h2", "w.k")
    at = F.struct("d", "t", "k")
    first = seen.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.max(at).alias("last")).filter(F.col("first") != F.col("last")).drop("last")
    later = seen.join(cut(first), ["h1", "h2"]).filter(at > F.col("first"))
    # names that df doesn't have, for what the join brings
    d, t, ks, h = (free_name(df, n) for n in ("of_doc", "of_text", "places", "hash"))
    places = later.groupBy("d", "t").agg(F.collect_set("k").alias(ks)).withColumnsRenamed({"d": d, "t": t})
    marked = df.withColumn(h, F.xxhash64(body))
    joined = marked.join(places, F.col(f"`{doc_id}`").eqNullSafe(F.col(d)) & (F.col(h) == F.col(t)), "left")
    full = F.transform(_full_units(body, sentences), lambda x: x["i"])

    def cleaned(units: Column) -> Column:
        covered = F.array_distinct(F.flatten(F.transform(F.col(ks), lambda k: F.array(*[k + j for j in range(WINDOW)]))))
        gone = F.transform(covered, lambda k: F.get(units, k))
        out = T.let(
            _units(body, sentences),
            lambda us: T.let(F.transform(F.array_except(F.sequence(F.lit(0), F.size(us) - 1), gone), lambda i: F.get(us, i)), _joined),
        )
        return F.struct(
            F.size(units).cast("long").alias("n_lines"),
            F.when(F.col(ks).isNull(), 0).otherwise(F.size(covered)).cast("long").alias("n_removed"),
            F.when(F.col(ks).isNull(), F.coalesce(body, F.lit(""))).otherwise(out).alias("clean_text"),
        )

    others = [F.col(f"`{c}`") for c in df.columns if c not in OUTPUT]
    # a generator, so that a filter on the results doesn't compute them again
    return joined.select(*others, F.inline(F.transform(F.array(full), cleaned)))
