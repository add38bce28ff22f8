"""Line-first quality rules, in native column expressions only; texts are never shuffled.

Each \\n-split line with a word is judged alone: it fails the punctuation rule (no closing mark at its end, or doubled marks / symbols
on many of its words), the navigation rule (separators between short items) or the boilerplate rule (a stock phrase as whole words, or a
line that the corpus repeats).
Closing marks are those of Latin, Arabic, Indic and East Asian scripts; a line of WRAPPED words or more needs none if the next line goes on in
lower case, as a hard-wrapped paragraph is judged by its last line. Failed lines are removed; a document that loses more than max_loss of
its word characters is rejected, as is one that fails the base rules (too few words, or mostly repeated three-word windows).

A line of up to max_chars characters is repeated boilerplate if documents show it between many different neighbours: at least `least` different pairs of
lines before and after it, and at least `share` times the number of documents. Each document counts its first one only, so neither a document that repeats
a line nor copies of a document, however many, make boilerplate; longer repeated passages are line dedup's. Lines are counted by 64-bit hashes, in two
aggregations with partial sums. As each of these lines is in a share of the documents, there are at most 1/share times the lines of an average document,
whatever the corpus: so they go to all tasks, as a scalar subquery.

All results come from one struct behind a generator, so that a filter on them doesn't compute them again.

Null, empty and blank texts have no words, so they fail the base rules and are not kept; their cleaned text is empty. Texts of any length
are judged whole. Repeated rows get equal results, other columns pass through, whatever their names, and a column of the input with the name
of an output is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

#: Symbols that count, closing marks (. ! ? : ; and their like in other scripts) with what may follow them, separators.
SYMBOLS = "#*$%&|<>"
CLOSING = (
    "[.!?:;\\x{2026}\\x{061B}\\x{061F}\\x{06D4}\\x{0964}\\x{0965}\\x{3002}\\x{FF01}\\x{FF0E}\\x{FF1A}\\x{FF1B}\\x{FF1F}\\x{FF61}]"
    "[\"')\\]\\x{00BB}\\x{201D}\\x{2019}\\x{300D}\\x{300F}\\x{3011}\\x{FF09}]*$"
)
SEPARATORS = "|>·•»"
#: Stock phrases of web pages and licences.
PHRASES = [
    "accept cookies", "alle rechte vorbehalten", "all rights reserved", "click here", "conditions générales", "cookie policy", "copyright (c)", "copyright ©",
    "datenschutzerklärung", "enable javascript", "haga clic aquí", "iniciar sesión", "licensed under", "log in", "mentions légales", "politique de confidentialité",
    "política de privacidad", "privacy policy", "released under", "se connecter", "sign up", "subscribe to", "terms of service", "terms of use", "todos los derechos reservados", "tous droits réservés",
]
WRAPPED = 6
#: A repeated line: longest, different neighbours at least, share of the documents at least.
MAX_CHARS, LEAST, SHARE = 120, 20, 1 / 2000
OUTPUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "chars_lost", "base_failed", "kept", "clean_text"]

_STOCK = "(^|[^\\p{L}\\p{N}])(" + "|".join(p.replace("(", "\\(").replace(")", "\\)") for p in PHRASES) + ")([^\\p{L}\\p{N}]|$)"


def _repeat_words(words: Column) -> Column:
    """Positions inside three-word windows that occur twice or more, counted once each.

    Hashes of the windows tell which may repeat; only those are then compared as strings."""

    def hashes(w: Column) -> Column:
        n = F.size(w) - 2
        h = F.transform(w, lambda x: F.xxhash64(x))
        return T.let(h, lambda h: F.zip_with(F.zip_with(F.slice(h, 1, n), F.slice(h, 2, n), lambda a, b: F.xxhash64(a, b)), F.slice(h, 3, n), lambda ab, c: F.xxhash64(ab, c)))

    def exact(w: Column, h: Column) -> Column:
        ordered = F.sort_array(h)
        twice = T.let(ordered, lambda s: F.array_distinct(F.filter(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull())))
        places = T.let(twice, lambda d: F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(d, x), i)), lambda i: i.isNotNull()))
        return _covered(F.transform(places, lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("w"), i.alias("i"))))

    def covered(w: Column) -> Column:
        return T.let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact(w, h)))

    return T.let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(covered(w)))


def _covered(windows: Column) -> Column:
    """Sort (window, place); equal neighbours repeat; count the places that their windows cover."""

    def repeated(s: Column) -> Column:
        def place(x: Column, j: Column) -> Column:
            same = (F.get(s, j - 1)["w"] == x["w"]) | (F.get(s, j + 1)["w"] == x["w"])
            return F.when(F.coalesce(same, F.lit(False)), x["i"])

        return F.filter(F.transform(s, place), lambda i: i.isNotNull())

    places = T.let(F.sort_array(windows), repeated)
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))


def _suspect(text: Column) -> Column:
    """Whether a text has one of the stock phrases anywhere; only then are its lines searched."""
    low = F.lower(text)
    return T.let(low, lambda x: F.lit(False) if not PHRASES else _any([x.contains(p) for p in PHRASES]))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(T.BLANKS))


def repeated_lines(df: DataFrame, text: str = "text", *, max_chars: int = MAX_CHARS, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """(h, n): hashes of the lines that the corpus repeats between n different neighbours; see above."""
    lines = F.filter(F.transform(T.lines(F.col(f"`{text}`")), _trimmed), lambda x: F.length(x) > 0)

    def firsts(ls: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            around = F.xxhash64(F.get(ls, i - 1), F.get(ls, i + 1))
            return F.when(F.length(x) <= max_chars, F.struct(F.xxhash64(x).alias("h"), i.alias("i"), around.alias("around")))

        short = F.sort_array(F.filter(F.transform(ls, one), lambda x: x.isNotNull()))
        return T.let(short, lambda s: F.filter(F.transform(s, lambda x, j: F.when(~F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)), x)), lambda x: x.isNotNull()))

    each = df.select(F.explode(T.let(lines, firsts)).alias("x")).select("x.h", "x.around").distinct().groupBy("h").agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return each.filter(F.col("n") >= least).join(F.broadcast(total), F.col("n") >= F.col("total") * share).select("h", "n")  # total: one row


def _failed(line: Column, after: Column, suspect: Column, repeated: Column) -> Column:
    """Whether a line that has words fails one of the three rules; after is the next line, repeated the hashes of the document's repeated lines."""
    end = F.right(F.rtrim(line, F.lit(T.BLANKS)), F.lit(4))
    n = F.regexp_count(line, F.lit(T.WORD_START_RE))
    doubled = F.length(line) - F.length(F.replace(F.replace(line, F.lit("!!"), F.lit("")), F.lit("??"), F.lit("")))
    bars = T.count(line, SEPARATORS)
    goes_on = F.coalesce(after.rlike("^[\\x20\\x09]*\\p{Ll}"), F.lit(False))
    rules = T.let(
        F.struct(n.alias("n"), doubled.alias("d"), bars.alias("b"), T.count(line, SYMBOLS).alias("s")),
        lambda x: (~end.rlike(CLOSING) & ~((x["n"] >= WRAPPED) & goes_on)) | (x["d"] >= x["n"]) | (3 * x["s"] >= x["n"]) | ((x["b"] >= 3) & (4 * x["b"] >= x["n"])),
    )
    return rules | (suspect & F.lower(line).rlike(_STOCK)) | ((F.size(repeated) > 0) & F.array_contains(repeated, F.xxhash64(_trimmed(line))))


def apply_rules(df: DataFrame, text: str = "text", *, min_words: int = 50, max_repeat: float = 0.5, max_loss: float = 0.5, max_chars: int = MAX_CHARS, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """df with the columns of OUTPUT; clean_text is the text without its failed lines. max_chars, least and share say what a repeated line is."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    everywhere = F.coalesce(repeated_lines(df, text, max_chars=max_chars, least=least, share=share).agg(F.collect_list("h")).scalar(), F.array().cast("array<bigint>"))

    # a column of its own, as there are no subqueries inside lambdas
    own = T.free_name(df, "repeated")
    hashes = F.transform(F.filter(F.transform(T.lines(body), _trimmed), lambda x: F.length(x).between(1, max_chars)), lambda x: F.xxhash64(x))
    source = df.withColumn(own, F.array_intersect(hashes, everywhere))

    def judged(ls: Column, suspect: Column, repeated: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            return F.struct(x.alias("line"), T.has_word(x).alias("full"), F.when(T.has_word(x), _failed(x, F.get(ls, i + 1), suspect, repeated)).otherwise(False).alias("bad"))

        return F.transform(ls, one)

    facts = T.let(
        T.let(F.struct(T.lines(body).alias("ls"), _suspect(body).alias("suspect"), F.col(own).alias("repeated")), lambda x: judged(x["ls"], x["suspect"], x["repeated"])),
        lambda j: T.let(
            F.filter(j, lambda x: x["full"]),
            lambda full: F.struct(
                F.size(full).cast("long").alias("n_lines"),
                (F.size(full) - F.size(F.array_distinct(F.transform(full, lambda x: x["line"])))).cast("long").alias("n_dup_lines"),
                F.size(F.filter(full, lambda x: x["bad"])).cast("long").alias("n_failed_lines"),
                F.aggregate(F.filter(full, lambda x: x["bad"]), F.lit(0), lambda a, x: a + T.solid(x["line"])).cast("long").alias("chars_lost"),
                F.array_join(F.transform(F.filter(j, lambda x: ~x["bad"]), lambda x: x["line"]), "\n").alias("clean_text"),
            ),
        ),
    )
    counts = T.let(T.words(body), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    parts = F.struct(facts.alias("f"), counts.alias("c"), T.solid(body).cast("long").alias("word_chars"), T.count(body, SYMBOLS).cast("long").alias("n_symbols"))

    def results(p: Column) -> Column:
        f, c = p["f"], p["c"]
        failed = (c["n_words"] < min_words) | (c["n_repeat_words"] > max_repeat * c["n_words"])
        made = {
            "n_words": c["n_words"], "word_chars": p["word_chars"], "n_symbols": p["n_symbols"], "n_dup_lines": f["n_dup_lines"], "n_repeat_words": c["n_repeat_words"],
            "n_lines": f["n_lines"], "n_failed_lines": f["n_failed_lines"], "chars_lost": f["chars_lost"], "base_failed": failed,
            "kept": ~failed & (f["chars_lost"] <= max_loss * p["word_chars"]), "clean_text": f["clean_text"],
        }
        return F.struct(*[made[name].alias(name) for name in OUTPUT])

    others = [F.col(f"`{c}`") for c in df.columns if c not in OUTPUT]
    return source.select(*others, F.inline(T.let(F.array(parts), lambda a: F.transform(a, results))))
