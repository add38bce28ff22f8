"""URL filters: a list of given rules first, mined association rules for the rest.

A given rule is a host (with all its subdomains) and a path prefix; the longest that fits wins.

Mined rules: the tokens of labelled URLs (scheme, host and each of its parent domains, path words, file ending, query keys; numbers are left out)
and their label go through FP-growth, which finds token sets that are frequent together with a label. What a set is worth is then counted on
the full tokens of all labelled URLs. A rule blocks (allows) if its URLs are blocked at least min_lift times as often (seldom) as all URLs,
with at least min_score standard deviations from chance, on two thirds of the labelled URLs, and again by min_lift on the
other third, which mining didn't see. So confidence is judged against the base rate, and a rule that only chance made goes. A rule with more tokens
stays only if it is stronger than those with one token less. All frequent tokens of a URL are mined, and every rule is found. Tokens that are in just the same
labelled URLs are mined as one, as a set with two of them has the rows of the set with one less, and each of them then makes a rule of its own: so a long path that comes
again and again costs no more than one word. Sets of tokens that are frequent together, yet not in the same URLs, are as many as they are; max_items, if given, counts
a URL with so many of its tokens that tell most, in mining alone, and may miss rules. Words of
the path with a digit (mostly ids) are left out; numbers=True takes them too, for rules such as page2 or v1. Each rule is filed under its rarest token; a URL's
tokens find the rules filed under them, which are then checked whole. Of several that fit the strongest counts; ties go to the longer, then
to the one last by its tokens. Matching runs on distinct token sets, so a host with a third of all rows is matched once for each of its token sets.

Null URLs and URLs without `://` have empty host and path and no rule fits them; the mined rules see no tokens and leave the default verdict.
Repeated rows get equal verdicts. An empty label table mines nothing. URLs of any length are taken whole. Other columns pass through, whatever their
names; columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, product

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import text as T

#: The rules of the contract, as (host/path, verdict).
RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]
LABELS = {"label:block": "block", "label:allow": "allow"}
RULE = "rule_tokens array<string>, verdict string, n_rows long, rate double, strength double, held_out_rows long, held_out_rate double, index_token string"


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, T.lower_ascii(F.regexp_extract(F.substring(url, at + 3, F.length(url)), "^[^/?#]*", 0))), F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.regexp_extract(F.substring(url, at + 3, F.length(url)), "^[^/?#]*([^?#]*)", 1)), F.lit(""))


def parents(host: Column) -> Column:
    """The host and each domain above it."""
    labels = F.split(host, "\\.", -1)
    return T.let(labels, lambda x: F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x)), ".")))


def listed(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does. The list is a parameter, part of the plan."""
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        by_host.setdefault(h.lower(), []).append(("/" + p, rule, verdict))
    if not by_host:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    filed = F.create_map(*[x for h, rs in by_host.items() for x in (F.lit(h), F.array(*[F.struct(F.lit(-len(r)).alias("n"), F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(p).alias("path")) for p, r, v in rs]))])
    found = F.flatten(F.transform(parents(host), lambda h: F.coalesce(F.try_element_at(filed, h), F.array().cast("array<struct<n:int,rule:string,verdict:string,path:string>>"))))
    best = F.get(F.sort_array(F.filter(found, lambda r: F.startswith(path, r["path"]))), F.lit(0))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def tokens(url: Column, numbers: bool = False) -> Column:
    """Sorted distinct tokens of a URL; words of the path with a digit only with numbers."""
    host, path = host_of(url), path_of(url)
    words = F.filter(F.split(F.lower(path), "[/._-]+"), lambda w: (w != "") & (F.lit(numbers) | ~w.rlike("[0-9]")))
    keys = F.regexp_extract_all(F.regexp_extract(url, "\\?([^#]*)", 1), F.lit("(?:^|&)([^=&]+)"), 1)
    scheme = F.when(host != "", F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))))).otherwise(F.array().cast("array<string>"))
    hosts = F.when(host != "", F.transform(parents(host), lambda h: F.concat(F.lit("host:"), h))).otherwise(F.array().cast("array<string>"))
    all_tokens = F.concat(scheme, hosts, F.transform(words, lambda w: F.concat(F.lit("path:"), w)), F.transform(keys, lambda k: F.concat(F.lit("key:"), k)))
    return F.coalesce(F.array_sort(F.array_distinct(all_tokens)), F.array().cast("array<string>"))


def _items(rows: DataFrame, known: dict[str, tuple[int, float]], most: int | None) -> DataFrame:
    """The items of each labelled row (tokens, blocked): its frequent tokens, those that tell most first, and its label. known: rows and weight of each token to mine.

    A domain that has the rows of one below it, no others, is left out, as it says the same."""
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def said(token: str, others: list[str]) -> bool:
        end = "." + token[5:]
        return token.startswith("host:") and any(o.endswith(end) and o.startswith("host:") and sent.value[o][0] == sent.value[token][0] for o in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, allow = LABELS
        for batch in batches:
            out = []
            for tokens, blocked in zip(batch.column("tokens").to_pylist(), batch.column("blocked").to_pylist()):
                some = [t for t in tokens if t in sent.value]
                some = sorted((t for t in some if not said(t, some)), key=lambda t: (-sent.value[t][1], t))
                out.append([*some[:most], block if blocked else allow])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], ["items"])

    return rows.select("tokens", "blocked").mapInArrow(run, "items array<string>")


def _spelled(rules: DataFrame, twins: dict[str, list[str]]) -> DataFrame:
    """rules, and the same with tokens that are in the same URLs, one in the place of the other. twins: all such tokens, by the one that was mined."""
    sent, kind = rules.sparkSession.sparkContext.broadcast(twins), rules.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                choices = product(*[sent.value.get(t, [t]) for t in row["rule_tokens"]])
                at = row["rule_tokens"].index(row["index_token"])
                while some := list(islice(choices, 1024)):
                    yield pa.RecordBatch.from_pylist([row | {"rule_tokens": sorted(c), "index_token": c[at]} for c in some], batch.schema)

    return rules.mapInArrow(run, kind)


def mine(df: DataFrame, *, min_support: float = 0.002, min_rows: int = 20, min_lift: float = 1.25, min_score: float = 2.0, max_items: int | None = None) -> DataFrame:
    """Rules (see RULE) from labelled token sets: tokens, blocked, held_out (whether a row is for the second look)."""
    spark = df.sparkSession
    rows = cut(df.filter(F.col("blocked").isNotNull() & (F.size("tokens") > 0)).select("tokens", "blocked", "held_out"))
    one = lambda test: F.count_if(test).cast("long")
    held, bad = F.col("held_out"), F.col("blocked")
    counts = [one(~held).alias("n"), one(~held & bad).alias("bad"), one(held).alias("hn"), one(held & bad).alias("hbad")]
    base = rows.agg(*counts).first()
    if not 0 < base["bad"] < base["n"] or not 0 < base["hbad"] < base["hn"]:
        return spark.createDataFrame([], RULE)
    sets = cut(rows.groupBy("tokens").agg(*counts))
    share, held_share = base["bad"] / base["n"], base["hbad"] / base["hn"]
    least = max(min_rows, min_support * base["n"])
    # a row has few tokens on average, so at most that many times 1 / min_support are frequent: they fit the driver
    marks = [F.xxhash64(F.lit(seed), "tokens").cast("decimal(38,0)").alias(f"m{seed}") for seed in (1, 2)]
    which = [F.count("*").alias("sets"), F.sum("m1").alias("m1"), F.sum("m2").alias("m2")]  # equal for tokens of the same sets
    frequent = sets.select("n", "bad", *marks, F.explode("tokens").alias("t")).groupBy("t").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), *which).filter(F.col("n") >= least)
    tells = F.abs(F.col("bad") - F.col("n") * share) / F.sqrt(F.col("n"))
    known, twins = {}, {}
    for r in frequent.select("t", "n", tells.alias("w"), "sets", "m1", "m2").toLocalIterator():
        known[r["t"]] = (r["n"], r["w"])
        # domains that say the same are left out by their names, see _items
        twins.setdefault(r["t"] if r["t"].startswith("host:") else (r["sets"], r["m1"], r["m2"]), []).append(r["t"])
    if not known:
        return spark.createDataFrame([], RULE)
    twins = {min(ts): sorted(ts) for ts in twins.values()}
    known = {t: known[t] for t in twins}
    twins = {t: ts for t, ts in twins.items() if len(ts) > 1}
    items = _items(rows.filter(~held), known, max_items)
    found = FPGrowth(itemsCol="items", minSupport=min_support).fit(items).freqItemsets.select("items")
    made = [F.when(F.array_contains("items", label), F.lit(verdict)) for label, verdict in LABELS.items()]
    rarest = spark.createDataFrame([(t, n) for t, (n, _) in known.items()], "t string, f long")
    plain = found.withColumn("verdict", F.coalesce(*made)).filter("verdict is not null").select("verdict", F.array_sort(F.array_except("items", F.array(*map(F.lit, LABELS)))).alias("rule_tokens"))
    # a domain next to one below it adds nothing to a set
    below = lambda x: F.exists("rule_tokens", lambda y: x.startswith("host:") & y.startswith("host:") & y.endswith(F.concat(F.lit("."), F.substring(x, 6, F.length(x)))))
    plain = plain.filter((F.size("rule_tokens") > 0) & ~F.exists("rule_tokens", below))
    each = plain.withColumn("t", F.explode("rule_tokens")).join(rarest, "t")
    # written before it is joined: adaptive execution splits the hot keys of a join of plain shuffles only
    filed = cut(each.groupBy("verdict", "rule_tokens").agg(F.min_by("t", F.struct("f", "t")).alias("index_token")))
    fit = sets.withColumn("index_token", F.explode("tokens")).join(filed, "index_token").filter(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    sums = [F.sum(c).alias(c) for c in ("n", "bad", "hn", "hbad")]
    told = fit.groupBy("verdict", "rule_tokens", "index_token").agg(*sums)
    blocks = F.col("verdict") == "block"

    def lifted(rate: Column, usual: float) -> Column:
        return F.when(blocks, rate >= min_lift * usual).otherwise(min_lift * rate <= usual)

    score = (F.col("bad") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share)) * F.when(blocks, 1).otherwise(-1)
    rated = told.withColumns({"rate": F.col("bad") / F.col("n"), "held_out_rate": F.try_divide("hbad", "hn"), "strength": score}).filter(F.col("n") >= least)
    strong = cut(rated.filter((F.col("strength") >= min_score) & lifted(F.col("rate"), share) & F.coalesce(lifted(F.col("held_out_rate"), held_share), F.lit(False))))
    shorter = strong.select("verdict", "rule_tokens", "strength", F.explode(F.transform(F.col("rule_tokens"), lambda x: F.array_remove(F.col("rule_tokens"), x))).alias("part"))
    general = strong.select("verdict", F.col("rule_tokens").alias("part"), F.col("strength").alias("s"))
    covered = shorter.join(general, ["verdict", "part"]).filter("s >= strength").select("verdict", "rule_tokens").distinct()
    rules = strong.join(covered, ["verdict", "rule_tokens"], "left_anti")
    rules = rules.select("rule_tokens", "verdict", F.col("n").alias("n_rows"), "rate", "strength", F.col("hn").alias("held_out_rows"), "held_out_rate", "index_token")
    return _spelled(rules, twins) if twins else rules


def match(sets: DataFrame, rules: DataFrame, token: str = "tokens") -> DataFrame:
    """The distinct token sets that a rule fits, each with its strongest rule; written, so that a join to it can be split on a set that many have."""
    distinct = sets.select(F.col(token).alias("set")).distinct()
    found = distinct.select("set", F.explode("set").alias("index_token")).join(rules, "index_token")
    fit = found.filter(F.size(F.array_except("rule_tokens", "set")) == 0)
    best = F.max_by(F.struct("rule_tokens", "verdict", "strength"), F.struct("strength", F.size("rule_tokens"), F.array_join("rule_tokens", " "), "verdict"))
    return cut(fit.groupBy("set").agg(best.alias("mined")).select(F.col("set").alias(token), "mined"))


def labelled_tokens(labelled: DataFrame, numbers: bool = False) -> DataFrame:
    """tokens, blocked, held_out (a third, by the URL's hash) of rows (url, blocked)."""
    return labelled.select(tokens(F.col("url"), numbers).alias("tokens"), "blocked", (F.pmod(F.xxhash64("url"), F.lit(3)) == 0).alias("held_out"))


def judge(df: DataFrame, labelled: DataFrame, url: str = "url", *, rules: list[tuple[str, str]] = RULES, default: str = "allow", numbers: bool = False, **mining) -> DataFrame:
    """df with host, path, rule, verdict and mined_rule. labelled: url, blocked (boolean)."""
    names = ["host", "path", "rule", "verdict", "mined_rule"]
    base = df.drop(*[n for n in names if n != url])
    own, given, mined = (T.free_name(base, n) for n in ("tokens_of_url", "given_rule", "mined_best"))
    link = F.col(f"`{url}`")
    out = base.withColumns({own: tokens(link, numbers), given: listed(host_of(link), path_of(link), rules)})
    fits = match(out.select(F.col(own).alias("tokens")), mine(labelled_tokens(labelled, numbers), **mining)).withColumnsRenamed({"tokens": own, "mined": mined})
    out = out.join(fits, own, "left")
    open_ = F.col(given).isNull()
    made = {
        "host": host_of(link), "path": path_of(link), "rule": F.col(f"{given}.rule"), "mined_rule": F.when(open_, F.array_join(f"{mined}.rule_tokens", " ")),
        "verdict": F.coalesce(F.col(f"{given}.verdict"), F.col(f"{mined}.verdict"), F.lit(default)),
    }
    return out.select(*[F.col(f"`{c}`") for c in base.columns if c not in made], *[made[n].alias(n) for n in ("host", "path", "rule", "verdict", "mined_rule")])
