"""Entity resolution of listings: blocking keys, candidate pairs, pair rules, cliques, survivors.

Candidates come from an equi-join on exploded keys, never from a join on a condition; oversized blocks are refined by a stronger key, and
what stays oversized is counted, not compared (the cap is part of the rules). Pair rules run on narrow columns; the wide
shingle arrays go to the blocks whose pairs need them, once for a row and block, not once for a pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import cut, ship
from .graph import components

MAX_BLOCK = 60
#: Rows of a block that meet in one task where blocks have no cap.
CHUNK = 2000
TEXT_THRESHOLD = 0.35
NARROW = ["sq", "price_n", "floor_n", "rooms_n", "lat", "lon", "house", "owner_n", "n_shingles", "set_hash"]
#: Hits of a connected component that one task may hold; larger components are worked on in rounds.
TASK_HITS = 200_000


def prepare(listings: DataFrame) -> DataFrame:
    """id with the columns that keys and rules read; shingles as hashes, as only their identity counts, with their number."""

    def col(c: str) -> Column:
        return F.col(c) if c in listings.columns else F.lit(None).cast("string")

    floor = S.to_number(col("floor"))
    made = listings.select(
        "id", S.to_number(col("square_m2")).alias("sq"), S.to_number(col("price")).alias("price_n"), F.when(F.abs(floor) < 9e18, floor).cast("long").alias("floor_n"),
        S.norm(col("rooms")).alias("rooms_n"), S.to_number(col("latitude")).alias("lat"), S.to_number(col("longitude")).alias("lon"), S.norm(col("street")).alias("street_n"),
        S.first_text(S.norm(col("complex_name")), S.norm(col("complex_alias"))).alias("complex_n"), S.clean_house(col("house_num")).alias("house"), S.owner(col("owner_name")).alias("owner_n"),
        F.transform(S.shingles(S.word_list(col("full_description"))), lambda x: F.xxhash64(x)).alias("shingles"), F.coalesce(col("created_at"), F.lit("")).alias("created"), F.coalesce(col("scraped_at"), F.lit("")).alias("scraped"),
    )
    set_hash = F.struct(*[F.xxhash64(F.lit(seed), "shingles").alias(f"h{seed}") for seed in (1, 2)])
    return made.withColumns({"n_shingles": F.size("shingles"), "set_hash": set_hash})


def block_keys(prepared: DataFrame) -> DataFrame:
    """(id, kind, key, refine) for each block that a row belongs to."""
    area = F.coalesce(F.when(S.present(F.col("sq")), F.bround("sq", 0).cast("long").cast("string")), F.lit("~"))
    geo = S.present(F.col("lat")) & S.present(F.col("lon"))

    def cell(digits: int) -> Column:
        scale = 10**digits
        return F.concat_ws(":", *[F.bround(F.col(c) * scale, 0).cast("long").cast("string") for c in ("lat", "lon")])

    def pair(when: Column, name: str, value: Column) -> list[Column]:
        return [F.when(when, F.struct(F.lit(f"{name}_{by}").alias("kind"), F.concat_ws("|", value, x).alias("key"))) for by, x in (("area", area), ("rooms", F.col("rooms_n")))]

    kinds = [F.when(geo, F.struct(F.lit("geo4").alias("kind"), cell(4).alias("key"))), *pair(geo, "geo3", cell(3)), *pair(F.col("street_n") != "", "street", F.col("street_n"))]
    kinds += [*pair(F.col("complex_n").isNotNull(), "complex", F.col("complex_n")), *pair(F.col("owner_n").isNotNull(), "owner", F.col("owner_n"))]
    refine = F.concat_ws("|", "rooms_n", area, F.coalesce(F.col("floor_n").cast("string"), F.lit("~")))
    return prepared.select("id", refine.alias("refine"), F.explode(F.array_compact(F.array(*kinds))).alias("b")).select("id", "b.kind", "b.key", "refine")


def blocks(keys: DataFrame, max_block: int | None = MAX_BLOCK) -> DataFrame:
    """keys with the block that a row is compared in (part) and its size; oversized blocks are refined first (none, without max_block).

    Sizes are aggregates, and written before they are joined: so a block with a third of all rows is split between tasks."""
    whole = cut(keys.groupBy("kind", "key").agg(F.count("*").alias("n")).filter("n > 1"))
    if max_block is None:
        return keys.join(whole, ["kind", "key"]).select("id", "kind", "key", F.lit("").alias("part"), F.col("n").alias("size"))
    sized = keys.join(whole, ["kind", "key"])
    part = sized.withColumn("part", F.when(F.col("n") <= max_block, F.lit("")).otherwise(F.col("refine")))
    sizes = cut(part.groupBy("kind", "key", "part").agg(F.count("*").alias("size")))
    return part.join(sizes, ["kind", "key", "part"]).select("id", "kind", "key", "part", "size")


def skipped(parts: DataFrame, max_block: int | None = MAX_BLOCK) -> DataFrame:
    """One row: blocks and rows that stay oversized."""
    over = parts.filter(F.lit(False) if max_block is None else F.col("size") > max_block)
    return over.agg(F.count_distinct("kind", "key", "part").alias("skipped_blocks"), F.count("*").alias("skipped_rows"))


def candidate_pairs(parts: DataFrame, max_block: int | None = MAX_BLOCK, chunk: int = CHUNK, *, located: bool = False) -> DataFrame:
    """Distinct (a, b), a < b, that share a block of 2 to max_block rows; located adds the hash of the largest such block, for decisions().

    Without max_block no block is left out: those of over `chunk` rows are cut into chunks by a hash of the id, and each two chunks
    meet under a key of their own, so that no task holds more than two of them."""

    def once(pairs: DataFrame, *place: str) -> DataFrame:
        if not located:
            return pairs.select("a", "b").distinct()
        best = F.max(F.struct("size", F.xxhash64(*place).alias("block")))
        return pairs.groupBy("a", "b").agg(best.alias("best")).select("a", "b", "best.block")

    some = parts.filter("size > 1") if max_block is None else parts.filter(F.col("size").between(2, max_block))
    if max_block is not None:
        left, right = some.select(F.col("id").alias("a"), "kind", "key", "part", "size"), some.select(F.col("id").alias("b"), "kind", "key", "part")
        return once(left.join(right, ["kind", "key", "part"]).filter("a < b"), "kind", "key", "part")
    n = F.ceil(F.col("size") / chunk).cast("int")
    chunked = some.select("id", "kind", "key", "part", "size", n.alias("n"), F.pmod(F.xxhash64("id"), n).cast("int").alias("c")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    met = chunked.select("id", "kind", "key", "part", "size", "c", F.least("c", "o").alias("c1"), F.greatest("c", "o").alias("c2"))
    left, right = met.filter("c = c1").withColumnRenamed("id", "a").drop("c"), met.filter("c = c2").withColumnRenamed("id", "b").drop("c", "size")
    pairs = left.join(right, ["kind", "key", "part", "c1", "c2"]).filter("a <> b")
    return once(pairs.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")}), "kind", "key", "part", "c1", "c2")


def decisions(pairs: DataFrame, prepared: DataFrame, text_threshold: float = TEXT_THRESHOLD, *, tracks: bool = True) -> DataFrame:
    """(a, b, ok, track, why) for each pair, by the first rule that applies.

    Shingles are compared only where they can decide: two sets can't be alike if their sizes alone bound the similarity below the threshold, and equal
    sets (by 128 bits of hash) are alike. Without tracks, pairs that price and area confirm anyway are not compared either, and count as B_price.

    Located pairs (see candidate_pairs) are compared block by block: each set goes to a block once, however many pairs it has there, so what is sent grows with
    the rows times their blocks. Other pairs get their sets one by one."""
    a = prepared.select(F.col("id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in NARROW])
    b = prepared.select(F.col("id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in NARROW])
    j = pairs.join(a, "a").join(b, "b")
    x = {c: (F.col(f"a_{c}"), F.col(f"b_{c}")) for c in NARROW}
    near = S.present(x["lat"][0]) & S.present(x["lon"][0]) & S.present(x["lat"][1]) & S.present(x["lon"][1]) & (S.haversine_m(x["lat"][0], x["lon"][0], x["lat"][1], x["lon"][1]) <= S.SAME_BUILDING_M)
    ra, rb = S.digits_only(x["rooms_n"][0]), S.digits_only(x["rooms_n"][1])
    same_floor, named = x["floor_n"][0] == x["floor_n"][1], F.coalesce(x["owner_n"][0] == x["owner_n"][1], F.lit(False))
    early = (
        F.when(F.coalesce(x["house"][0] != x["house"][1], F.lit(False)), "house")
        .when(~F.coalesce(near, F.lit(False)), "distance")
        .when((ra != "") & (rb != "") & (ra != rb), "rooms")
        .when(~S.area_close(*x["sq"]), "area")
        .when(same_floor.isNull(), "floor_unknown")
        .when(named & same_floor & S.area_very_close(*x["sq"]), "A_owner")
        .when(named & same_floor, "owner_area")
        .when(named, "owner_floor")
        .when(~same_floor, "floor")
    )
    firm = S.price_close(*x["price_n"]) & S.area_very_close(*x["sq"])
    sizes = x["n_shingles"]
    hopeless = (F.least(*sizes) < S.LEAST_SHINGLES) | (F.least(*sizes) < text_threshold * F.greatest(*sizes) * (1 - 1e-9))
    done = hopeless if tracks else hopeless | firm
    unread = F.when(firm, "B_price").otherwise("unconfirmed")
    same = (x["set_hash"][0] == x["set_hash"][1]) & F.lit(text_threshold <= 1)
    late = F.when(done, unread).when(same, "B_text")
    block = F.col("block") if "block" in pairs.columns else F.xxhash64("a", "b")
    judged = cut(j.select("a", "b", F.coalesce(early, late).alias("why"), unread.alias("unread"), block.alias("block")))
    read = _read(judged.filter("why is null"), prepared, text_threshold)
    out = judged.filter("why is not null").select("a", "b", "why").unionByName(read)
    track = F.when(F.col("why").isin("A_owner", "B_text", "B_price"), F.substring("why", 1, 1))
    return out.select("a", "b", track.isNotNull().alias("ok"), track.alias("track"), "why")


def _read(pairs: DataFrame, prepared: DataFrame, text_threshold: float) -> DataFrame:
    """(a, b, why) of pairs (a, b, unread, block): B_text where the shingles are alike, else what unread says."""

    def run(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        of = {i: (len(s), np.unique(s)) for i, s in zip(sets["id"], sets["shingles"]) if s is not None and len(s) >= S.LEAST_SHINGLES}

        def alike(a, b) -> bool:
            if a not in of or b not in of:
                return False
            (n, x), (m, y) = of[a], of[b]
            shared = len(np.intersect1d(x, y, assume_unique=True))
            return shared / (n + m - shared) >= text_threshold

        why = ["B_text" if alike(a, b) else unread for a, b, unread in zip(pairs["a"], pairs["b"], pairs["unread"])]
        return pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "why": why})

    ship(pairs.sparkSession)
    members = pairs.select(F.col("block").alias("place"), F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = members.join(prepared.select("id", "shingles"), "id").select("place", "id", "shingles")
    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.groupBy("block").cogroup(sets.groupBy("place")).applyInPandas(run, f"a {kind}, b {kind}, why string")


def why_text(why: Column, similarity: Column) -> Column:
    """A decision as a sentence part; text decisions name the similarity."""
    return F.when(why.isin("B_text", "unconfirmed") & similarity.isNotNull(), F.format_string("%s (similarity %.2f)", why, similarity)).otherwise(why)


def _greedy(edges: pd.DataFrame, seeds: set | None = None) -> pd.DataFrame:
    """Cliques of a graph (a, b, ra, rb), seeds by rank (all nodes, if none are given)."""
    near: dict = {}
    rank: dict = {}
    for a, b, ra, rb in zip(edges["a"], edges["b"], edges["ra"], edges["rb"]):
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
        rank[a], rank[b] = (ra, a), (rb, b)
    used: set = set()
    rows = []
    for node in sorted(near if seeds is None else seeds, key=rank.__getitem__):
        if node in used:
            continue
        group = [node]
        for other in sorted(near[node] - used, key=rank.__getitem__):
            if all(other in near[m] for m in group):
                group.append(other)
        if len(group) > 1:
            used.update(group)
            rows += [(node, m, i) for i, m in enumerate(group)]
    return pd.DataFrame(rows, columns=["clique", "id", "place"])


def cliques(hits: DataFrame, task_hits: int = TASK_HITS) -> DataFrame:
    """(clique, id, place): disjoint groups in which every two members are a hit.

    Greedy by degree over the whole graph, ties by the id's digest, then id. A choice never looks past a connected component, so components of up to task_hits
    hits are worked on apart, a task each. In larger ones the nodes of least rank within two steps choose at once: no other choice
    can touch theirs, so the result is that of one after the other. Their members go, and what is left falls into components
    again. A node's degree, and so the work of a choice, is bounded by its blocks, which are capped."""
    kind = hits.schema["a"].dataType.simpleString()
    out_kind = f"clique {kind}, id {kind}, place int"
    ends = cut(hits.select("a", "b").distinct())
    degrees = ends.select(F.explode(F.array("a", "b")).alias("n")).groupBy("n").agg(F.count("*").alias("degree"))
    # ranks as text that sorts: many neighbours first; the digest keeps chains of equal degree short
    ranks = cut(degrees.select("n", F.concat(F.lpad((F.lit(9_999_999_999) - F.col("degree")).cast("string"), 10, "0"), F.md5(F.col("n").cast("string").cast("binary"))).alias("r")))
    edges = cut(ends.join(ranks.withColumnsRenamed({"n": "a", "r": "ra"}), "a").join(ranks.withColumnsRenamed({"n": "b", "r": "rb"}), "b"))
    out = None
    while True:
        # components() takes integers: number the nodes by a hash (a collision would only join two components, which stays right)
        comp = components(edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")))
        placed = cut(edges.withColumn("node", F.xxhash64("a")).join(comp, "node").drop("node"))
        large = placed.groupBy("component").agg(F.count("*").alias("m")).filter(F.col("m") > task_hits)
        small = placed.join(large, "component", "left_anti").groupBy("component").applyInPandas(lambda rows: _greedy(rows), out_kind)
        out = small if out is None else out.unionByName(small)
        edges = placed.join(large, "component", "left_semi").drop("component")
        if edges.isEmpty():
            return out
        chosen = cut(_round(edges, out_kind))
        out = out.unionByName(chosen)
        gone = chosen.select("id")
        edges = cut(edges.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti"))


def _round(edges: DataFrame, kind: str) -> DataFrame:
    """The cliques of the nodes that have the least rank of all within two steps."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("rb").alias("ra"), F.col("ra").alias("rb")))
    one = both.groupBy("a").agg(F.least(F.min("ra"), F.min("rb")).alias("low"))
    two = both.join(one.withColumnsRenamed({"a": "b", "low": "blow"}), "b").groupBy("a").agg(F.least(F.min("ra"), F.min("blow")).alias("low"), F.first("ra").alias("ra"))
    seeds = cut(two.filter("ra = low").select(F.col("a").alias("seed")))
    near = both.join(seeds, both.a == seeds.seed).select("seed", F.col("b").alias("n"))
    spokes = both.join(seeds, both.a == seeds.seed).select("seed", "a", "b", "ra", "rb")
    # edges between two neighbours of one seed; seeds are three steps apart, so a node neighbours one seed at most
    rim = edges.join(near.withColumnRenamed("n", "a"), "a").join(near.withColumnsRenamed({"n": "b", "seed": "other"}), "b").filter("seed = other").select("seed", "a", "b", "ra", "rb")
    return spokes.unionByName(rim).groupBy("seed").applyInPandas(lambda key, rows: _greedy(rows, {key[0]}), kind)


def survivors(groups: DataFrame, prepared: DataFrame) -> DataFrame:
    """groups with keep: the latest by (created, scraped), the first in the clique among equals."""
    dated = groups.join(prepared.select("id", "created", "scraped"), "id")
    best = dated.groupBy("clique").agg(F.max_by("id", F.struct("created", "scraped", -F.col("place"))).alias("kept"))
    return dated.join(best, "clique").select("clique", "id", (F.col("id") == F.col("kept")).alias("keep"))


def dedupe(listings: DataFrame, text_threshold: float = TEXT_THRESHOLD, max_block: int | None = MAX_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(kept listings, one row of statistics)."""
    prepared = cut(prepare(listings))
    parts = cut(blocks(block_keys(prepared), max_block))
    pairs = cut(candidate_pairs(parts, max_block, located=True))
    hits = decisions(pairs, prepared, text_threshold, tracks=False).filter("ok")
    groups = cut(survivors(cliques(hits), prepared))
    dropped = groups.filter("not keep").select("id")
    kept = listings.join(dropped, "id", "left_anti")
    one = lambda df, *cols: df.agg(*cols)
    counts = [one(listings, F.count("*").alias("total")), one(pairs, F.count("*").alias("candidate_pairs")), one(groups, F.count_distinct("clique").alias("groups"), F.count_if(~F.col("keep")).alias("dropped")), skipped(parts, max_block)]
    stats = counts[0]
    for c in counts[1:]:
        stats = stats.join(F.broadcast(c))  # one row each
    return kept, stats


def audit(listings: DataFrame, text_threshold: float = TEXT_THRESHOLD, max_block: int | None = MAX_BLOCK) -> DataFrame:
    """(kind, key, text): a report of what a dedupe does. Counts, with the dropped share in percent; pairs by reason; for each group who stays, who goes, and why.

    A member goes for the reason that it has in common with the one that stays: all members of a group are confirmed pairs."""
    prepared = cut(prepare(listings))
    parts = cut(blocks(block_keys(prepared), max_block))
    decided = cut(decisions(candidate_pairs(parts, max_block, located=True), prepared, text_threshold))
    groups = cut(survivors(cliques(decided.filter("ok")), prepared))
    stay = groups.filter("keep").select("clique", F.col("id").alias("stays"))
    pair = groups.filter("not keep").join(stay, "clique").withColumns({"a": F.least("id", "stays"), "b": F.greatest("id", "stays")})
    goes = F.concat_ws(", ", F.transform(F.array_sort(F.collect_list(F.struct("id", "why"))), lambda x: F.concat(x["id"], F.lit(" ("), x["why"], F.lit(")"))))
    told = pair.join(decided.select("a", "b", "why"), ["a", "b"]).groupBy("clique").agg(F.concat(F.lit("keep "), F.first("stays"), F.lit(": "), goes).alias("text"))
    reasons = decided.groupBy("why").agg(F.count("*").alias("n"))
    one = listings.agg(F.count("*").alias("total"))  # one row, as are the next ones
    for more in (decided.agg(F.count("*").alias("candidate_pairs")), groups.agg(F.count_distinct("clique").alias("groups"), F.count_if(~F.col("keep")).alias("dropped")), skipped(parts, max_block)):
        one = one.join(F.broadcast(more))
    counts = ["total", "candidate_pairs", "groups", "dropped", "skipped_blocks", "skipped_rows"]
    share = F.format_string("%.2f", F.col("dropped") * 100 / F.greatest(F.lit(1), F.col("total")))
    rows = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("text")) for c in counts], F.struct(F.lit("dropped_percent").alias("key"), share.alias("text")))
    out = one.select(F.lit("count").alias("kind"), F.inline(rows))
    out = out.unionByName(reasons.select(F.lit("reason").alias("kind"), F.col("why").alias("key"), F.col("n").cast("string").alias("text")))
    return out.unionByName(told.select(F.lit("group").alias("kind"), F.col("clique").alias("key"), "text"))
