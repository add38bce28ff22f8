"""Hot keys of the joins are split at run time."""

import pytest
from pyspark.sql import functions as F

from rentlens.llm import url_filters
from rentlens.llm.line_dedup import dedup_lines
from tests.plans import plan, small_parts


@pytest.fixture()
def stored(spark, tmp_path):
    def store(df):
        path = f"{tmp_path}/{df.columns[0]}"
        df.repartition(8).write.parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.mark.parametrize("sentences", [False, True])
def test_hot_window(spark, stored, sentences):
    """A window in all documents: later occurrences go, and its join is split."""
    n = 6000
    own = F.concat(F.lit("own "), F.col("id"), F.lit("\nThe same line.\nAnother same line.\nA third one."))
    df = stored(spark.range(n).select(F.col("id").alias("doc_id"), own.alias("text")))
    with small_parts(spark):
        out = dedup_lines(df, sentences=sentences).select("doc_id", "n_removed")
        rows = out.collect()
        assert "skew=true" in plan(out)
    assert sorted((r["doc_id"], r["n_removed"]) for r in rows) == [(i, 3 if i else 0) for i in range(n)]


def test_hot_token_set(spark, stored):
    """URLs of one token set: the join of pages to their rule is split."""
    bad = F.col("page_id") % 10 < 6
    host = F.when(bad, "spam.example").otherwise(F.concat(F.lit("h"), F.col("page_id") % 50, F.lit(".example")))
    url = F.concat(F.lit("http://"), host, F.lit("/a/"), F.col("page_id"))
    df = stored(spark.range(6000).select(F.col("id").alias("page_id")).select("page_id", url.alias("url"), bad.alias("blocked")))
    with small_parts(spark):
        out = url_filters.judge(df.select("page_id", "url"), df.select("url", "blocked")).select("url", "verdict")
        rows = out.collect()
        assert "skew=true" in plan(out)
    assert {(r["verdict"], "spam" in r["url"]) for r in rows} == {("block", True), ("allow", False)} and len(rows) == 6000
