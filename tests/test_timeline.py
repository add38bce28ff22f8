"""The timeline against its SQL, to the millisecond: test_queries compares numbers by six digits only."""

import os
from datetime import datetime, timedelta

import duckdb
import pytest

from rentlens.queries import ORACLE, QUERIES
from tests.oracle import SMALL


def exact(spark, folder):
    con = duckdb.connect()
    path = f"{folder}/events.parquet" + ("/*.parquet" if os.path.isdir(f"{folder}/events.parquet") else "")
    con.execute(f"create view events as select * from read_parquet('{path}')")
    got = sorted(tuple(r[c] for c in ("id", "reason", "at_ms")) for r in QUERIES["missing_timeline"](spark, folder).collect())
    assert got == sorted(con.execute(ORACLE["missing_timeline"]).fetchall())
    return got


def test_given_events(spark):
    assert exact(spark, SMALL)


@pytest.mark.parametrize("last_us", [0, 499, 500, 501])
def test_parts_of_a_millisecond(spark, tmp_path, last_us):
    """Gaps of twelve hours within a millisecond, last sightings at the watermark, and sightings without a time."""
    day, grace = datetime(2024, 1, 1), timedelta(hours=12)
    rows = [(u, day + timedelta(microseconds=a)) for u, a in enumerate((0, 0, 499, 500, 500, 500))]
    rows += [(u, day + grace + timedelta(microseconds=b)) for u, b in enumerate((499, 500, 500, 499, 1499, 1500))]
    end = day + timedelta(days=3)
    rows += [(10 + k, end - timedelta(days=1) - grace + timedelta(microseconds=us)) for k, us in enumerate((0, 499, 500, 501, 1500))]
    rows += [(20 + k, end - timedelta(days=1) + timedelta(microseconds=us)) for k, us in enumerate((0, 499, 500, 501, 1500))]
    rows += [(0, None), (30, None), (99, end + timedelta(microseconds=last_us))]
    made = [(i, t, u, "view", 1.0, "") for i, (u, t) in enumerate(rows)]
    kind = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(made, kind).write.parquet(f"{tmp_path}/events.parquet")
    assert any(i == "0" for i, _, _ in exact(spark, str(tmp_path)))
