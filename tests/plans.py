"""Final plans of queries that ran, under settings that make small hot keys stand out."""

import contextlib

SMALL_PARTS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k",
}


@contextlib.contextmanager
def small_parts(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL_PARTS}
    for k, v in SMALL_PARTS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    """The executed plan, final once an action ran on this very frame."""
    return df._jdf.queryExecution().executedPlan().toString()


def recording_cuts(module, monkeypatch):
    """The plans of all that the module cuts from now on."""
    seen, real = [], module.cut

    def cut(df):
        out = real(df)
        seen.append(plan(df))
        return out

    monkeypatch.setattr(module, "cut", cut)
    return seen
