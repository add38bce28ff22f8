"""Running values of a key in order, without all rows of a hot key in one task.

Keys of up to `most` rows go through one window by key. The rows of larger ones are dealt by ranges of (key, order) into segments of about
half as many rows, written with their segment's number; a window runs inside each segment, and what a segment leaves behind (its last
value, its sum) passes on to the later ones by a table of a row for each segment and key. Three kinds:

* last: the last value that isn't null up to the row;
* previous: the value of the row before (values mustn't be null);
* sum: the sum of the values up to the row.

Rows of equal order stay in one segment, and which of them comes first is open, as in any window: order should end with a column that tells
rows apart. A null key is a key like any other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Rows of a key that one task takes; hot keys that may be broadcast (the count is taken first).
MOST_ROWS, FEW_KEYS = 2_000_000, 100_000
KEY, SEGMENT, BEFORE = "__hot_key", "__segment", "__before"


class Dealt:
    """The rows of a table by key in order, for one running value after another: ordinary keys as they are, hot ones in segments.

    Hot keys are counted and dealt once, however many values follow; a value may use those added before it."""

    def __init__(self, df: DataFrame, key: str, order: list[str], most: int = MOST_ROWS):
        self.key, self.order, self.cold, self.hot = key, order, df, None
        hot = cut(df.groupBy(F.col(key).alias(KEY)).agg(F.count("*").alias("__n")).filter(F.col("__n") > most).withColumn("__hot", F.lit(True)))
        size = hot.agg(F.count("*").alias("keys"), F.sum("__n").alias("rows")).first()
        if size["keys"]:
            segments = -(-2 * size["rows"] // most)
            self.small = size["keys"] + segments <= FEW_KEYS  # as are the tables of hot keys, and of segments by key
            few = hot.select(KEY, "__hot")
            marked = df.join(F.broadcast(few) if self.small else few, F.col(key).eqNullSafe(F.col(KEY)), "left").drop(KEY)
            self.cold = marked.filter(F.col("__hot").isNull()).drop("__hot")
            # a task for each segment
            self.hot = segmented(marked.filter("__hot").drop("__hot"), key, order, segments).repartitionById(segments, F.col(SEGMENT))

    def _within(self, value: Column, kind: str, *group: str) -> Column:
        w = Window.partitionBy(*group).orderBy(*self.order)
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {"last": F.last(value, ignorenulls=True).over(so_far), "previous": F.lag(value).over(w), "sum": F.sum(value).over(so_far)}[kind]

    def add(self, name: str, value: Column, kind: str) -> Dealt:
        """Add the running value as a column."""
        self.cold = self.cold.withColumn(name, self._within(value, kind, self.key))
        if self.hot is not None:
            left = _left_behind(self.hot, self.key, self.order, value, kind)
            inside = self.hot.withColumn(name, self._within(value, kind, SEGMENT, self.key))
            both = inside.join(F.broadcast(left) if self.small else left, (F.col(SEGMENT) == F.col("__s")) & F.col(self.key).eqNullSafe(F.col(KEY)), "left")
            total = F.coalesce(F.col(name) + F.col(BEFORE), F.col(name), F.col(BEFORE)) if kind == "sum" else F.coalesce(name, BEFORE)
            self.hot = both.withColumn(name, total).drop(KEY, "__s", BEFORE)
        return self

    def make(self, name: str, value: Column) -> Dealt:
        """Add a column that needs no other rows."""
        self.cold = self.cold.withColumn(name, value)
        self.hot = None if self.hot is None else self.hot.withColumn(name, value)
        return self

    def rows(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot.drop(SEGMENT))


def running(df: DataFrame, key: str, order: list[str], value: Column, kind: str, name: str, most: int = MOST_ROWS) -> DataFrame:
    """df with the running value of its rows in a column `name`."""
    return Dealt(df, key, order, most).add(name, value, kind).rows()


def segmented(rows: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """Rows with the number of their segment, written, as ranges would be drawn anew in another job."""
    return cut(rows.repartitionByRange(n, key, *order).withColumn(SEGMENT, F.spark_partition_id()))


def _left_behind(rows: DataFrame, key: str, order: list[str], value: Column, kind: str) -> DataFrame:
    """(__s, key, before): for each segment and hot key, what the key's earlier segments leave behind."""
    earlier = Window.partitionBy(KEY).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    summary = F.sum(value) if kind == "sum" else F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    carried = F.sum(BEFORE).over(earlier) if kind == "sum" else F.last(BEFORE, ignorenulls=True).over(earlier)
    return cut(rows.groupBy(SEGMENT, F.col(key).alias(KEY)).agg(summary.alias(BEFORE)).withColumn(BEFORE, carried).withColumnRenamed(SEGMENT, "__s"))


def numbered(df: DataFrame, order: list[Column | str], name: str, first: int = 0, parts: int | None = None) -> DataFrame:
    """df with gapless numbers from `first` on in the given order, which should tell rows apart.

    Rows are dealt by ranges of the order and written; numbers run inside each range, after the rows that the ranges before it hold. The result
    stays dealt and sorted by number, so files written from it hold a range of numbers each."""
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    rows = cut(df.repartitionByRange(n, *keys).withColumn(SEGMENT, F.spark_partition_id()))
    sizes = sorted((r[SEGMENT], r["count"]) for r in rows.groupBy(SEGMENT).count().collect())  # a row for each range
    before, at = [], first - 1
    for segment, size in sizes:
        before.append((segment, at))
        at += size
    starts = spark.createDataFrame(before, f"__s int, {BEFORE} long")
    within = F.row_number().over(Window.partitionBy(SEGMENT).orderBy(*keys))
    out = rows.repartitionById(n, F.col(SEGMENT)).withColumn(name, within).join(F.broadcast(starts), F.col(SEGMENT) == F.col("__s"))
    return out.withColumn(name, F.col(name) + F.col(BEFORE)).select(*[c for c in df.columns if c != name], name)
