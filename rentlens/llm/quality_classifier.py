"""A quality classifier: kernel ridge regression by random Fourier features, calibrated isotonically.

1. describe(): statistics of each whole text (lengths, shares of kinds of characters, repetition of
   words and lines, line ends).
2. fit(): standardised statistics go through random cosines, whose inner products approximate a Gaussian kernel. Each partition
   sums its part of the normal equations (features x features, a fixed size); the parts are added line by
   line of the equations and solved with a ridge on the driver, which gets each line once.
3. Isotonic calibration: the training rows' raw scores are counted in fixed bins, pooled where
   they don't ascend, and interpolated between the pools. A row's raw score for that is one by the rows of the other folds: sums
   are kept by fold, so leaving one out is a subtraction, and no row calibrates weights that it helped to fit.

A null or empty text has statistics like any other (zeros) and so a score. Training rows
without a label don't count; without any training row all scores are 0.5. Rows are independent, equal texts get equal scores up to rounding. Texts of any length are read
whole; rows that repeat count each; equal raw scores (ties) fall in one pool. Columns of any name pass; those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .text import free_name

#: Kinds of bytes counted (fixed values): name and bytes.
KINDS = {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "symbol": "#*$%&<>", "bar": "|", "mark": "!?", "stop": ".", "comma": ",;:", "bracket": "()[]{}", "line": "\n", "blank": " \t\r", "other": "\"'`~@^_+=/\\-",
}
NAMES = ["log_chars", "log_words", "word_length", *KINDS, "wide", "distinct", "again", "lines_distinct", "words_a_line", "lines_ended", "distinct_root"]
BINS, FOLDS = 2000, 4


def _class_table() -> np.ndarray:
    table = np.full(256, len(KINDS) + 1, np.uint8)
    table[128:] = len(KINDS)
    for k, chars in enumerate(KINDS.values()):
        for c in chars:
            table[ord(c)] = k
    return table


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of NAMES for each text."""
    table, out = _class_table(), np.zeros((len(texts), len(NAMES)))
    for i, t in enumerate(texts):
        if not t:
            continue
        words = t.split()
        n, chars, lines = len(words), len(t), t.split("\n")
        full = [x for x in lines if x and not x.isspace()]
        kinds = np.bincount(table[np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)], minlength=len(KINDS) + 2)[: len(KINDS) + 1] / chars
        different = len(set(words))
        again = sum(map(str.__eq__, words, words[1:])) if n > 1 else 0
        ended = sum(x.rstrip().endswith((".", "?", ":")) for x in full)
        out[i] = [
            np.log1p(chars), np.log1p(n), min(chars / max(n, 1), 100.0), *kinds, different / max(n, 1), again / max(n, 1),
            len(set(full)) / max(len(full), 1), np.log1p(n / max(len(full), 1)), ended / max(len(full), 1), different / max(n, 1) ** 0.5,
        ]
    return out


def describe(df: DataFrame, text: str = "text", name: str = "stats") -> DataFrame:
    """df without its text and with an array<double> column of statistics."""
    others = [c for c in df.columns if c not in (text, name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = statistics(batch.column(len(others)).to_pylist())
            made = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], [*others, name])

    schema = T.StructType([*(df.schema[c] for c in others), T.StructField(name, T.ArrayType(T.DoubleType(), False))])
    return df.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").alias(free_name(df, "body"))).mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def _summed(df: DataFrame, make, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all rows of make(batch), an array of a fixed shape: by partition, then line by line of the arrays, so that the driver gets each line once, however many partitions there are."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                total = make(batch) if total is None else total + make(batch)
        if total is not None:
            lines = total.reshape(-1, shape[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lines))), pa.array([x.tobytes() for x in lines])], ["line", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, x in zip(batch.column("line").to_pylist(), batch.column("sums")):
                total[i] = np.frombuffer(x.as_buffer(), np.float64) + total.get(i, 0)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["line", "sums"])

    kinds = "line long, sums binary"
    out = np.zeros(shape)
    for r in df.mapInArrow(parts, kinds).repartition("line").mapInArrow(added, kinds).collect():
        out.reshape(-1, shape[-1])[r["line"]] = np.frombuffer(r["sums"], np.float64)
    return out


class Model:
    """Standardisation, random cosines, ridge weights and calibration."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, std
        self.w = rng.normal(0, 1 / width, (len(NAMES), features))
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.beta = np.zeros(features + 1)
        self.x, self.y = np.array([0.0]), np.array([0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.std, -8, 8)
        return np.hstack([np.cos(z @ self.w + self.b) * (2 / len(self.b)) ** 0.5, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated, with a thousandth of the raw score so that pools don't tie."""
        raw = self.raw(stats)
        return 0.999 * np.interp(raw, self.x, self.y) + 0.001 * np.clip(raw, 0, 1)


def pooled(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool neighbours whose means don't ascend; a point (weighted centre, mean) for each pool."""
    pools: list[list[float]] = []
    for xi, yi, ni in zip(x, y, n):
        pools.append([xi * ni, yi, ni])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def fold(stats: str) -> Column:
    """The calibration fold of a row, by its statistics."""
    return F.pmod(F.xxhash64(stats), F.lit(FOLDS)).cast("int")


def fit(df: DataFrame, stats: str = "stats", label: str = "label", *, features: int = 256, width: float = 4.0, ridge: float = 1e-3, seed: int = 7) -> Model:
    """Fit to the rows whose label (0 to 1) isn't null. Only sums of a fixed size reach the driver."""
    rows = cut(df.filter(F.col(label).isNotNull()).select(F.col(stats).alias("s"), F.col(label).cast("double").alias("y"), fold(stats).alias("f")))
    k = len(NAMES)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        s = _matrix(batch.column("s"))
        return np.vstack([np.full(k, len(s)), s.sum(axis=0), (s**2).sum(axis=0)])

    count, total, squares = _summed(rows, moments, (3, k))
    if not count[0]:
        return Model(np.zeros(k), np.ones(k), features, width, seed)
    mean = total / count
    std = np.sqrt(np.maximum(squares / count - mean**2, 0))
    model = Model(mean, np.where(std > 1e-9, std, 1), features, width, seed)

    def normal(batch: pa.RecordBatch) -> np.ndarray:
        z, f = model.features(_matrix(batch.column("s"))), batch.column("f").to_numpy()
        y = batch.column("y").to_numpy()
        parts = [(z[f == k], y[f == k]) for k in range(FOLDS)]
        return np.stack([np.hstack([a.T @ a, (a.T @ b)[:, None]]) for a, b in parts])

    folds = _summed(rows, normal, (FOLDS, features + 1, features + 2))

    def solved(equations: np.ndarray) -> np.ndarray:
        n = equations[-1, -2]  # the constant's square, summed
        return np.linalg.solve(equations[:, :-1] + ridge * max(n, 1) / features * np.eye(features + 1), equations[:, -1])

    whole = folds.sum(axis=0)
    model.beta = solved(whole)
    without = np.stack([solved(whole - part) for part in folds])

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        y = batch.column("y").to_numpy()
        # each row's score by the weights of the other folds
        raw = np.einsum("ij,ij->i", model.features(_matrix(batch.column("s"))), without[batch.column("f").to_numpy()])
        at = np.clip(((raw + 0.5) * BINS / 2).astype(int), 0, BINS - 1)
        return np.vstack([np.bincount(at, w, BINS) for w in (np.ones(len(y)), raw, y)])

    n, raw, y = _summed(rows, binned, (3, BINS))
    full = n > 0
    model.x, model.y = pooled(raw[full] / n[full], y[full], n[full])
    return model


def score(df: DataFrame, model: Model, stats: str = "stats", name: str = "score") -> DataFrame:
    """df with the model's score of its statistics instead of them."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    others = [c for c in df.columns if c not in (stats, name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(sent.value.score(_matrix(batch.column(stats))))], [*others, name])

    return df.mapInArrow(run, T.StructType([*(df.schema[c] for c in others), T.StructField(name, T.DoubleType())]))
