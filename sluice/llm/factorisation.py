"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The machine adds to a linear model the products of all pairs of features, weighed by the inner products
of the features' factors. It scores in time linear in a text's features: the sum over pairs is half of
(square of the sum) - (sum of the squares), factor by factor.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, ready_for_python, stored

#: Bytes of which each statistic tells the share, and how often a share of one counts.
SHARES = (
    (b"#*$%&|<>", 20), (b"!?", 20), (string.ascii_uppercase.encode(), 4), (string.digits.encode(), 10), (b".,;:", 20), (b"\n", 20))
#: Statistics of a text, then two features of its length as metadata.
N_STATISTICS = len(SHARES) + 4
N_DENSE = N_STATISTICS + 2


@dataclass(frozen=True)
class Learning:
    """How the machine is trained. ``max_labelled`` bounds its table: the labelled ids of least hash.

    Ids whose crc32 (of the id as text) leaves ``held_out`` when divided by ``folds`` are never learnt from.
    """

    max_labelled: int = 8_000
    folds: int = 4
    held_out: int = 2
    hashed: int = 1 << 13
    factors: int = 4
    epochs: int = 12
    batch: int = 256
    step: float = 0.02
    decay: float = 0.01
    seed: int = 7

    @property
    def size(self) -> int:
        return self.hashed + N_DENSE


def held_out(id: Column, learning: Learning = Learning()) -> Column:
    """Whether an id is kept from training; a null id counts as empty text."""
    text = F.coalesce(id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % learning.folds == learning.held_out


def bounded(x: float) -> float:
    """A number from 0 on as one below 1, so that no odd text outweighs all others."""
    return x / (1.0 + x)


def statistics(data: bytes, words: list[bytes], distinct: int) -> list[float]:
    """What a text looks like, in numbers from 0 to 1."""
    size, lines = max(1, len(data)), data.split(b"\n")
    shares = [bounded(times * (len(data) - len(data.translate(None, some))) / size) for some, times in SHARES]
    count = max(1, len(words))
    return [*shares, distinct / count, len(set(lines)) / len(lines), bounded(np.log1p(len(words)) / 5), bounded(size / count / 8)]


def vector(data: bytes, length: float | None, learning: Learning) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features: hashed words, their log counts scaled to length 1, and
    behind them the statistics and the metadata. At most ``learning.size`` of them, whatever the text."""
    words = data.split()
    found = Counter(words)
    cells = np.fromiter((zlib.crc32(w) for w in found), np.int64, len(found)) % learning.hashed
    index, cell = np.unique(cells, return_inverse=True)
    value = np.log1p(np.bincount(cell, weights=np.fromiter(found.values(), np.float64, len(found)), minlength=len(index)))
    if len(index):
        value /= np.sqrt((value * value).sum())
    about = [bounded(np.log1p(max(0.0, length)) / 8) if length is not None else 0.0, float(length is None)]
    dense = np.array([*statistics(data, words, len(found)), *about])
    return np.concatenate([index, learning.hashed + np.arange(N_DENSE)]), np.concatenate([value, dense])


@dataclass
class Rows:
    """Sparse rows: the features of row ``i`` are ``ends[i]`` to ``ends[i + 1]``. None is empty."""

    ends: np.ndarray
    index: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes | None], lengths: list, learning: Learning) -> Rows:
        found = [vector(t or b"", n, learning) for t, n in zip(texts, lengths)]
        return cls(
            np.cumsum([0, *(len(i) for i, _ in found)]), np.concatenate([np.empty(0, np.int64), *(i for i, _ in found)]),
            np.concatenate([np.empty(0), *(v for _, v in found)]))

    def take(self, rows: np.ndarray) -> Rows:
        lengths = self.ends[rows + 1] - self.ends[rows]
        ends = np.cumsum([0, *lengths])
        at = np.repeat(self.ends[rows] - ends[:-1], lengths) + np.arange(ends[-1])
        return Rows(ends, self.index[at], self.value[at])


@dataclass
class Machine:
    """Bias, a weight for each feature, and a short vector of factors for each feature."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def sums(self, rows: Rows) -> np.ndarray:
        """Of each row the sum of its features' factors, each weighed by the feature's value."""
        return np.add.reduceat(self.factors[rows.index] * rows.value[:, None], rows.ends[:-1], axis=0)

    def odds(self, rows: Rows, sums: np.ndarray | None = None) -> np.ndarray:
        """Log odds of each row: linear part, and the pairs by the sum-of-squares identity."""
        if len(rows.ends) < 2:
            return np.empty(0)
        sums = self.sums(rows) if sums is None else sums
        squares = (self.factors * self.factors).sum(axis=1)
        single = self.linear[rows.index] * rows.value - 0.5 * squares[rows.index] * rows.value**2
        return self.bias + np.add.reduceat(single, rows.ends[:-1]) + 0.5 * (sums * sums).sum(axis=1)

    def scores(self, rows: Rows) -> np.ndarray:
        return chance(self.odds(rows))


def chance(odds: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


def fit(rows: Rows, labels: np.ndarray, learning: Learning) -> Machine:
    """Gradient steps with a momentum and a scale for each weight (Adam; weights decay apart from it),
    over small batches in an order that the seed fixes. The bias begins at the labels' odds."""
    rng = np.random.default_rng(learning.seed)
    size, k = learning.size, learning.factors
    share = (labels.sum() + 1) / (len(labels) + 2)
    # the last row holds the bias
    weights = np.zeros((size + 1, 1 + k))
    weights[:size, 1:] = rng.normal(0, 0.05, (size, k))
    weights[size, 0] = np.log(share / (1 - share))
    keep = np.full((size + 1, 1), 1 - learning.step * learning.decay)
    keep[size] = 1.0
    first, second, count = np.zeros_like(weights), np.zeros_like(weights), 0
    for _ in range(learning.epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), learning.batch):
            some = order[start : start + learning.batch]
            part, machine = rows.take(some), Machine(weights[size, 0], weights[:size, 0], weights[:size, 1:])
            sums = machine.sums(part)
            off = (chance(machine.odds(part, sums)) - labels[some]) / len(some)
            of = np.repeat(np.arange(len(some)), np.diff(part.ends))
            pull = off[of] * part.value
            steep = np.zeros_like(weights)
            steep[:size, 0] = np.bincount(part.index, pull, size)
            steep[size, 0] = off.sum()
            for f in range(k):
                rest = sums[of, f] - machine.factors[part.index, f] * part.value
                steep[:size, 1 + f] = np.bincount(part.index, pull * rest, size)
            count += 1
            first = 0.9 * first + 0.1 * steep
            second = 0.999 * second + 0.001 * steep * steep
            pace = (first / (1 - 0.9**count)) / (np.sqrt(second / (1 - 0.999**count)) + 1e-8)
            weights = weights * keep - learning.step * pace
    return Machine(float(weights[size, 0]), weights[:size, 0].copy(), weights[:size, 1:].copy())


def _source(df: DataFrame, text: str, length: str | None) -> list[Column]:
    """The bytes of a text and its length as metadata; no length if it is no finite number."""
    about = F.lit(None).cast("double") if length is None else F.col(f"`{length}`").cast("double")
    return [F.col(f"`{text}`").cast("binary"), F.when(F.abs(about) < float("inf"), about)]


def train(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", length: str | None = "n_chars",
          label: str = "quality", learning: Learning = Learning()) -> Machine:
    """A machine from the texts of labelled ids that are not held out.

    ``labels`` (id, label 0 or 1); other labels and null ids are passed over, of several labels of one
    id the least counts. At most ``max_labelled`` ids, those of least hash, are learnt from, so the
    choice depends on the ids alone; their vectors, bounded in number and length, are fitted in one
    task, in the order of ids, so reruns agree. Rows that repeat such an id count each. With nothing
    to learn from, the machine gives 1/2 to every text.
    """
    ready_for_python(df.sparkSession)
    of, own = F.col(f"`{id}`"), F.col(f"`{label}`")
    known = stored(  # small as files are, so Spark may broadcast it
        labels.where(of.isNotNull() & own.isin(0, 1) & ~held_out(of, learning)).groupBy(of.alias("__of"))
        .agg(F.min(own).cast("double").alias("__label"))
        .orderBy(F.xxhash64("__of"), "__of").limit(learning.max_labelled), "labelled")
    body, about = _source(df, text, length)
    used = df.select(of.alias("__id"), body.alias("__text"), about.alias("__length")).join(known, F.col("__id") == F.col("__of"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Rows.of(batch.column(2).to_pylist(), batch.column(3).to_pylist(), learning)
            ends = pa.array(rows.ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(rows.index, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(rows.value))], ["of", "label", "index", "value"])

    vectors = stored(used.select("__of", "__label", "__text", "__length").mapInArrow(measure, T.StructType([
        T.StructField("of", known.schema["__of"].dataType), T.StructField("label", T.DoubleType()),
        T.StructField("index", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.DoubleType()))])), "vectors")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        index, value = (np.concatenate([b.column(c).flatten().to_numpy() for b in parts]) for c in (2, 3))
        sizes = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in parts])
        labels = np.concatenate([b.column(1).to_numpy() for b in parts])
        machine = fit(Rows(np.cumsum([0, *sizes]), index.astype(np.int64), value), labels, learning)
        yield pa.RecordBatch.from_arrays(
            [pa.array([machine.bias]), pa.array([machine.linear.tobytes()], pa.binary()), pa.array([machine.factors.tobytes()], pa.binary())],
            ["bias", "linear", "factors"])

    ordered = vectors.orderBy("of", F.hash("index", "value"), "label").coalesce(1)
    found = stored(ordered.mapInArrow(learn, "bias double, linear binary, factors binary"), "machine").first()
    if found is None:
        return Machine(0.0, np.zeros(learning.size), np.zeros((learning.size, learning.factors)))
    return Machine(found["bias"], np.frombuffer(found["linear"]), np.frombuffer(found["factors"]).reshape(learning.size, learning.factors))


def score(df: DataFrame, machine: Machine, text: str = "text", length: str | None = "n_chars", threshold: float = 0.7,
          learning: Learning = Learning(), keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) with ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 from ``threshold`` on).

    Row by row over whole texts, no shuffle. Null and empty texts are scored as texts without words.
    Kept columns with these names are replaced.
    """
    spark = df.sparkSession
    ready_for_python(spark)
    shared = spark.sparkContext.broadcast(machine)  # as large as ``learning`` says
    names = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]
    rest = df.select(*(F.col(f"`{c}`") for c in names))
    body, about = _source(df, text, length)
    source = df.select(*(F.col(f"`{c}`") for c in names), body.alias(free(rest, "__text")), about.alias(free(rest, "__length")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = known.scores(Rows.of(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), learning))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(found), pa.array((found >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    return source.mapInArrow(run, T.StructType([
        *rest.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def judged(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", length: str | None = "n_chars",
           label: str = "quality", threshold: float = 0.7, learning: Learning = Learning()) -> DataFrame:
    """One row per row of ``df``: id, held_out, score and predicted, by a machine trained on ``labels``.

    Neither labels nor ids are inputs of a score, nor are columns other than text and ``length``.
    Repeated rows are scored each alone, so equal rows get equal scores; other columns are not read. An
    empty table gives an empty one.
    """
    machine = train(df, labels, id, text, length, label, learning)
    own = free(df, "__own_id")
    name = id if id.lower() not in ("held_out", "score", "predicted") else f"{id}_in"
    return score(df.withColumn(own, F.col(f"`{id}`")), machine, text, length, threshold, learning, [own]).select(
        F.col(own).alias(name), held_out(F.col(own), learning).alias("held_out"), "score", "predicted")
