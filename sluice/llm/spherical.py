"""Embedding near-dedup by spherical-cap filters: random product codes, list decoding, verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import acos, ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready_for_python, stored
from .components import components

#: Most vectors on one side of a verified tile.
TILE = 2048
#: Allowance for rounding when a filter's score is compared.
SLACK = 1e-9


@cache
def product_code(dim: int, blocks: int, size: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A random rotation, and for each block of coordinates ``size`` random directions.

    A filter is one direction per block, put together and scaled to length 1, so ``blocks * size`` small
    vectors stand for ``size ** blocks`` filter directions.
    """
    rng = np.random.default_rng([seed, dim, blocks, size])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    parts = []
    for cut in np.array_split(np.arange(dim), min(blocks, dim)):
        code = rng.standard_normal((size, len(cut)))
        parts.append(code / np.linalg.norm(code, axis=1, keepdims=True) / np.sqrt(min(blocks, dim)))
    return rotation, parts


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by a power of two, so that no square overflows or vanishes."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def block_scores(x: np.ndarray, blocks: int, size: int, seed: int) -> list[np.ndarray]:
    rotation, parts = product_code(x.shape[1], blocks, size, seed)
    turned = unit(x) @ rotation
    ends = np.cumsum([0, *(p.shape[1] for p in parts)])
    return [turned[:, a:b] @ p.T for a, b, p in zip(ends, ends[1:], parts)]


def nearest(scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's best filter and the angle to it: the best direction of every block."""
    best = np.zeros(len(scores[0]), np.int64)
    score = np.zeros(len(scores[0]))
    for s in scores:
        best = best * s.shape[1] + s.argmax(axis=1)
        score += s.max(axis=1)
    return best, np.arccos(np.clip(score, -1, 1))


def list_decode(scores: list[np.ndarray], least: float) -> np.ndarray:
    """All filters whose score with one vector is ``least`` or more.

    Walks the tree of blocks and keeps a prefix only as long as the best completion can reach the
    bound, so the work follows the length of the list, not the number of filters.
    """
    best = np.array([s.max() for s in scores])
    index, total = np.zeros(1, np.int64), np.zeros(1)
    for k, s in enumerate(scores):
        reached = total[:, None] + s[None, :]
        keep = reached + best[k + 1 :].sum() >= least
        index = (index[:, None] * len(s) + np.arange(len(s)))[keep]
        total = reached[keep]
    return index


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def verify(table: pa.Table, threshold: float, kind: str) -> pa.Table:
    """Links between the inserted and the asking vectors of one tile: for each linked vector the rows
    it is linked with, and the least node of its component within the tile."""
    data = table.select(["node", "weight", "angle", "asks"]).to_pydict()
    node, weight, angle, asks = (np.array(data[c]) for c in ("node", "weight", "angle", "asks"))
    x = _matrix(table.column("vector").combine_chunks(), kind)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    norm = np.linalg.norm(x, axis=1)
    a, b = np.flatnonzero(~asks), np.flatnonzero(asks)
    before = (angle[a, None] < angle[None, b]) | ((angle[a, None] == angle[None, b]) & (node[a, None] < node[None, b]))
    linked = before & ((x[a] @ x[b].T) / (norm[a, None] * norm[None, b]) >= threshold)
    near_a, near_b = node[a].copy(), node[b].copy()
    top = np.iinfo(np.int64).max
    while True:  # least node by turns of both sides, until nothing changes
        new_b = np.minimum(near_b, np.where(linked, near_a[:, None], top).min(axis=0, initial=top))
        new_a = np.minimum(near_a, np.where(linked, new_b[None, :], top).min(axis=1, initial=top))
        if (new_a == near_a).all() and (new_b == near_b).all():
            break
        near_a, near_b = new_a, new_b
    links_a, links_b = linked @ weight[b], weight[a] @ linked
    some_a, some_b = linked.any(axis=1), linked.any(axis=0)
    return pa.table({
        "node": np.concatenate([node[a][some_a], node[b][some_b]]).astype(np.int64),
        "links": np.concatenate([links_a[some_a], links_b[some_b]]).astype(np.int64),
        "near": np.concatenate([near_a[some_a], near_b[some_b]]).astype(np.int64)})


def near_groups(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98,
                blocks: int = 2, seed: int = 7) -> DataFrame:
    """One row per row of ``df``: its id, n_links, component_id and kept.

    Vectors are compared if their labels are equal and not null, and if they are as long as one
    another. Equal vectors of a label form a class that is compared once.

    Each class is inserted at the filter direction nearest to it, and asks at every filter whose
    angle is at most its own nearest angle plus that of the threshold. Take a pair within the
    threshold, and of the two the one nearer to its filter: the other's angle to that filter is at
    most the sum of the first one's and the threshold's, so it asks there. Hence no pair is missed,
    whatever the code, and each is verified in one place only: where its nearer vector is inserted.
    The code has about as many filters as the largest label's classes fill tiles, and no more than the
    square root of their number: a vector asks at a good part of all filters, so it is sent to as few as
    tiles allow.

    Vectors meet in tiles of a filter, of ``TILE`` vectors at most on a side; a filter that holds more
    is dealt over several tiles. A tile gives a row for each linked vector, not for each pair.

    Vectors that are null, empty, zero, or hold a null or non-finite component, and those with a
    null label, link with nothing: 0 links, their own component, kept. Rows repeated in full link
    with one another. Null ids are passed over by the smallest id. Extra columns are not read; an
    empty table gives an empty one.
    """
    ready_for_python(df.sparkSession)
    kind = "<f4" if df.schema[vector].dataType.elementType == T.FloatType() else "<f8"
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    source = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    if kind == "<f8":
        source = source.withColumn("vector", F.col("vector").cast("array<double>"))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    source = source.withColumn("vector", F.when(usable, F.col("vector")))
    plain = T.StructType([source.schema["id"], source.schema["label"], T.StructField("vector", T.BinaryType())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if v is None else (np.array(v, kind) + 0).tobytes() for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["id", "label", "vector"])

    rows = stored(source.mapInArrow(packed, plain), "vectors")
    classes = stored(
        rows.where("vector is not null").groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("id").alias("head"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    size = max(4, ceil(min(most / TILE, most**0.5) ** (1 / blocks)))
    reach = acos(threshold)

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            lengths = np.array([len(v) for v in vectors])
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                some = batch.take(pa.array(at))
                scores = block_scores(_matrix(some.column(2), kind), blocks, size, seed)
                best, angle = nearest(scores)
                bounds = np.cos(np.minimum(np.pi, angle + reach)) - SLACK
                lists = [list_decode([s[k] for s in scores], bounds[k]) for k in range(len(at))]
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(angle), pa.array(best), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))],
                    ["node", "label", "vector", "weight", "angle", "best", "asked"])

    coded = T.StructType([
        T.StructField("node", T.LongType()), classes.schema["label"], T.StructField("vector", T.BinaryType()), T.StructField("weight", T.LongType()),
        T.StructField("angle", T.DoubleType()), T.StructField("best", T.LongType()), T.StructField("asked", T.ArrayType(T.LongType()))])
    codes = stored(classes.select("node", "label", "vector", "weight").mapInArrow(filters, coded), "codes")
    body = ["node", "label", "vector", "weight", "angle"]
    place = ["label", "long", "filter"]
    at = F.explode(F.concat(
        F.array(F.struct(F.col("best").alias("filter"), F.lit(False).alias("asks"))),
        F.transform("asked", lambda f: F.struct(f.alias("filter"), F.lit(True).alias("asks")))))
    spots = codes.select(*body, F.length("vector").alias("long"), at.alias("at")).select(*body, "long", "at.filter", "at.asks")
    ways = (
        spots.groupBy(*place).agg(
            F.ceil(F.count_if(~F.col("asks")) / TILE).cast("int").alias("ways_in"), F.ceil(F.count_if("asks") / TILE).cast("int").alias("ways_ask"))
        .where("ways_in > 1 or ways_ask > 1"))
    turn = F.xxhash64("node")
    dealt = (
        spots.join(ways, place, "left").na.fill(1, ["ways_in", "ways_ask"])
        .withColumn("tile_in", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.greatest("ways_in", F.lit(1)) - 1)).otherwise(
            F.array(F.pmod(turn, F.col("ways_in")).cast("int")))))
        .withColumn("tile_ask", F.explode(F.when(F.col("asks"), F.array(F.pmod(turn, F.col("ways_ask")).cast("int"))).otherwise(
            F.sequence(F.lit(0), F.greatest("ways_ask", F.lit(1)) - 1)))))
    found = stored(
        dealt.select(*place, "tile_in", "tile_ask", "node", "weight", "angle", "asks", "vector")
        .groupBy(*place, "tile_in", "tile_ask")
        .applyInArrow(lambda table: verify(table, threshold, kind), "node long, links long, near long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("near").alias("b")))
    named = (
        classes.join(links, "node", "left").join(roots, "node", "left")
        .select("label", "vector", "head", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")))
    least = named.groupBy("root").agg(F.min("head").alias("component_id"))
    # written, so that both sides of the last join are plain scans and a frequent vector can be split
    known = stored(named.join(least, "root").select(
        F.col("label").alias("__label"), F.col("vector").alias("__vector"), "n_links", "component_id", F.lit(True).alias("known")), "known")
    joined = rows.join(known, (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector")), "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"))
