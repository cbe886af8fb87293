"""Ranked lexical search turned round: documents stream through an index of the items that ask."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready_for_python, stored
from .ranked import running

#: Bounds of one broadcast index: postings (an item's distinct terms), each item counting ``ITEM_COST`` besides.
MAX_POSTINGS, ITEM_COST = 1 << 20, 64
#: Score cells that are summed at once in a task, and postings that are looked up at once.
CELLS, STEP = 1 << 21, 1 << 20
#: Heaps of the tasks are merged in so many lots for each item before the lots are.
LOTS = 64
#: Every byte of a text as its term holds it: ASCII letters in lower case, digits, bytes beyond ASCII; else a blank.
AS_TERMS = bytes(
    c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased."""
    return text.translate(AS_TERMS).split() if text else []


@dataclass(frozen=True)
class Index:
    """Terms of a block of items, and for each term the items that hold it, with how often."""

    numbers: dict[bytes, int]
    ends: np.ndarray
    items: np.ndarray
    counts: np.ndarray
    ids: list

    @classmethod
    def of(cls, rows: list) -> Index:
        numbers: dict[bytes, int] = {}
        lists: list[list[tuple[int, int]]] = []
        for item, row in enumerate(rows):
            for term, count in zip(row["terms"], row["counts"]):
                k = numbers.setdefault(bytes(term), len(lists))
                if k == len(lists):
                    lists.append([])
                lists[k].append((item, count))
        flat = np.array([p for x in lists for p in x], np.int64).reshape(-1, 2)
        return cls(numbers, np.cumsum([0, *map(len, lists)]), flat[:, 0], flat[:, 1], [r["id"] for r in rows])


def term_counts(items: DataFrame, id: str, text: str) -> DataFrame:
    """(id, terms, counts) of each item that has a term; rows that repeat id and text count once."""
    source = items.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")).where("text is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(terms(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([list(c) for c in found], pa.list_(pa.binary())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))], ["id", "terms", "counts"])

    schema = T.StructType([source.schema["id"], T.StructField("terms", T.ArrayType(T.BinaryType())),
                           T.StructField("counts", T.ArrayType(T.LongType()))])
    return source.mapInArrow(run, schema).where(F.size("terms") > 0)


def document_counts(docs: DataFrame, id: str, text: str, index) -> DataFrame:
    """(id, n, terms, counts) of each document that has a term: all its terms with repeats as ``n``, and
    the numbers of those that the index holds, with how often. Whole texts, one pass, no shuffle."""
    source = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.numbers
        for batch in batches:
            rows, sizes, ends, numbers, counts = [], [], [0], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                found = terms(text)
                if not found:
                    continue
                rows.append(k)
                sizes.append(len(found))
                for term, count in Counter(found).items():
                    number = known.get(term)
                    if number is not None:
                        numbers.append(number)
                        counts.append(count)
                ends.append(len(numbers))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int32())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(numbers, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))],
                ["id", "n", "terms", "counts"])

    schema = T.StructType([source.schema["id"], T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("counts", T.ArrayType(T.LongType()))])
    return source.mapInArrow(run, schema)


def scores(index: Index, weights: np.ndarray, owner: np.ndarray, term: np.ndarray, part: np.ndarray, docs: int) -> np.ndarray:
    """Score of every document and item of a batch, from what each term of each document is worth."""
    total = np.zeros(docs * len(index.ids), np.int64)
    lengths = index.ends[term + 1] - index.ends[term]
    worth = weights[term] * part
    ahead = np.cumsum(lengths)
    start = 0
    while start < len(term):  # as many terms as have STEP postings, one at least
        stop = max(start + 1, int(np.searchsorted(ahead, (ahead[start - 1] if start else 0) + STEP, side="right")))
        some = lengths[start:stop]
        first = np.cumsum(some) - some
        at = np.repeat(index.ends[term[start:stop]] - first, some) + np.arange(int(some.sum()))
        cell = np.repeat(owner[start:stop] * len(index.ids), some) + index.items[at]
        np.add.at(total, cell, np.repeat(worth[start:stop], some) * index.counts[at])
        start = stop
    return total.reshape(docs, len(index.ids))


class Heaps:
    """The best ``k`` of each item so far: highest score first, then the least id, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.held: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # what a score must reach

    def push(self, found: np.ndarray, ids: list) -> None:
        rows, items = np.nonzero(found >= self.least)
        order = np.argsort(items, kind="stable")
        rows, items = rows[order], items[order]
        cuts = np.flatnonzero(np.diff(items, prepend=-1))
        for low, high in zip(cuts, [*cuts[1:], len(items)]):
            item = items[low]
            new = [(-s, ids[r] is None, ids[r]) for r, s in zip(rows[low:high], found[rows[low:high], item].tolist())]
            self.held[item] = best = heapq.nsmallest(self.k, self.held[item] + new)
            if len(best) == self.k:
                self.least[item] = -best[-1][0]


def best_of_tasks(counted: DataFrame, index, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, id, score): each task's heaps over the documents that it streams through the index."""
    id_type = counted.schema["id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", id_type), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Index = index.value
        heaps = Heaps(len(known.ids), k)
        rows = max(1, CELLS // max(1, len(known.ids)))
        kind = None
        for whole in batches:
            kind = whole.schema.field(0).type
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                # numbers may pass 64 bits on the way, so Python's own divide them
                long = np.array([25 + 75 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
                size = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(batch.num_rows), size)
                term = batch.column(2).flatten().to_numpy(zero_copy_only=False)
                tf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
                part = (1_000_000_000 * tf) // (1000 * tf + 8 * long[owner])
                heaps.push(scores(known, weights, owner, term, part, batch.num_rows), batch.column(0).to_pylist())
        out = [(item, id, -s) for item, held in enumerate(heaps.held) for s, _, id in held]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], kind), pa.array([o[2] for o in out], pa.int64())],
                ["item", "id", "score"])

    return counted.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = 10, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score (over 0).

    N documents have a term, L terms in all; a document has n. A term that df of them hold weighs
    floor(1000 * ln((2N + 2) / (2 df + 1))); a document with tf of it adds to an item that holds it, for each
    time it does, weight * (10^9 tf div (1000 tf + 8 m)), m being 25 + 75 n N div L. All but the logarithm is
    64-bit integers, so ranks do not depend on the order of sums. Equal scores rank by ascending id, null last.

    The items are indexed, not the documents: blocks of items with ``max_postings`` postings at most
    (an item alone may have more) are broadcast one after the other, and all documents stream through each.
    Of a document only the counts of terms that the block holds are kept. Each task keeps a heap of
    ``k`` for each item; the heaps, not the scores, are shuffled, and merged in lots and then across them.

    Items and documents that are null, empty or without a term find and are nothing. Rows of items that
    repeat id and text are one item; those of one id with other texts are ranked each alone. Repeated
    rows of documents count each. Other columns are not read. An empty table gives an empty result. If both ids
    have one name, the document's comes with ``_found`` behind it.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    asked = stored(term_counts(items, item_id, item_text).withColumn("row", F.monotonically_increasing_id())
                   .withColumn("cost", (F.size("terms") + ITEM_COST).cast("long")), "items")
    placed = stored(running(asked, [], ["row"], "cost").withColumn("block", F.floor(F.col("before") / max_postings).cast("int")), "blocks")
    blocks = sorted(r[0] for r in placed.select("block").distinct().collect())
    parts = []
    for block in blocks:
        # bounded: MAX_POSTINGS postings beside the last item's
        index = Index.of(placed.where(F.col("block") == block).orderBy("row").select("id", "terms", "counts").collect())
        shared = spark.sparkContext.broadcast(index)
        counted = stored(document_counts(docs, id, text, shared), "counts")
        n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row for each term of the block
        weights = np.zeros(len(index.numbers), np.int64)
        for r in held:
            weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
        best = stored(best_of_tasks(counted, shared, weights, n_docs, n_terms, k).withColumn("lot", F.pmod(F.spark_partition_id(), F.lit(LOTS))), "heaps")
        parts.append(best.select(F.lit(block).alias("block"), "item", "lot", "id", "score"))
    out_id = id if id.lower() != item_id.lower() else f"{id}_found"
    names = placed.select(F.col("block").alias("__block"), (F.row_number().over(Window.partitionBy("block").orderBy("row")) - 1).alias("__item"),
                          F.col("id").alias("__name"))
    if not parts:
        kind = docs.schema[id].dataType
        return names.select(F.col("__name").alias(item_id), F.lit(1).alias("rank"), F.lit(None).cast(kind).alias(out_id),
                            F.lit(0).cast("long").alias("score")).where("false")
    order = [F.desc("score"), F.col("id").asc_nulls_last()]

    def first(df: DataFrame, *by: str) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)

    heaps = first(reduce(DataFrame.unionAll, parts), "block", "item", "lot").drop("rank")
    found = first(heaps, "block", "item")
    return found.join(names, (F.col("block") == F.col("__block")) & (F.col("item") == F.col("__item"))).select(
        F.col("__name").alias(item_id), "rank", F.col("id").alias(out_id), "score")
