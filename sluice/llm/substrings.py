"""Substring dedup: count-min prefilter over windows of words, then exact grouping."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.merge import bloom_words, filter_bits, marked_by_bloom

from .common import map_texts, ready_for_python, stored

#: Odd multipliers of the two rolling hashes, and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
#: Cells of a sketch row for each counted gram, and rows of cells.
CELLS_PER_GRAM, DEPTH = 8, 2
#: Cells of a row that are merged at a time (a shard), and grams that a task counts before it sends them on.
SHARD_CELLS, FLUSH = 1 << 22, 1 << 20
#: Bits of the filter that keeps texts without suspect windows out of a shuffle.
FILTER_BITS = 1 << 26
#: Windows hashed at once.
BLOCK = 1 << 16


@cache
def _powers(base: int, log: int) -> np.ndarray:
    out = np.full(1 << log, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scatters 64-bit numbers: multiplications and shifts, one to one."""
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def rolling(hashes: np.ndarray, length: int, which: int) -> np.ndarray:
    """A hash of every ``length`` consecutive words, from one pass of sums: equal runs, equal hashes."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    if n > BLOCK:  # a hash does not depend on the place, so long texts go block by block
        return np.concatenate([rolling(hashes[i : i + BLOCK + length - 1], length, which) for i in range(0, n, BLOCK)])
    log = int(len(hashes)).bit_length()
    powers, back = _powers(BASES[which], log), _powers(INVERSES[which], log)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mixed(hashes, which) * powers[: len(hashes)], out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * back[:n])


def least_grams(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of words, the place of its least gram; and the grams' hashes.

    A gram is half a window. The least one (the first of equals) depends on the window's words
    alone, so documents that share a window share its least gram: a window occurs at most as often
    as that gram. Neighbouring windows mostly share theirs, so there are few of them.
    """
    gram = window // 2
    grams = rolling(hashes, gram, 0)
    if len(hashes) < window:
        return np.empty(0, np.int64), grams
    ahead = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    return np.arange(len(ahead)) + ahead.argmin(axis=1), grams


SURVEYED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("whole", T.BinaryType()), T.StructField("sha", T.StringType()),
    T.StructField("grams", T.ArrayType(T.LongType())), T.StructField("spots", T.ArrayType(T.IntegerType())),
])


def _lists(parts: list[np.ndarray], kind: type, arrow: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    values = np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, arrow))


def _survey(window: int):
    """Of each text: words, a 128-bit hash of the word sequence, its digest, and its least grams."""

    def work(texts: list[str | None]) -> list[pa.Array]:
        counts, wholes, shas, grams, spots = [], [], [], [], []
        for text in texts:
            words = (text or "").encode().split()
            body = b" ".join(words)
            counts.append(len(words))
            wholes.append(xxhash.xxh3_128_digest(body))
            shas.append(hashlib.sha256(body).hexdigest())
            least, hashes = least_grams(word_hashes(words) if len(words) >= window else np.empty(0, np.uint64), window)
            at = np.unique(least)
            spots.append(at)
            grams.append(hashes[at].view(np.int64))
        return [pa.array(counts, pa.int64()), pa.array(wholes, pa.binary()), pa.array(shas, pa.string()),
                _lists(grams, np.int64, pa.int64()), _lists(spots, np.int32, pa.int32())]

    return lambda: work


#: How far a gram's hash is shifted, and added to itself bit by bit, for the cell in each row.
SHIFTS = ((), (17, 41))


def cells_of(grams: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each gram in each row; grams are hashes, so their bits are as good as random."""
    out = []
    for shifts in SHIFTS:
        x = grams
        for by in shifts:
            x = x ^ (grams >> np.uint64(by))
        out.append((x & np.uint64(width - 1)).astype(np.int64))
    return out


def cell_of(gram: Column, row: int, width: int) -> Column:
    """The same as an expression."""
    x = gram
    for by in SHIFTS[row]:
        x = x.bitwiseXOR(F.shiftrightunsigned(gram, by))
    return x.bitwiseAND(F.lit(width - 1))


def _payload(cells: np.ndarray) -> bytes:
    """Distinct cells of one shard and how often each was hit (255 at most), as sorted steps."""
    cell, count = np.unique(cells, return_counts=True)
    steps = np.diff(cell, prepend=0).astype(np.uint32)
    return zlib.compress(steps.tobytes() + np.minimum(count, 255).astype(np.uint8).tobytes(), 1)


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """(row, word, mask): a count-min sketch over ``docs.grams``, as the cells that hold two or more, 64 to a word.

    Every task counts its grams in a sketch of its own and sends the cells that it hit, by ranges of
    cells (shards) and packed. Shard by shard the partial sketches are added up, so a task holds
    ``SHARD_CELLS`` counts however wide the sketch is. Its width follows the number of grams, without a bound;
    nothing of it reaches the driver.
    """
    size = min(width, SHARD_CELLS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= FLUSH:
                yield from packed(np.concatenate(held))
                held = []
        if held:
            yield from packed(np.concatenate(held))

    def packed(grams: np.ndarray) -> Iterator[pa.RecordBatch]:
        shards, bodies = [], []
        for row, cells in enumerate(cells_of(grams, width)):
            cells.sort()
            own = cells // size
            at = np.flatnonzero(np.diff(own, prepend=-1))
            for low, high in zip(at, [*at[1:], len(cells)]):
                shards.append(int(own[low]) * DEPTH + row)
                bodies.append(_payload(cells[low:high] - own[low] * size))
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(bodies, pa.binary())], ["shard", "counts"])

    def words(shard: int, counts: np.ndarray) -> pa.RecordBatch:
        bits = np.packbits(counts >= 2, bitorder="little").view(np.int64)
        at = np.flatnonzero(bits)
        first = shard // DEPTH * (size // 64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), shard % DEPTH, np.int32)), pa.array(at + first), pa.array(bits[at])], ["row", "word", "mask"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(size, np.uint8)
        for batch in batches:  # in the order of shards
            for shard, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard != now:
                    if now is not None:
                        yield words(now, counts)
                    now = shard
                    counts[:] = 0
                raw = zlib.decompress(body)
                n = len(raw) // 5
                cell = np.cumsum(np.frombuffer(raw, np.uint32, n), dtype=np.int64)
                more = np.frombuffer(raw, np.uint8, n, 4 * n)
                have = counts[cell]
                counts[cell] = np.where(have > 255 - more, np.uint8(255), have + more)
        if now is not None:
            yield words(now, counts)

    parts = docs.select("grams").mapInArrow(build, "shard long, counts binary")
    ordered = parts.repartition("shard").sortWithinPartitions("shard")
    return stored(ordered.mapInArrow(merge, "row int, word long, mask long"), "sketch")


def estimated_repeats(docs: DataFrame, width: int) -> DataFrame:
    """(doc, gram, spot) of grams that the sketch estimates to occur twice or more.

    Grams meet the sketch's words in a join, row by row of the sketch: what the first row tells to be
    single does not go on to the second. Both sides are plain tables, so a frequent word can be split.
    """
    counted = sketch(docs, width)
    left = docs.select("doc", F.explode(F.arrays_zip("grams", "spots")).alias("at")).select(
        "doc", F.col("at.grams").alias("gram"), F.col("at.spots").alias("spot"))
    for row in range(DEPTH):
        words = counted.where(F.col("row") == row).select(F.col("word").alias("__word"), "mask")
        cell = cell_of(F.col("gram"), row, width)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int"))
        left = left.join(words, F.shiftrightunsigned(cell, 6) == F.col("__word")).where(F.col("mask").bitwiseAND(bit) != 0).select("doc", "gram", "spot")
    return left


def _earlier(least: str, own: str):
    """Whether another id is smaller; a null id comes after every other."""
    return F.col(least).isNotNull() & (F.col(own).isNull() | (F.col(least) < F.col(own)))


def removals(df: DataFrame, id: str = "doc_id", text: str = "text", window: int = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What goes, in three tables: the survey of all rows, copies of whole texts, and (id, whole,
    text, starts) for the first copies that lose windows, with the places where those start.

    1. Rows with equal word sequences form a class; its smallest id stands for it, since every
       window of the others also starts there.
    2. A count-min sketch over the least grams of these documents overestimates how often their
       windows occur; a window with a gram estimated at one occurs once and is left out.
    3. Of the estimated repeats, grams found in one document only are left out by exact counting.
    4. Windows whose gram is left are grouped exactly, by 128 bits of rolling hash.
    """
    surveyed = stored(map_texts(
        df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")), "text", ["id"], SURVEYED, _survey(window))
        .withColumn("doc", F.monotonically_increasing_id()), "survey")
    long = surveyed.where(F.col("n_words") >= window)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc"))
    heads = stored(long.groupBy("whole").agg(first.alias("first")).select(
        F.col("whole").alias("__whole"), F.col("first.id").alias("__head"), F.col("first.doc").alias("__doc")), "heads")
    # joined by what tells the rows of a class apart, so that one text of many copies spreads over the tasks
    same = (F.col("whole") == F.col("__whole")) & F.col("id").eqNullSafe(F.col("__head"))
    copies = long.select("id", "whole").join(heads, same, "left_anti").distinct()
    firsts = stored(long.join(heads.select("__doc"), F.col("doc") == F.col("__doc")).select("id", "whole", "grams", "spots", "doc"), "firsts")

    total = firsts.agg(F.sum(F.size("grams"))).first()[0] or 0
    width = max(1 << 12, 1 << (CELLS_PER_GRAM * total).bit_length())
    repeats = stored(estimated_repeats(firsts, width), "repeats")
    shared = stored(repeats.groupBy("gram").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low != high").select("gram"), "grams")
    found = repeats.join(shared, "gram").groupBy("doc").agg(F.collect_set("spot").alias("spots"))
    spots = stored(found.join(firsts.select(F.col("doc").alias("__doc"), "id", "whole"), F.col("doc") == F.col("__doc")).select(
        "id", "whole", F.col("spots").alias("spots")), "spots")

    # of the texts only those with suspect windows, and few others, are shuffled
    bits = filter_bits(spots.count(), FILTER_BITS)
    words = stored(bloom_words(spots, ["id"], bits), "filter")
    texts = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    texts = marked_by_bloom(texts, words, ["id"], bits, "__may").where("__may").drop("__may")
    ready_for_python(df.sparkSession)
    source = texts.join(
        spots.select(F.col("id").alias("__id"), "whole", "spots"), F.col("id").eqNullSafe(F.col("__id"))).select(
        "id", "text", "whole", "spots")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, first, second, starts = [], [], [], []
            for k, (body, whole, spots) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                words = body.encode().split() if body else []
                if xxhash.xxh3_128_digest(b" ".join(words)) != whole:
                    continue  # another text under the same id
                hashes = word_hashes(words)
                least, _ = least_grams(hashes, window)
                at = np.flatnonzero(np.isin(least, spots))
                rows.append(k)
                starts.append(at)
                first.append(rolling(hashes, window, 0)[at].view(np.int64))
                second.append(rolling(hashes, window, 1)[at].view(np.int64))
            found = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(found) for c in (0, 1, 2)), _lists(first, np.int64, pa.int64()),
                 _lists(second, np.int64, pa.int64()), _lists(starts, np.int32, pa.int32())],
                ["id", "text", "whole", "h1", "h2", "start"])

    schema = T.StructType([
        source.schema["id"], source.schema["text"], source.schema["whole"], T.StructField("h1", T.ArrayType(T.LongType())),
        T.StructField("h2", T.ArrayType(T.LongType())), T.StructField("start", T.ArrayType(T.IntegerType()))])
    suspects = stored(source.mapInArrow(windows, schema), "suspects")
    each = suspects.select("id", "whole", F.explode(F.arrays_zip("h1", "h2", "start")).alias("w")).select("id", "whole", "w.h1", "w.h2", "w.start")
    least = each.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.min("whole").alias("low"), F.max("whole").alias("high")).where("low != high")
    # written, so that both sides of the join are plain scans and a frequent window can be split
    starts = each.join(stored(least.select("h1", "h2", "least"), "windows"), ["h1", "h2"]).where(_earlier("least", "id")).groupBy("id", "whole").agg(
        F.collect_set("start").alias("starts"))
    cut = suspects.select("id", "whole", "text").join(
        starts.select(F.col("id").alias("__id"), F.col("whole").alias("__whole"), "starts"),
        F.col("id").eqNullSafe(F.col("__id")) & (F.col("whole") == F.col("__whole"))).select("id", "whole", "text", "starts")
    return surveyed, copies, cut


def deduplicated(df: DataFrame, id: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """One row per row of ``df``: id, n_words, n_removed, and kept_sha256 of the words left, joined by
    one space; ``kept_text`` holds them where some but not all words go, else null.

    A word goes if it lies in a window of ``window`` words whose sequence also starts in a document with
    a smaller id, judged on the input. A null id is larger than any other. Rows that share an id
    remove nothing from one another; rows that repeat in full get the same result each. Null, empty
    and short texts lose nothing. Extra columns are not read; an empty table gives an empty one.
    """
    surveyed, copies, cut = removals(df, id, text, window)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, bodies = [], []
            for body, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = body.encode().split()
                edges = np.zeros(len(words) + 1, np.int32)
                at = np.array(starts)
                edges[at] += 1
                edges[at + window] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                counts.append(int(gone.sum()))
                bodies.append(b" ".join([words[i] for i in np.flatnonzero(~gone)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()),
                 pa.array([b.decode() for b in bodies], pa.string())], ["id", "whole", "n_cut", "cut_sha", "cut_text"])

    schema = T.StructType([
        cut.schema["id"], cut.schema["whole"], T.StructField("n_cut", T.LongType()), T.StructField("cut_sha", T.StringType()),
        T.StructField("cut_text", T.StringType())])
    changed = cut.mapInArrow(kept, schema).dropDuplicates(["id", "whole"]).unionByName(
        copies.withColumns({"n_cut": F.lit(None).cast("long"), "cut_sha": F.lit(None).cast("string"), "cut_text": F.lit(None).cast("string")}))
    changed = changed.select(F.col("id").alias("__id"), F.col("whole").alias("__whole"), F.lit(True).alias("touched"), "n_cut", "cut_sha", "cut_text")
    base = surveyed.select("id", "whole", "n_words", "sha")
    joined = base.join(changed, F.col("id").eqNullSafe(F.col("__id")) & (F.col("whole") == F.col("__whole")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.col("id").alias(id), "n_words",
        F.when(F.col("touched"), F.coalesce("n_cut", "n_words")).otherwise(0).alias("n_removed"),
        F.when(F.col("touched"), F.coalesce("cut_sha", F.lit(empty))).otherwise(F.col("sha")).alias("kept_sha256"),
        F.col("cut_text").alias("kept_text"))
