"""SimHash near-dedup by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, map_texts, stored
from .components import components

BITS = 64
BLOCK = 1 << 14
#: Variants that a task makes, at most and about.
VARIANTS_PER_TASK = 1 << 22


def fingerprint(text: str | None, words: int, seed: int) -> int:
    """SimHash of a text's word shingles, each counted as often as it occurs."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[k:] for k in range(words))))
    n = max(1, len(tokens) - words + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, BLOCK):
        block = hashes[i : i + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, text: str = "text", keep: list[str] | None = None, words: int = 3, seed: int = 42,
                 name: str = "fingerprint") -> DataFrame:
    """The ``keep`` columns and the 64-bit fingerprint of each whole text as a long; no shuffle."""

    def start():
        return lambda texts: [pa.array([fingerprint(t, words, seed) for t in texts], pa.int64())]

    keep = [c for c in df.columns if c != text] if keep is None else keep
    return map_texts(df, text, keep, T.StructType([T.StructField(name, T.LongType())]), start)


def ball(radius: int) -> list[int]:
    """All masks of at most ``radius`` of 64 bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(BITS), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def link_edges(prints: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) that connect what lies within ``max_bits`` of each other.

    ``prints``: distinct fingerprints in column ``fp``. Each emits all variants in a ball of half the
    distance (rounded up); two fingerprints within the distance share a variant half-way. At most
    one fingerprint for each mask can emit a given variant, so a variant's group has at most as
    many members as there are masks, whatever the input. Within an even distance all of a group lie
    within it of each other, so linking each to the least of its group loses no connection;
    otherwise all pairs of the bounded group are verified. Colliding pairs are deduplicated
    before the bits are counted.
    """
    half = (max_bits + 1) // 2
    masks = F.lit(ball(half)).cast("array<long>") if half else F.array(F.lit(0).cast("long"))
    # fingerprints are few bytes and few files; their variants are not, so they are dealt out before
    tasks = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                -(-prints.count() * variants_per_print(max_bits) // VARIANTS_PER_TASK))
    variants = prints.repartition(tasks, "fp").select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    groups = (
        variants.groupBy("variant").agg(F.min("fp").alias("least"), F.collect_set("fp").alias("members"))
        .where(F.size("members") > 1))
    if max_bits == 2 * half:
        pairs = groups.select(F.col("least").alias("a"), F.explode("members").alias("b"))
    else:
        pairs = groups.select(F.explode("members").alias("a"), "members").select("a", F.explode("members").alias("b"))
    return pairs.where("a < b").distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def near_groups(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 2,
                seed: int = 42) -> DataFrame:
    """One row per row of ``df``: its id, ``fp`` (long) and ``component_id``.

    Fingerprints at most ``max_bits`` apart are linked; ``component_id`` is the smallest id that links
    reach, the row's own included. Equal fingerprints meet once as one class, so copies are never
    paired; what is shuffled per class is its ball of variants.

    Texts of any length are hashed whole, block by block. Null and empty texts have fingerprint zero and link like any other. Null ids are passed over by
    the smallest id and get a component id; only if a component has no other is it null. Repeated
    rows stay repeated. Extra columns are not read; an empty table gives an empty one.
    """
    # written once: the texts are read and hashed a single time
    marked = stored(fingerprints(df.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").alias("text")),
                                 "text", ["__id"], words, seed, "fp"), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("__id").alias("first")), "classes")
    roots = components(link_edges(classes.select("fp"), max_bits))
    rooted = (
        classes.join(roots, classes["fp"] == roots["node"], "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # written, so that both sides of the next join are plain scans and a frequent fingerprint can be split
    named = stored(rooted.join(least, "root").select("fp", "component_id"), "components")
    return marked.join(named, "fp").select(F.col("__id").alias(id), "fp", "component_id")


def as_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``df`` whose id names their component: one document of each group, all columns.

    Of rows that repeat that id all stay, as they are one document; rows with a null id stay only if
    their component has no id.
    """
    component = free(df, "__component")
    groups = near_groups(df, id, text, words, max_bits).where(F.col(id).eqNullSafe(F.col("component_id")))
    first = groups.select(F.col(id).alias(component)).distinct()
    return df.join(first, df[id].eqNullSafe(first[component]), "left_semi")


def variants_per_print(max_bits: int) -> int:
    """Rows that each distinct fingerprint sends into the shuffle."""
    return sum(comb(BITS, k) for k in range((max_bits + 1) // 2 + 1))
