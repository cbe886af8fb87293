"""Upsert: match on key, update all other columns, else insert; the last change of a key counts.

The reference point is a MERGE that runs one row after the other. Set-wise that means:

* a repeated key in one batch is settled by an explicit order, never by partition order;
* a NULL key matches nothing, so such rows are always inserted (or rejected, by option);
* nothing is ever deleted, and an update also sets columns to NULL.

Scale: the last change of each key is found by a ``max`` over structs, which Spark combines inside
each map task, so a key holding a third of the batch leaves each task as one row. The base is read
and shuffled once at most: whole rows are merged by an anti join, where the keys of a small batch are
broadcast and the base is not shuffled at all, parts of rows by one full outer join. Rows with a NULL in their key match nothing;
they carry a number of their own beside the key, so they spread over all tasks.

Which plan suits follows from what the caller says of the batch (``batch`` of ``upsert``), never from a size:

* ``small`` (the default): a batch that hits few rows of a base of any kind.
* ``sparse``: keys scattered over a base too large to be shuffled, parts of rows too. A Bloom filter of
  the batch's keys, made by an aggregation, tells which base rows may be hit; only those go into the
  join, all others pass by unshuffled. False positives are harmless: they are joined and stay.
* ``wide``: whole rows that replace a good part of a base with one row per key. Both sides are read and
  shuffled once, as one tagged union under one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settled
from .filters import quoted


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return True


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that can match: every key column is present."""
    return df.filter(reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys]))


def unkeyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in their key."""
    return df.filter(reduce(lambda a, b: a | b, [quoted(k).isNull() for k in keys]))


def can_be_null(df: DataFrame, keys: Sequence[str]) -> bool:
    return any(df.schema[k].nullable for k in keys)


def _best(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Keys and ``_last``, a struct of the other columns of the greatest row; where in it each is."""
    rest = [c for c in changes.columns if c not in keys]
    ranked = list(order) + [c for c in rest if c not in order and _orderable(changes.schema[c].dataType)]
    rank = F.struct(*[quoted(c).alias(f"r{i}") for i, c in enumerate(ranked)])
    grouped = changes.groupBy(*[quoted(k) for k in keys])
    if set(rest) <= set(ranked):
        # the rank holds every value already
        return grouped.agg(F.max(rank).alias("_last")), {c: f"r{i}" for i, c in enumerate(ranked)}
    at = {c: f"v{i}" for i, c in enumerate(rest)}
    values = F.struct(*[quoted(c).alias(at[c]) for c in rest])
    return grouped.agg(F.max_by(values, rank).alias("_last")), at


def last_row(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (NULL lowest).

    Rows that tie on the whole order are settled by their other columns, so the result does not
    depend on how the input is partitioned. NULL groups with NULL.
    """
    if all(c in keys for c in changes.columns):
        return changes.distinct()
    best, at = _best(changes, keys, order)
    return best.select(*[quoted(c) if c in keys else F.col("_last")[at[c]].alias(c) for c in changes.columns])


def _on(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`") == F.col(f"{right}.`{k}`") for k in keys])


APART = "_apart"


def apart(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds a number that is 0 for rows with a key and differs for all rows without one, so that
    grouping and joining by key and number leaves the latter alone and deals them out evenly."""
    loose = reduce(lambda a, b: a | b, [quoted(k).isNull() for k in keys])
    return df.withColumn(APART, F.when(loose, F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("bigint")))


def merge_last(base: DataFrame, last: DataFrame, keys: Sequence[str], order: Sequence[str] = (), *,
               newest: bool = False) -> DataFrame:
    """``base`` after one full outer join with ``last``, which holds one row per key.

    Both sides carry ``apart`` numbers. Columns that ``last`` lacks keep their value on a match and
    are NULL on insert. Whether a change applies follows from the presence of a match, so it may set
    a column to NULL. With ``newest`` a base row that is greater by ``order`` stays as it is.
    """
    names = [c for c in base.columns if c != APART]
    match = _on("b", "c", [*keys, APART])
    joined = base.withColumn("_old", F.lit(True)).alias("b").join(
        last.withColumn("_new", F.lit(True)).alias("c"), match, "full_outer")
    wins = F.coalesce(F.col("c._new"), F.lit(False))
    if newest and order:
        older = (F.struct(*[F.col(f"b.`{c}`") for c in order]) > F.struct(*[F.col(f"c.`{c}`") for c in order]))
        wins = wins & ~(F.coalesce(F.col("b._old"), F.lit(False)) & older)

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(f"b.`{c}`"), F.col(f"c.`{c}`"))
        if c not in last.columns:
            return F.col(f"b.`{c}`")
        return F.when(wins, F.col(f"c.`{c}`")).otherwise(F.col(f"b.`{c}`"))

    return joined.select(*[value(c).alias(c) for c in names])


#: Bits that a Bloom filter may have at most (its words are broadcast: 16 bytes for each 64 bits), bits for
#: a key, and hash functions.
MAX_BITS, BITS_PER_KEY, N_HASHES = 1 << 24, 10, 3


def _places(keys: Sequence[Column], bits: int) -> list[Column]:
    """The bits of a key, by several hashes of it."""
    return [F.pmod(F.xxhash64(F.lit(k), *keys), F.lit(bits)) for k in range(N_HASHES)]


def bloom_words(last: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(word, mask): the set bits of a Bloom filter of all keys, 64 to a row; rows without any are left out.

    A plain aggregation: tasks combine their masks before the shuffle, so what is sent is bounded by
    the filter's size, not by the batch.
    """
    at = last.select(F.explode(F.array(*_places([quoted(k) for k in keys], bits))).alias("at"))
    mask = F.expr("shiftleft(1L, cast(at % 64 as int))")
    return at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(mask).alias("mask"))


def filter_bits(keys: int, max_bits: int = MAX_BITS) -> int:
    """Bits of a filter for so many keys: a power of two, ``BITS_PER_KEY`` for each, ``max_bits`` at most."""
    bits = 64
    while bits < min(max_bits, BITS_PER_KEY * keys):
        bits *= 2
    return bits


def marked_by_bloom(base: DataFrame, words: DataFrame, keys: Sequence[str], bits: int, name: str) -> DataFrame:
    """``base`` and a column that tells which rows the filter may hold; for all rows that it holds it does.

    ``words`` has 16 bytes for each 64 of ``bits`` at most, so it is broadcast; the base is not shuffled.
    """
    marked, hit = base, F.lit(True)
    for k, place in enumerate(_places([quoted(c) for c in keys], bits)):
        side = F.broadcast(words.select(F.col("word").alias(f"_w{k}"), F.col("mask").alias(f"_m{k}")))
        marked = marked.withColumn(f"_p{k}", place)
        marked = marked.join(side, F.shiftright(f"_p{k}", 6) == F.col(f"_w{k}"), "left")
        bit = F.expr(f"shiftleft(1L, cast(_p{k} % 64 as int))")
        hit = hit & (F.coalesce(F.col(f"_m{k}"), F.lit(0)).bitwiseAND(bit) != 0)
    return marked.select(*[quoted(c) for c in base.columns], hit.alias(name))


def split_by_bloom(base: DataFrame, words: DataFrame, keys: Sequence[str], bits: int) -> tuple[DataFrame, DataFrame]:
    """Base rows that the batch may hit, and the others. Rows without a key are never hit."""
    marked = marked_by_bloom(base, words, keys, bits, "_hit")
    hit = reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in keys]) & F.col("_hit")
    return marked.filter(hit).drop("_hit"), marked.filter(~hit).drop("_hit")


def merge_sparse(base: DataFrame, last: DataFrame, keys: Sequence[str], *, max_bits: int = MAX_BITS) -> DataFrame:
    """``base`` after merging ``last`` (one row per key; whole rows or parts), shuffling only what it may hit.

    The filter has ``BITS_PER_KEY`` bits for each key of the batch, rounded up to a power of two, and
    ``max_bits`` at most; with more keys than that more of the base goes into the join, nothing else.
    Of a repeated base key every row is updated.
    """
    # keys of one type on both sides, or their hashes differ
    last = settled(last.select(*[quoted(c).cast(base.schema[c].dataType).alias(c) for c in last.columns]), "batch")
    with_key, without = keyed(last, keys), unkeyed(last, keys)
    bits = filter_bits(with_key.count(), max_bits)
    words = settled(bloom_words(with_key, keys, bits), "bloom")
    maybe, never = split_by_bloom(base, words, keys, bits)
    merged = merge_last(apart(maybe, keys), apart(with_key, keys), keys)
    new = without.select(*[(quoted(c) if c in last.columns else F.lit(None)).cast(base.schema[c].dataType).alias(c) for c in base.columns])
    return merged.unionByName(never).unionByName(new)


def merge_wide(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``base``, which has one row per key, after merging whole rows: the last change of a key counts.

    One union of both sides, tagged, and one ``max`` over (tag, order, row) for each key, which tasks
    combine before the shuffle: a change outranks the base row, a later change an earlier one.
    """
    names = list(base.columns)
    extra = [c for c in order if c not in names]
    kinds = {c: changes.schema[c].dataType for c in extra}
    old = base.select(*[quoted(c) for c in names], *[F.lit(None).cast(kinds[c]).alias(c) for c in extra])
    new = changes.select(*[quoted(c).cast(base.schema[c].dataType).alias(c) for c in names], *[quoted(c) for c in extra])
    # old numbers and new ones must differ: rows without a key match nothing
    tagged = apart(old.withColumn("_tag", F.lit(0)).unionByName(new.withColumn("_tag", F.lit(1))), keys)
    rank = ["_tag", *order]
    best = last_row(tagged, [*keys, APART], rank)
    return best.select(*[quoted(c) for c in names])


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = (), *,
           null_keys: str = "insert", newest: bool = False, batch: str = "small") -> DataFrame:
    """The target after merging ``changes`` into ``base``.

    ``order`` names the columns that tell which change of a key came last; columns of it that the
    target does not have are used and dropped. Changes may carry fewer columns than the target.
    ``null_keys`` is ``insert`` or ``reject``. With ``newest`` the order columns must be columns of
    the target too, and older changes are ignored. ``batch`` says what kind of batch it is (see the
    module): ``small``, ``sparse`` or ``wide``; the result is the same but for repeated keys in a base,
    which ``wide`` must not have and of which ``sparse`` updates every row.
    """
    if null_keys not in ("insert", "reject"):
        raise ValueError(f"null_keys must be 'insert' or 'reject', not {null_keys!r}")
    if batch not in ("small", "sparse", "wide"):
        raise ValueError(f"batch must be 'small', 'sparse' or 'wide', not {batch!r}")
    keys = list(keys)
    brought = [c for c in changes.columns if c in base.columns]
    partial = len(brought) < len(base.columns)
    if newest and partial:
        raise ValueError("newest needs changes with all columns of the target")
    if batch != "small" and newest or batch == "wide" and partial:
        raise ValueError(f"a {batch} batch cannot be merged so: newest and, if wide, parts of rows need a small one")
    allowed = keyed(changes, keys) if null_keys == "reject" else changes
    if batch == "wide":
        return merge_wide(base, allowed, keys, order)
    wanted = apart(allowed, keys)
    named = [*keys, APART]
    last = last_row(wanted, named, order).select(*[quoted(c) for c in [*brought, APART]])
    if batch == "sparse":
        return merge_sparse(base, last.drop(APART), keys)
    marked = apart(base, keys)
    if newest or partial or all(c in named for c in wanted.columns):
        return merge_last(marked, last, keys, order, newest=newest)
    # Whole rows: all rows a change hits go, repeated ones too, and all changes come. The anti join can
    # broadcast the keys of a small batch, so the base is not shuffled; the batch is read twice for it.
    hits = last.select(*[quoted(k) for k in named]).alias("c")
    kept = marked.alias("b").join(hits, _on("b", "c", named), "left_anti")
    return kept.unionByName(last).select(*[quoted(c) for c in base.columns])
