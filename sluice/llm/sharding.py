"""K-d tree sharding: weighted medians along the widest metadata dimension. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, stored
from .ranked import running

KEY = ["h", "crc", "size"]


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def ranked(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with column ``name``, a number or any text, as a double that keeps its order.

    Numbers stay as they are. The distinct values of anything else are numbered in the order of their
    whole texts, by a running count over ranges, and joined back; nothing is cut off, so no two values
    share a number. Null stands at -1, and so do numbers that are not finite.
    """
    if dict(rows.dtypes)[name].split("(")[0] in NUMBERS:
        number = F.col(name).cast("double")
        return rows.withColumn(name, F.when(F.abs(number) < float("inf"), number).otherwise(-1.0))
    values = rows.select(F.col(name).alias("value")).where("value is not null").distinct().withColumn("one", F.lit(1))
    numbers = stored(running(stored(values, "values"), [], ["value"], "one", "number").select(
        F.col("value").alias("__value"), F.col("number").cast("double").alias("__number")), "numbers")
    joined = rows.join(numbers, F.col(name) == F.col("__value"), "left")
    return joined.withColumn(name, F.coalesce("__number", F.lit(-1.0))).drop("__value", "__number")


def kd_shards(df: DataFrame, shards: int, id: str = "doc_id", text: str = "text",
              dimensions: Sequence[str] = ("source", "lang", "n_chars"), whole: float = 0.05) -> DataFrame:
    """One row per row of ``df``: id, size, text_crc32, shard (0 to shards - 1) and slot in the shard.

    The tree splits units, each of them all rows with one text, at the weighted median of the
    dimension that is widest in the node (its range as a share of the whole table's; the first of
    equals), for an odd number of leaves at the matching fraction, until each leaf has the target of
    1/shards of all bytes. A unit's place is the least of all copies of its text. Ties in a dimension fall by the
    text's hash, after the heavy texts, so that a cut rather falls among light ones. Medians come from running
    totals over ranges, so no node's rows meet in one task. Axes and cuts of a level are a table with a
    row for each node, which is joined: no plan grows with the shards, and the driver sees one row.

    Equal texts stay in one shard as long as they weigh no more than ``whole`` of a shard. A cut misses its
    median by half a unit at most and each level halves what is passed on, so a shard's size is off by
    about ``whole`` at most. Of heavier texts there are at most shards / whole; their rows are dealt to several
    units, which lie side by side, so that only a cut through them parts them and sizes stay near equal.

    Null texts have size 1 and the checksum of no bytes; texts of any length count whole. Null metadata
    stand at -1 in their dimension. Rows repeated in full count each. Slots are gapless from 0 in each
    shard. Extra columns are not read, whatever their names; an id named like an output comes with
    ``_in`` behind it. An empty table gives an empty one.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    place = [f"c{k}" for k in range(len(dimensions))]

    def raw(name: str) -> Column:
        own = F.col(f"`{name}`")
        return own if dict(df.dtypes)[name].split("(")[0] in NUMBERS else own.cast("string")

    rows = stored(df.select(
        F.col(f"`{id}`").alias("id"), text_size(F.col(f"`{text}`")).alias("size"), F.crc32(body.cast("binary")).alias("crc"),
        F.xxhash64(F.col(f"`{text}`")).alias("h"), F.monotonically_increasing_id().alias("row"),
        *(raw(name).alias(c) for c, name in zip(place, dimensions))), "rows")
    for c in place:
        rows = ranked(rows, c)
    rows = stored(rows, "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = max(1.0, whole * total / shards)

    heavy = (
        rows.groupBy(*KEY).agg(F.sum("size").alias("weight"), *(F.min(k).alias(f"least_{k}") for k in place))
        .where(F.col("weight") > limit)
        .select(*KEY, F.ceil(F.col("weight") / limit).alias("ways"), (-F.col("weight")).alias("heft"),
                *(f"least_{k}" for k in place)))
    salted = (
        rows.join(F.broadcast(heavy), KEY, "left")  # at most shards / whole rows
        .withColumn("salt", F.pmod(F.xxhash64("row"), F.coalesce("ways", F.lit(1))))
        .withColumn("heft", F.coalesce("heft", F.lit(0)))
        # the place of a text, not of those of its rows that share a salt
        .withColumns({k: F.coalesce(f"least_{k}", k) for k in place}).drop("ways", *(f"least_{k}" for k in place)))
    units = stored(
        salted.groupBy(*KEY, "salt", "heft")
        .agg(F.sum("size").alias("weight"), *(F.min(k).alias(k) for k in place))
        .withColumns({"first": F.lit(0), "leaves": F.lit(shards)}), "units")

    ranges = [F.min(k).alias(f"low_{k}") for k in place] + [F.max(k).alias(f"high_{k}") for k in place]
    extent = units.agg(*ranges).first()
    span = {k: (extent[f"high_{k}"] or 0.0) - (extent[f"low_{k}"] or 0.0) or 1.0 for k in place}
    half = F.floor(F.col("leaves") / 2).cast("int")
    most = shards
    while most > 1:
        widths = F.array(*((F.col(f"high_{k}") - F.col(f"low_{k}")) / span[k] for k in place))
        nodes = stored(units.groupBy("first", "leaves").agg(F.sum("weight").alias("all"), *ranges).select(  # a row for each node
            F.col("first").alias("__first"), F.array_position(widths, F.array_max(widths)).cast("int").alias("wide"),
            (F.lit(2.0) * F.col("all") * half / F.col("leaves")).alias("cut")), "nodes")
        split = units.join(nodes, F.col("first") == F.col("__first")).withColumn("axis", F.element_at(F.array(*place), F.col("wide")))
        ordered = running(split.drop("__first", "wide"), ["first"], ["axis", "heft", *KEY, "salt"], "weight")
        left = 2 * F.col("before") + F.col("weight") <= F.col("cut")
        single = F.col("leaves") == 1
        units = stored(ordered.withColumns({
            "first": F.when(single | left, F.col("first")).otherwise(F.col("first") + half),
            "leaves": F.when(single, 1).when(left, half).otherwise(F.col("leaves") - half),
        }).drop("axis", "cut", "before"), "units")
        most = -(-most // 2)

    placed = salted.join(units.select(*KEY, "salt", F.col("first").alias("shard")), [*KEY, "salt"])
    numbered = running(
        placed.select("id", "size", "crc", "h", "row", "shard", F.lit(1).alias("one")), ["shard"], ["h", "crc", "size", "row"],
        "one", "slot")
    name = id if id.lower() not in ("size", "text_crc32", "shard", "slot") else free(numbered, f"{id}_in")
    return numbered.select(F.col("id").alias(name), "size", F.col("crc").alias("text_crc32"), "shard", F.col("slot").cast("long").alias("slot"))
