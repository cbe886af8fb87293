"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free, n_words, stored
from .ranked import running

GRAIN = float(1 << 52)


def random_odds(key: Column) -> Column:
    """u / (1 - u) for a number u in (0, 1) that 52 bits of a row's digest give: the same in each run."""
    u = (F.conv(F.substring(key, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(GRAIN)
    return u / (F.lit(1.0) - u)


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with each source's target.

    Sources, by code point with null last, weigh ``weights`` in turn and share ``share`` of all sizes.
    A target stops at ``most`` times its source's size; what is above goes to the others by weight
    until none is above. Sources stop in the order of size over weight, so one pass in that order
    finds the level: the first source whose share of what is left fits fixes it for the rest.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(all_rows) - F.coalesce(
        F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = left / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    found = (
        sizes.withColumn("weight", turn).withColumn("cap", F.col("source_size") * most)
        .withColumns({"level": level, "at": F.row_number().over(by_cap)})
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("level", F.min_by(F.col("level"), F.when(F.col("fits"), F.col("at"))).over(all_rows))
        .withColumn("first", F.min(F.when(F.col("fits"), F.col("at"))).over(all_rows)))
    target = F.when(F.col("at") >= F.col("first"), F.col("level") * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return found.select("source", "source_size", target.alias("target"))


def root(size: Column) -> Column:
    """The whole root of a size, as a measure: long documents are preferred, though less than their words."""
    return F.floor(F.sqrt(size.cast("double"))).cast("long")


def rates(rows: DataFrame, aims: DataFrame, most: int) -> DataFrame:
    """(source, source_size, target, rate): the rate by which a document's measure gives its expected copies.

    Copies are in proportion to the measure, ``most`` at most, and their words add up to the target. The
    documents whose share exceeds ``most`` have it for certain; they are peeled off and the rest of the
    target is shared out by measure among the others, pass after pass, until none exceeds it. Passes go
    over the sums of each source's distinct measures; the driver sees a count.
    """
    sums = stored(rows.where("__likes > 0 and size > 0").groupBy("source", "__likes").agg(F.sum("size").alias("__words")).select(
        F.col("source").alias("__of"), "__likes", "__words"), "measures")
    capped, now = None, aims.withColumn("rate", F.lit(0.0))
    while True:
        over = F.col("rate") * F.col("__likes").cast("double") >= most
        parts = now.join(sums, F.col("source").eqNullSafe(F.col("__of")), "left").groupBy("source", "source_size", "target", "rate").agg(
            F.coalesce(F.sum(F.when(over, F.col("__words"))), F.lit(0)).alias("__sure"),
            F.sum(F.when(~over, F.col("__words") * F.col("__likes"))).cast("double").alias("__rest"), F.count_if(over).alias("__capped"))
        rate = (F.col("target") - most * F.col("__sure")) / F.col("__rest")
        new = stored(parts.select("source", "source_size", "target", F.coalesce(F.when(F.col("__rest") > 0, rate), "rate").alias("rate"), "__capped"), "rates")
        count = new.agg(F.sum("__capped")).first()[0]
        now = new.drop("__capped")
        if count == capped:
            return now
        capped = count


def mix(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (3, 1, 2),
        share: float = 1.5, most: int = 2, preference: str | Callable[[Column], Column] | None = None,
        keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``df``: id, size, source_size, target, copies, taken, and the ``keep`` columns.

    The expected copies of a document are in proportion to its measure: the column ``preference``, or
    what a function of that name makes of the size (``root``), or the same for all; 0, less or null: none.
    They are ``most`` at most and their words add up to the source's target (``rates``). The whole part is
    certain and taken as such. The fraction is the document's inclusion probability for one copy more:
    the source's documents are ranked by random odds over inclusion odds (Pareto order sampling), and
    the first ones are taken until their words fill what the target still lacks; the one that crosses
    the line is taken if more than half of it fits. So a source misses its target by half a
    document at most, unless too few of its documents have a measure, and no document gives more
    than ``most`` copies.

    Random odds come from a digest of id and text, and measures count to six decimals, so that all sums
    are exact: reruns agree. Ranking is a running total over ranges: a source that holds most rows
    spreads over the tasks. Sizes are summed before the shuffle; the table of targets has a row per
    source.

    Null and empty texts have size 0 and give nothing; texts of any length count whole. Null sources
    are one source of their own. Rows that repeat in full are ranked each alone; equal ranks fall by
    digest. A kept column named like another output is dropped. An empty table gives an empty one.
    """
    outputs = {c.lower() for c in (id, "size", "source_size", "target", "copies", "taken")}
    kept = [c for c in keep if c.lower() not in outputs]
    own = F.col(f"`{text}`")
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")),
                               F.md5(F.coalesce(own, F.lit("")).cast("binary"))).cast("binary"))
    rows = df.select(
        F.col(f"`{id}`").alias("__id"), F.col(f"`{source}`").alias("source"), n_words(own).alias("size"),
        digest.alias("__key"), F.monotonically_increasing_id().alias("__row"),
        (F.col(f"`{preference}`") if isinstance(preference, str) else F.lit(1)).alias("__likes"),
        *(F.col(f"`{c}`").alias(f"__keep{k}") for k, c in enumerate(kept)))
    likes = preference(F.col("size")) if callable(preference) else F.col("__likes")
    rows = stored(rows.withColumn("__likes", F.greatest(F.coalesce(likes.cast("decimal(20,6)"), F.lit(0)), F.lit(0)).cast("decimal(20,6)")), "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rated = rates(rows, stored(targets(sums, weights, share, most), "targets"), most).select(
        F.col("source").alias("__source"), "source_size", "target", F.col("rate").alias("__rate"))
    each = (
        rows.join(rated, rows["source"].eqNullSafe(rated["__source"])).drop("__source")
        .withColumn("__want", F.least(F.col("__rate") * F.col("__likes").cast("double"), F.lit(float(most))))
        .withColumn("__sure", F.floor("__want"))
        .withColumn("__chance", F.col("__want") - F.col("__sure"))
        .withColumn("__rank", F.when(F.col("__chance") > 0, random_odds(F.col("__key"))
                                     / (F.col("__chance") / (F.lit(1.0) - F.col("__chance")))).otherwise(float("inf")))
        .withColumn("__open", F.when((F.col("__sure") < most) & (F.col("__likes") > 0), F.col("size")).otherwise(0)))
    # a document without a free copy, or without words, cannot be sampled and goes to the end of its source
    each = each.withColumn("__rank", F.when(F.col("__open") > 0, F.col("__rank")).otherwise(float("nan")))
    sure = each.groupBy("source").agg(F.sum(F.col("__sure") * F.col("size")).alias("__sum")).select(
        F.col("source").alias("__source"), "__sum")
    ordered = running(each, ["source"], ["__rank", "__key", "__row"], "__open", "__before")
    ordered = ordered.join(stored(sure, "certain"), ordered["source"].eqNullSafe(F.col("__source")))
    chosen = (F.col("__open") > 0) & (2 * F.col("__before") + F.col("__open") <= 2 * (F.col("target") - F.col("__sum")))
    copies = F.when(F.col("size") > 0, F.col("__sure") + chosen.cast("int")).otherwise(0).cast("long")
    return ordered.withColumn("copies", copies).select(
        F.col("__id").alias(id), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *(F.col(f"__keep{k}").alias(c) for k, c in enumerate(kept)))


def mixed(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it has copies, with the columns it came with.

    The copies are found on a narrow table and come back to the texts by a row number that the
    written input fixes.
    """
    row, found = free(df, "__row_no"), free(df, "__found_no")
    numbered = stored(df.withColumn(row, F.monotonically_increasing_id()), "documents")
    copies = mix(numbered, id, text, source, keep=[row], **how).where("copies > 0").select(
        F.col(row).alias(found), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy"))
    return numbered.join(copies, numbered[row] == copies[found]).select(*(numbered[f"`{c}`"] for c in df.columns))
