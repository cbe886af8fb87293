"""Line dedup: repeated runs of lines by a suffix array over line ids, later copies deleted."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_SQL, free, ready_for_python, stored
from .ranked import running

#: A line takes part if it holds a word; others are passed over and stay.
HAS_WORD = r"[^\x20\x09-\x0D]"
#: Separates two hashes of one line: together they are its id of 128 bits.
SALT = "\n"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _worded(text: Column) -> Column:
    return F.filter(_lines(text), lambda x: x.rlike(HAS_WORD))


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the worded lines of the given numbers; null where nothing goes."""

    def rest(text: str | None, numbers: np.ndarray | None) -> str | None:
        if text is None or numbers is None:
            return None
        lost, kept, number = set(numbers), [], -1
        for line in text.split("\n"):
            number += (worded := bool(line.encode().split()))
            if not (worded and number in lost):
                kept.append(line)
        return "\n".join(kept)

    return pd.Series([rest(t, g) for t, g in zip(texts, gone)], dtype=object)


def _ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """Suffixes whose keys another one shares, with ``rank``: where their bucket starts in the suffix
    array. Buckets are counted before they are shuffled and sorted in ranges; a bucket is one row here,
    however many suffixes it holds. ``first`` is its earliest member."""
    buckets = (
        suffixes.groupBy(*keys).agg(F.count("*").alias("members"), F.min("place").alias("first"))
        .where("members > 1"))
    # written, so that both sides of the join are plain scans and the suffixes of a large bucket can be split
    starts = stored(running(stored(buckets, "buckets"), [], keys, "members", "rank").select(
        *(F.col(k).alias(f"__{k}") for k in keys), "rank", "first"), "starts")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    return suffixes.join(starts, same).select("row", "pos", "place", "looks", "rank", "first")


def depths(sizes: Column, min_lines: int, min_words: int) -> Column:
    """For each line of a text the depths at which runs from there on are looked up, a bit for each.

    A run is worth deleting if it has ``min_lines`` lines, or fewer that hold ``min_words`` words
    together; words are summed along the run. A run that is made of two overlapping ones of that
    kind needs no look of its own. Every run worth deleting, however long, is made of those looked up.
    The bits depend on the run's lines alone, but for the end of the text.
    """

    def bits(_: Column, pos: Column) -> Column:
        total, mask = F.lit(0), F.lit(0)
        before = behind = F.lit(False)  # whether the run without its last, and its first, line is worth deleting
        for k in range(1, min_lines + 1):
            total = total + F.get(sizes, pos + (k - 1))  # null behind the end
            enough = total.isNotNull() if k == min_lines else F.coalesce(total >= min_words, F.lit(False))
            mask = mask + F.when(enough & ~(before & behind), F.lit(1 << (k - 1))).otherwise(0)
            # of runs of k lines: the one from here, and the one from the next line
            before = F.coalesce(total >= min_words, F.lit(False))
            behind = F.coalesce(total - F.get(sizes, pos) + F.get(sizes, pos + k) >= min_words, F.lit(False))
        return mask

    return F.transform(sizes, bits)


def _deeper(found: DataFrame, step: int) -> DataFrame:
    """Ranks by ``step`` lines more, from the ranks of a suffix and of the one that many lines on."""
    ahead = Window.partitionBy("row").orderBy("pos").rangeBetween(step, step)
    pairs = found.withColumn("next", F.max("rank").over(ahead)).where("next is not null").drop("first")
    return stored(_ranked(pairs.withColumnRenamed("rank", "own"), ["own", "next"]), "suffixes")


def repeated_runs(lines: DataFrame, max_depth: int) -> DataFrame:
    """(place, depth) of runs that also stand at an earlier place, of those that ``looks`` asks for.

    ``lines``: row, pos, place (what orders suffixes in the corpus), ``looks`` (see ``depths``) and the line id
    h1, h2. Prefix doubling sorts the suffixes by one line, by two, by four and so on: the rank by more
    lines comes from the ranks by d lines of a suffix and of one up to d lines on. Suffixes alone in
    their bucket have no copy at any greater depth and leave.

    A bucket at depth d is an interval of the suffix array within which the longest common prefix is
    d or more. Its earliest place stays; for all others the first d lines are a later copy. Runs longer
    than ``max_depth`` are made of such runs one line after the other, so what is named here covers
    every maximal repeated run of the corpus that is worth deleting, but for its earliest copy.
    """

    def later(found: DataFrame, depth: int) -> DataFrame:
        asked = F.col("looks").bitwiseAND(1 << (depth - 1)) != 0
        return found.where(asked & (F.col("place") != F.col("first"))).select("place", F.lit(depth).alias("depth"))

    found, depth, parts = stored(_ranked(lines, ["h1", "h2"]), "suffixes"), 1, []
    while True:
        parts.append(later(found, depth))
        parts += [later(_deeper(found, k - depth), k) for k in range(depth + 1, min(2 * depth, max_depth))]
        if depth == max_depth:
            return reduce(DataFrame.unionAll, parts)
        step = min(depth, max_depth - depth)
        found, depth = _deeper(found, step), depth + step


def repeated_lines(df: DataFrame, id: str = "doc_id", text: str = "text", min_lines: int = 3, min_words: int = 50) -> DataFrame:
    """(id, h, gone): for each text that loses lines, numbers of its worded lines that go, from 0.

    ``h`` is the text's hash; with the id it names the text. A text whose worded lines are all those of
    an earlier one goes as a whole; it then takes no part in the search for runs, since the earliest
    copy stands for it.
    """
    body = df.select(F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), _worded(F.col(f"`{text}`")).alias("lines"))
    body = body.where(F.size("lines") > 0).withColumns({
        "row": F.monotonically_increasing_id(), "sizes": F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD_SQL)))})
    body = body.withColumn("looks", depths(F.col("sizes"), min_lines, min_words))
    cells = F.posexplode(F.arrays_zip("lines", "looks")).alias("pos", "cell")
    whole = [F.xxhash64("lines").alias("w1"), F.xxhash64(F.lit(SALT), "lines").alias("w2"), F.size("lines").alias("n")]
    line = F.col("cell.lines")
    lines = stored(body.select("id", "h", "row", *whole, cells).select(
        "row", "pos", F.struct("id", "h", "pos").alias("place"), F.col("cell.looks").alias("looks"), F.xxhash64(line).alias("h1"),
        F.xxhash64(F.concat(F.lit(SALT), line)).alias("h2"),
        *(F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in ("w1", "w2", "n"))), "lines")

    starts = lines.where("pos = 0")
    heads = stored(starts.groupBy("w1", "w2").agg(F.min("place").alias("head"), F.count("*").alias("members")).where("members > 1").select(
        F.col("w1").alias("__w1"), F.col("w2").alias("__w2"), "head"), "heads")
    copies = stored(starts.join(heads, (F.col("w1") == F.col("__w1")) & (F.col("w2") == F.col("__w2"))).where("place != head").select(
        F.col("row").alias("__row"), "place", "n"), "copies")
    rest = lines.drop("w1", "w2", "n").join(copies.select("__row"), F.col("row") == F.col("__row"), "left_anti")
    runs = repeated_runs(rest, min_lines).unionByName(copies.select("place", F.col("n").alias("depth"))).distinct()
    gone = runs.select("place.id", "place.h", F.explode(F.sequence("place.pos", F.col("place.pos") + F.col("depth") - 1)).alias("at"))
    return gone.groupBy("id", "h").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def deduplicated(df: DataFrame, id: str = "doc_id", text: str = "text", min_lines: int = 3, min_words: int = 50,
                 counts: tuple[str, str] | None = None) -> DataFrame:
    """``df`` with the later copies of repeated line runs taken out of its texts.

    A run of lines that also stands earlier in the corpus (by id, text hash and line; null ids first) is
    deleted if it has ``min_lines`` lines or ``min_words`` words or more, and so are all lines of a text
    that has the same lines as an earlier one, however few; the earliest copy stays. Runs are found
    within one text too. Only lines with a word count; blank ones are passed over and stay as they
    are. Lines must be equal in every character. Short lines that come alone stay, however common.
    With ``counts``, two columns of these names hold the worded lines of a text and those deleted.

    Every row comes back, also one that lost all its lines. Null texts stay null; texts of any length
    are whole. Rows that repeat id and text are one document and stay alike. Columns of any other name
    are kept. An empty table gives an empty one. Nothing but line ids, places and, once, the texts is
    shuffled; a line or a text that a third of the corpus shares is one row after counting.
    """
    at, of, found = (free(df, f"__{c}") for c in ("at", "of", "gone"))
    gone = repeated_lines(df, id, text, min_lines, min_words).select(
        F.col("id").alias(at), F.col("h").alias(of), F.col("gone").alias(found))
    own = F.col(f"`{text}`")
    ready_for_python(df.sparkSession)
    joined = df.join(gone, F.col(f"`{id}`").eqNullSafe(F.col(at)) & (F.xxhash64(own) == F.col(of)), "left")
    # only texts that lose lines are handed to Python
    changed = F.col(found).isNotNull()
    out = {text: F.when(changed, _without(F.when(changed, own), F.col(found))).otherwise(own)}
    n_lines = F.coalesce(F.size(_worded(F.coalesce(own, F.lit("")))), F.lit(0)).cast("long")
    n_removed = F.when(changed, F.size(found)).otherwise(0).cast("long")
    taken = {c.lower() for c in counts or ()}
    return joined.select(
        *(out.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns if c.lower() not in taken),
        *(x.alias(c) for c, x in zip(counts or (), (n_lines, n_removed))))
