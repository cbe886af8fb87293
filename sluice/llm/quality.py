"""Quality rules: word counts, repeats, and zstandard compression bands."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, map_texts, stored

#: (bytes up to, lowest ratio, highest ratio) of compressed to plain bytes. Short texts compress
#: badly whatever they hold, so the bands widen and rise towards them. These reject repeats and noise.
WIDE_WHOLE = (
    (64, 0.0, 9.0), (128, 0.50, 1.30), (256, 0.40, 1.10), (512, 0.38, 0.90), (1024, 0.32, 0.82),
    (4096, 0.26, 0.72), (None, 0.20, 0.68),
)
#: The same for one chunk, by the chunk's bytes.
WIDE_CHUNKS = ((512, 0.32, 0.92), (None, 0.28, 0.80))
#: Lower limits near the ratios of good texts: ``fitted`` over the labelled good rows of even id at
#: sf0.1. Classes with fewer than 20 such rows have the wide limit; for long texts the chunks decide.
WHOLE_BANDS = (
    (64, 0.0, 9.0), (128, 0.795, 1.30), (192, 0.40, 1.10), (256, 0.40, 1.10), (384, 0.587, 0.90), (512, 0.569, 0.90),
    (768, 0.526, 0.82), (1024, 0.493, 0.82), (1536, 0.475, 0.72), (2048, 0.463, 0.72), (3072, 0.45, 0.72),
    (4096, 0.436, 0.72), (6144, 0.422, 0.68), (8192, 0.412, 0.68), (12288, 0.409, 0.68), (16384, 0.20, 0.68),
    (None, 0.20, 0.68),
)
CHUNK_BANDS = ((512, 0.32, 0.92), (1023, 0.497, 0.80), (None, 0.49, 0.80))
SYMBOLS = str.maketrans("", "", "#*$%&|<>")
BLANKS = str.maketrans("", "", " \t\n\v\f\r")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; every number is a parameter of the operator."""

    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    level: int = 3
    chunk_bytes: int = 1024
    max_bad_chunk_share: float = 0.2
    whole_bands: Sequence[tuple[int | None, float, float]] = WHOLE_BANDS
    chunk_bands: Sequence[tuple[int | None, float, float]] = CHUNK_BANDS


#: What ``measure`` and ``accepted`` go by if no rules are given.
WIDE = Rules(whole_bands=WIDE_WHOLE, chunk_bands=WIDE_CHUNKS)


def repeat_words(words: list[bytes], window: int) -> int:
    """Words that lie in a window of ``window`` words found twice or more, the first one included.

    Equal windows get equal numbers by ranking pairs: two neighbours first, then the number so far
    with the next word. Nothing is hashed, so nothing collides.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    single = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    names = single[:n]
    for k in range(1, window):
        names = np.unique(names * len(ids) + single[k : k + n], return_inverse=True)[1]
    repeated = np.bincount(names)[names] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += repeated
    edges[window : window + n] -= repeated
    return int((np.cumsum(edges) > 0).sum())


def band(size: int | None, bands: Sequence[tuple[int | None, float, float]]) -> tuple[float, float]:
    """The limits for a number of bytes; None stands for more than any."""
    return next((lo, hi) for top, lo, hi in bands if top is None or (size is not None and size <= top))


def in_band(ratio: float, size: int, bands: Sequence[tuple[int | None, float, float]]) -> bool:
    low, high = band(size, bands)
    return low <= ratio <= high


class _Judge:
    """The rules over one batch after another; the compressor is made once per task."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.zstd = zstandard.ZstdCompressor(level=rules.level)

    def ratio(self, data: bytes) -> float:
        return len(self.zstd.compress(data)) / len(data)

    def chunks(self, data: bytes) -> list[bytes]:
        size = self.rules.chunk_bytes
        chunks = [data[i : i + size] for i in range(0, len(data), size)]
        return [c for c in chunks if 2 * len(c) >= size]

    def bands(self, data: bytes) -> tuple[float, float, bool]:
        """Ratio of the whole, share of chunks outside their band, and whether both are accepted.

        The last chunk counts when it has half a chunk's bytes, so that no short rest decides.
        """
        r = self.rules
        whole = self.ratio(data)
        chunks = self.chunks(data)
        bad = sum(not in_band(self.ratio(c), len(c), r.chunk_bands) for c in chunks)
        share = bad / len(chunks) if chunks else 0.0
        return whole, share, in_band(whole, len(data), r.whole_bands) and share <= r.max_bad_chunk_share

    def one(self, text: str | None) -> tuple:
        text = text or ""
        data = text.encode()
        words = data.split()
        full = [x for x in data.split(b"\n") if x.strip()]
        repeats = repeat_words(words, self.rules.window)
        failed = len(words) < self.rules.min_words or 100 * repeats > self.rules.max_repeat_percent * len(words)
        whole, share, fits = self.bands(data) if data else (None, 0.0, False)
        return (
            len(words), len(text.translate(BLANKS)), len(text) - len(text.translate(SYMBOLS)),
            len(full) - len(set(full)), repeats, failed, not failed and fits, whole, share,
        )

    def __call__(self, texts: list[str | None]) -> list[pa.Array]:
        rows = [self.one(t) for t in texts]
        return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(ARROW)]


ADDED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    + [T.StructField("zstd_ratio", T.DoubleType()), T.StructField("bad_chunk_share", T.DoubleType())]
)
ARROW = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2


def measure(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), rules: Rules = WIDE) -> DataFrame:
    """Every row's measures and verdict: the ``keep`` columns, then ``ADDED``.

    The wide bands reject repeats and noise only; ``Rules()`` has the fitted ones.
    A row is kept if the base rules pass and its compression ratios lie in the bands of its length:
    the whole text's, and those of its fixed chunks but for a share of ``max_bad_chunk_share``.
    Narrow and row by row: no shuffle, one text in memory at a time beside its batch.

    Null and empty texts have no word, so they fail the base rules; ``zstd_ratio`` is null there.
    Repeated rows are judged each alone; an empty table gives an empty one. A kept column named like
    an added one is dropped.
    """
    return map_texts(df, text, list(keep), ADDED, lambda: _Judge(rules))


def accepted(df: DataFrame, text: str = "text", rules: Rules = WIDE) -> DataFrame:
    """The rows that pass, with the columns they came with, whatever their names."""
    verdict = free(df, "__verdict")
    added = T.StructType([T.StructField(verdict, T.BooleanType())])

    def start():
        judge = _Judge(rules)
        return lambda texts: [pa.array([judge.one(t)[6] for t in texts], pa.bool_())]

    return map_texts(df, text, df.columns, added, start).where(F.col(verdict)).drop(verdict)


RATIOS = T.StructType([T.StructField("ratios", T.ArrayType(T.StructType([
    T.StructField("whole", T.BooleanType()), T.StructField("size", T.LongType()), T.StructField("ratio", T.DoubleType())])))])
WHOLE_TOPS = tuple(b[0] for b in WHOLE_BANDS)
CHUNK_TOPS = tuple(b[0] for b in CHUNK_BANDS)


def _ratios(df: DataFrame, text: str, keep: Sequence[str], rules: Rules, passing: Rules | None = None) -> DataFrame:
    """The ``keep`` columns and ``ratios``: that of the whole text, then those of its chunks; of the
    rows that ``passing`` accepts, if given. One pass in Python, so a task has one worker for it."""

    def start():
        judge, first = _Judge(rules), passing and _Judge(passing)

        def one(text: str | None) -> list[dict] | None:
            if first and not first.one(text)[6]:
                return None
            data = text.encode()
            parts = [(True, data), *((False, c) for c in judge.chunks(data))]
            return [{"whole": w, "size": len(x), "ratio": judge.ratio(x)} for w, x in parts]

        kind = pa.list_(pa.struct([("whole", pa.bool_()), ("size", pa.int64()), ("ratio", pa.float64())]))
        return lambda texts: [pa.array([one(t) for t in texts], kind)]

    return map_texts(df, text, list(keep), RATIOS, start).where("ratios is not null")


def _class(size: Column, tops: Sequence[int | None]) -> Column:
    """The upper end of a length class; null for the last one."""
    return F.least(*(F.when(size <= t, t) for t in tops if t is not None), F.lit(None).cast("long"))


def _lows(found: DataFrame, whole: Sequence[int | None], chunks: Sequence[int | None], tail: float, least: int,
          counted: Column | None = None) -> dict:
    """The ``tail`` quantile of each class with ``least`` ratios, or distinct values of ``counted``; the
    driver gets a row for a class."""
    parts = found.select(*([] if counted is None else [counted.alias("of")]), F.inline("ratios"))
    size = F.col("size")
    classes = parts.groupBy("whole", F.when(F.col("whole"), _class(size, whole)).otherwise(_class(size, chunks)).alias("top")).agg(
        F.count("*").alias("rows") if counted is None else F.count_distinct("of").alias("rows"),
        F.percentile("ratio", F.lit(tail)).alias("low"))
    return {(r.whole, r.top): r.low for r in classes.collect() if r.rows >= least}


def _with_lows(rules: Rules, lows: dict, margin: float, whole: Sequence[int | None], chunks: Sequence[int | None]) -> Rules:
    """``rules`` with lower limits ``margin`` below the given ones, where there are any."""

    def limits(is_whole: bool, tops, bands):
        return tuple((t, round(lows[is_whole, t] - margin, 3) if (is_whole, t) in lows else band(t, bands)[0], band(t, bands)[1]) for t in tops)

    return replace(rules, whole_bands=limits(True, whole, rules.whole_bands), chunk_bands=limits(False, chunks, rules.chunk_bands))


def fitted(good: DataFrame, text: str = "text", wide: Rules = WIDE, whole: Sequence[int | None] = WHOLE_TOPS,
           chunks: Sequence[int | None] = CHUNK_TOPS, max_rows: int = 20_000, least_rows: int = 20,
           tail: float = 0.001, margin: float = 0.015) -> Rules:
    """Rules whose lower limits follow from ``good`` texts, such as those labelled so.

    A length class starts ``margin`` below the ``tail`` quantile of its ratios; with fewer than
    ``least_rows`` of them it has the limits of ``wide``, from which all upper limits come too. Of
    the texts that pass the base rules the ``max_rows`` of least hash count; the driver gets one row
    for each class.
    """
    own = F.col(f"`{text}`")
    few = accepted(good.select(own), text, wide).orderBy(F.xxhash64(own), own).limit(max_rows)
    return _with_lows(wide, _lows(_ratios(few, text, [], wide), whole, chunks, tail, least_rows), margin, whole, chunks)


@dataclass(frozen=True)
class Learning:
    """How limits are learnt. ``max_labelled`` bounds the sample: the good ids of least hash.

    Of crc32 of the id as text modulo four, 2 is held out and never read, 3 sets the margin, and the
    others give the quantiles.
    """

    max_labelled: int = 8_000
    least_texts: int = 100
    tail: float = 0.001
    max_lost: float = 0.0
    folds: int = 4
    held_out: int = 2
    for_margin: int = 3


def _needed(lows: dict, rules: Rules) -> Column:
    """The margin below ``lows`` that a text needs to be kept, from its ``ratios``; parts of classes
    without a low need none."""

    def short(part: Column) -> Column:
        low = F.lit(None).cast("double")
        for whole, tops in ((True, WHOLE_TOPS), (False, CHUNK_TOPS)):
            known = F.lit(None).cast("double")
            for top in reversed(tops):  # the least class that fits comes first
                value = F.lit(lows.get((whole, top))).cast("double")
                known = value if top is None else F.when(part["size"] <= top, value).otherwise(known)
            low = F.when(part["whole"] == whole, known).otherwise(low)
        return F.coalesce(low - part["ratio"], F.lit(0.0))

    chunks = F.sort_array(F.transform(F.filter("ratios", lambda x: ~x["whole"]), short), asc=False)
    # this many may lie outside; the next one has to fit
    allowed = F.floor(F.size(chunks) * F.lit(rules.max_bad_chunk_share)).cast("int")
    return F.greatest(F.lit(0.0), short(F.col("ratios")[0]), F.coalesce(F.get(chunks, allowed), F.lit(0.0)))


def learnt(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
           rules: Rules = Rules(), learning: Learning = Learning()) -> Rules:
    """Rules whose lower limits, and the margin below them, follow from the texts labelled good (1).

    Limits are ``tail`` quantiles of the ratios of a length class over one part of the labelled ids.
    The margin is what another part needs so that no more than ``max_lost`` of its texts are rejected. A
    third part is held out. Classes that fewer than ``least_texts`` ids fill, and all upper limits, are those
    of ``rules``: so small a quantile of a few texts is chance, and chunks of one text are alike.

    At most ``max_labelled`` good ids, those of least hash, are learnt from: the choice depends on the
    ids alone, and their texts are all that is compressed. An id of which any label is not 1, and null ids, are passed over;
    rows that repeat an id count each; null, empty and other texts that fail the base rules do not count.
    Empty tables, or no good label, give ``rules``.
    """
    of, own = F.col(f"`{id}`"), F.col(f"`{label}`")
    fold = F.crc32(of.cast("string").cast("binary")) % learning.folds
    good = labels.where(of.isNotNull() & (fold != learning.held_out)).groupBy(of.alias("__of")).agg(
        F.min(F.coalesce(own == 1, F.lit(False))).alias("__good"))
    known = stored(  # small as files are, so Spark may broadcast it
        good.where("__good").orderBy(F.xxhash64("__of"), "__of").limit(learning.max_labelled).select("__of"), "labelled")
    texts = df.select(of.alias("__id"), F.col(f"`{text}`").alias("__text"), (fold == learning.for_margin).alias("__margin")).join(
        known, F.col("__id") == F.col("__of"), "left_semi")
    found = stored(_ratios(texts, "__text", ["__id", "__margin"], rules, WIDE), "ratios")
    lows = _lows(found.where("not __margin"), WHOLE_TOPS, CHUNK_TOPS, learning.tail, learning.least_texts, F.col("__id"))
    margin = found.where("__margin").agg(F.percentile(_needed(lows, rules), F.lit(1 - learning.max_lost))).first()[0] or 0.0
    return _with_lows(rules, lows, margin, WHOLE_TOPS, CHUNK_TOPS)
