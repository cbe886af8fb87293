"""Target tables: Parquet folders per partition, and one pointer to the current ones.

    <path>/data/version=<v>/table_bucket=<b>/*.parquet    rows with a key
    <path>/loose/version=<v>/*.parquet                    rows without one
    <path>/state/slot=<0 or 1>/                           one line: the folders that hold the table

An upsert stages its batch in the shared folder, writes the buckets it falls into beside the old ones,
and then switches by writing the pointer over the last but one (the first batch of a table, if it has
to have keys, is written in place, not staged): readers see the old state until then,
and a job that dies before leaves nothing visible. The pointer names a folder for each bucket, and one
for each batch that brought rows without a key since the last reload: every folder that is read is one
that it names. Nothing is deleted here; ``superseded`` tells the owner of the storage what may go.

One writer per table at a time. Where the cluster has a lakehouse format with MERGE, use that
instead; the operators in ``operators.merge`` do not depend on this module.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import quoted
from ..operators.merge import APART, apart, keyed, last_row, merge_last, unkeyed
from ..schemas import TARGETS
from ..session import settled
from .change_files import empty_frame, schema_of

BUCKET = "table_bucket"
#: Codec of the tables and their staged batches: long texts take about half the bytes of Spark's default.
CODEC = "zstd"
_STATE = ("version int, layout string, loose array<int>, buckets array<struct<bucket: bigint, held: int>>, "
          "sources array<struct<source: string, number: bigint>>")


@dataclass(frozen=True)
class Layout:
    """How a row's bucket follows from its key; recorded with the table, which refuses another."""

    kind: str
    size: int

    def bucket(self, *keys: Column) -> Column:
        if self.kind == "hash":
            return F.pmod(F.xxhash64(*keys), F.lit(self.size)).cast("bigint")
        return F.floor(keys[0] / F.lit(self.size)).cast("bigint")


def hash_buckets(count: int) -> Layout:
    """Rows spread evenly by key. Choose the count so that a bucket is some gigabytes."""
    return Layout("hash", count)


def id_ranges(width: int) -> Layout:
    """Ranges of a growing number as first key: changes to young rows then touch few buckets."""
    return Layout("range", width)


@dataclass
class _State:
    version: int = 0
    loose: list[int] = field(default_factory=list)  # versions whose folders hold the rows without a key
    held: dict[int, int] = field(default_factory=dict)  # bucket to the version that holds its rows
    sources: dict[str, int] = field(default_factory=dict)  # the last batch merged from each source


class Table:
    """A target table with one key (possibly of several columns, possibly none).

    ``layout`` is fixed when the table is first written. A batch rewrites the buckets it falls into
    and no others, so choose one by which batches fall together.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: Sequence[str] = (), *,
                 buckets: int = 16, layout: Layout | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema_of(schema)
        self.keys = list(keys)
        self.layout = layout or hash_buckets(buckets)

    @classmethod
    def target(cls, spark: SparkSession, base: str, name: str, **options) -> Table:
        """One of the catalogued target tables, below ``base``."""
        keys, schema = TARGETS[name]
        return cls(spark, f"{base.rstrip('/')}/{name}", schema, keys, **options)

    # -- state ---------------------------------------------------------------------------------

    def _described(self) -> str:
        return f"{self.layout.kind}({self.layout.size}) of {', '.join(self.keys)}" if self.keys else "no key"

    def _state(self) -> _State:
        """The newest pointer: one line, whose lists follow buckets and sources."""
        try:
            line = self.spark.read.schema(_STATE).json(f"{self.path}/state").orderBy(F.desc("version")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            line = None
        if line is None:
            return _State()
        if line["layout"] != self._described():
            raise ValueError(f"{self.path} is laid out by {line['layout']}, not by {self._described()}")
        return _State(line["version"], list(line["loose"] or ()), {x["bucket"]: x["held"] for x in line["buckets"] or ()},
                      {x["source"]: x["number"] for x in line["sources"] or ()})

    def _switch(self, state: _State) -> None:
        """Make a written version the current one. It takes the place of the last but one, so that the
        current pointer is there until the new one is."""
        buckets = [(b, v) for b, v in sorted(state.held.items())]
        sources = sorted(state.sources.items())
        line = self.spark.createDataFrame(
            [(state.version, self._described(), state.loose, buckets, sources)], _STATE)
        line.coalesce(1).write.mode("overwrite").json(f"{self.path}/state/slot={state.version % 2}")

    # -- reading -------------------------------------------------------------------------------

    def _buckets_of(self, held: dict[int, int]) -> DataFrame:
        """The given buckets, each from the folder that holds it."""
        root = f"{self.path}/data"
        paths = [f"{root}/version={v}/{BUCKET}={b}" for b, v in sorted(held.items())]
        if not paths:
            return empty_frame(self.spark, self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", root).parquet(*paths)
        return rows.select(*[quoted(c) for c in self.schema.names])

    def _loose_of(self, versions: Sequence[int]) -> DataFrame:
        """Rows without a key, from the folders that the pointer names."""
        paths = [f"{self.path}/loose/version={v}" for v in versions]
        if not paths:
            return empty_frame(self.spark, self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/loose").parquet(*paths)
        return rows.select(*[quoted(c) for c in self.schema.names])

    def read(self) -> DataFrame:
        """The current content, as plain Parquet scans."""
        state = self._state()
        if not self.keys:
            return self._loose_of(state.loose)
        rows = self._buckets_of(state.held)
        return rows.unionByName(self._loose_of(state.loose)) if state.loose else rows

    # -- writing -------------------------------------------------------------------------------

    def _write_buckets(self, rows: DataFrame, version: int) -> None:
        # rebalance: one shuffle that adaptive execution joins (small buckets) or splits (big ones)
        placed = rows.withColumn(BUCKET, self.layout.bucket(*[quoted(k) for k in self.keys]))
        placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(
            f"{self.path}/data/version={version}", compression=CODEC)

    def _write_loose(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/loose/version={version}", compression=CODEC)

    def _write_first(self, rows: DataFrame, version: int) -> list[int]:
        """The first rows with a key, moved and written once; their buckets."""
        self._write_buckets(rows, version)
        kind = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.LongType())])
        written = self.spark.read.schema(kind).parquet(f"{self.path}/data/version={version}")
        return sorted(r[0] for r in written.select(BUCKET).distinct().collect())

    def _touched(self, rows: DataFrame) -> list[int]:
        """Buckets that rows fall into; as many as the layout has at most."""
        found = rows.select(self.layout.bucket(*[quoted(k) for k in self.keys]).alias(BUCKET)).distinct().collect()
        return sorted(r[0] for r in found)

    def _aligned(self, rows: DataFrame, partial: bool = False, extra: Sequence[str] = ()) -> DataFrame:
        names = [c for c in self.schema.names if c in rows.columns or not partial]
        return rows.select(*[
            (quoted(c) if c in rows.columns else F.lit(None)).cast(self.schema[c].dataType).alias(c) for c in names
        ], *[quoted(c) for c in extra])

    def upsert(self, changes: DataFrame, order: Sequence[str] = (), *, batch: tuple[str, int] | None = None,
               null_keys: str = "insert", newest: bool = False) -> bool:
        """Merge a batch; see ``operators.upsert``.

        ``batch`` names the source of the batch and its number there. Numbers of a source rise; one
        that is not above the last merged is a replay, nothing happens and the result is False.
        ``order`` columns need not be columns of the table, except with ``newest``.
        """
        if null_keys not in ("insert", "reject"):
            raise ValueError(f"null_keys must be 'insert' or 'reject', not {null_keys!r}")
        if not self.keys:
            raise ValueError("a table without a key has nothing to match; use append or reload")
        state = self._state()
        if batch and batch[1] <= state.sources.get(batch[0], -1):
            return False
        version = state.version + 1
        partial = any(c not in changes.columns for c in self.schema.names)
        if newest and (partial or any(c not in self.schema.names for c in order)):
            raise ValueError("newest needs changes with all columns of the table, and its order among them")

        # The batch is evaluated once, reduced to one row per key, and staged: a retried merge reads
        # the same rows, and the planner knows their size. Where all rows have a key and there is nothing
        # to merge them with, they are written in place at once.
        wanted = keyed(changes, self.keys) if null_keys == "reject" else changes
        last = self._aligned(last_row(apart(wanted, self.keys), [*self.keys, APART], order), partial, [APART])
        has_loose = False
        if null_keys == "reject" and not state.held:
            base = self._buckets_of({})
            buckets = self._write_first(merge_last(apart(base, self.keys), last, self.keys, order, newest=newest), version)
        else:
            staged = settled(last, "staged", CODEC)
            with_key = keyed(staged, self.keys)
            buckets = self._touched(with_key)
            if buckets:
                base = self._buckets_of({b: state.held[b] for b in buckets if b in state.held})
                self._write_buckets(merge_last(apart(base, self.keys), with_key, self.keys, order, newest=newest), version)
            without = unkeyed(staged, self.keys)
            has_loose = null_keys == "insert" and not without.isEmpty()
            if has_loose:
                self._write_loose(self._aligned(without), version)
        self._switch(_State(
            version, state.loose + [version] * has_loose, state.held | dict.fromkeys(buckets, version),
            state.sources | ({batch[0]: batch[1]} if batch else {})))
        return True

    def reload(self, rows: DataFrame) -> None:
        """Replace the whole content at once; readers never see an empty table in between."""
        state = self._state()
        version = state.version + 1
        if not self.keys:
            self._write_loose(self._aligned(rows), version)
            self._switch(_State(version, [version], {}, state.sources))
            return
        staged = settled(self._aligned(rows), "staged", CODEC)
        with_key, without = keyed(staged, self.keys), unkeyed(staged, self.keys)
        buckets = self._touched(with_key)
        if buckets:
            self._write_buckets(with_key, version)
        has_loose = not without.isEmpty()
        if has_loose:
            self._write_loose(without, version)
        self._switch(_State(version, [version] * has_loose, dict.fromkeys(buckets, version), state.sources))

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """Add rows to a table without a key, as one more folder that the pointer names; nothing is
        rewritten. False when ``batch`` is a replay, as for ``upsert``."""
        if self.keys:
            raise ValueError("append is for tables without a key; use upsert")
        state = self._state()
        if batch and batch[1] <= state.sources.get(batch[0], -1):
            return False
        version = state.version + 1
        self._write_loose(self._aligned(rows), version)
        self._switch(_State(version, [*state.loose, version], {}, state.sources | ({batch[0]: batch[1]} if batch else {})))
        return True

    def superseded(self) -> DataFrame:
        """(folder, files, bytes) of the folders below the table that the current pointer does not name.

        Whoever owns the storage may remove them once no job reads an older state. Files are listed,
        not read.
        """
        state = self._state()
        if not state.version:
            return empty_frame(self.spark, "folder string, files bigint, bytes bigint")
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*.parquet").load(self.path).select("path", "length")
        folder = F.regexp_extract("path", rf"/((?:data/version=\d+/{BUCKET}=-?\d+|loose/version=\d+))/[^/]+$", 1)
        found = files.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        named = [f"data/version={v}/{BUCKET}={b}" for b, v in state.held.items()] + [f"loose/version={v}" for v in state.loose]
        return found.join(self.spark.createDataFrame([(n,) for n in named], "folder string"), "folder", "left_anti")
