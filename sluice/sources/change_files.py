"""Change files: CSV (usually gzip) with one header line, one file set per table and slice."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import parse_whole
from ..operators.filters import quoted
from ..session import settled

ARRIVAL = "arrival"


def schema_of(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def empty_frame(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """No rows of a schema; the optimizer knows that there are none."""
    fields = schema_of(schema).fields
    return spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def arrival() -> Column:
    """Place of a row among the files as they came: file time, file name, place in the file."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(ARRIVAL)


# how the files are written: doubled quotes, breaks inside quotes, empty for missing
CSV_OPTIONS = {
    "header": "true", "enforceSchema": "false", "multiLine": "true", "quote": '"', "escape": '"', "emptyValue": "",
    "nullValue": "",
}


def _reader(spark: SparkSession, splittable: bool = False) -> DataFrameReader:
    return spark.read.options(**{**CSV_OPTIONS, "multiLine": str(not splittable).lower()})


def _header(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Column names of the first file; reads one line."""
    try:
        return _reader(spark).csv(list(paths)).columns
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return []
        raise


def _typed(names: Sequence[str], kind: T.StructType) -> T.StructType:
    known = {f.name: f for f in kind.fields}
    fields = [known.get(n, T.StructField(n, T.StringType())) for n in names]
    return T.StructType([*fields, *([known[CORRUPT]] if CORRUPT in known else [])])


def read_changes(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, *,
                 with_arrival: bool = False, splittable: bool = False) -> DataFrame:
    """All rows of the files, with the columns and types of one fixed schema.

    Columns are found by the header, which all files of a set share: files may hold further columns
    and any column order, but a file whose header differs from the first one's is an error, never
    silently shifted columns (``read_mixed`` reads such sets). Schema columns the files lack are
    NULL. A file with a header only adds no rows; no files at all give an empty frame.

    One file is one task, since gzip cannot be split and a value may hold line breaks; the rows
    spread over the cluster at the first shuffle, so no extra repartition is made here. With
    ``splittable`` (plain files without breaks inside values) large files are read in parts.
    """
    kind = schema_of(schema)
    listed = [paths] if isinstance(paths, str) else list(paths)
    names = _header(spark, listed) if listed else []
    if not names:
        empty = empty_frame(spark, kind)
        return empty.withColumn(ARRIVAL, F.lit(None).cast("string")) if with_arrival else empty
    rows = _reader(spark, splittable).schema(_typed(names, kind)).csv(listed)
    found = {*names, CORRUPT}
    columns = [quoted(f.name) if f.name in found else F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields]
    return rows.select(*columns, *([arrival()] if with_arrival else []))


#: Holds a record whose fields do not fit the header.
CORRUPT = "_corrupt_record"


def read_texts(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, *,
               mixed: bool = True) -> DataFrame:
    """The columns of a schema as the texts that arrived, with ``arrival`` and ``CORRUPT``.

    For callers that must lose no row: ``checked`` casts the texts and tells what did not fit.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema_of(schema).fields])
    texts = texts.add(CORRUPT, T.StringType())
    return (read_mixed if mixed else read_changes)(spark, paths, texts, with_arrival=True)


def _cells(width: int) -> list[str]:
    return [f"_{i}" for i in range(width)]


def _heads(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header) of every file that has a line: the first line of the split that starts it."""
    return (
        spark.read.text(list(paths))
        .filter(F.col("_metadata.file_block_start") == 0)
        .select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
        .groupBy("path")
        .agg(F.min_by("value", "at").alias("header"))
    )


def read_mixed(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, *,
               with_arrival: bool = False) -> DataFrame:
    """Like ``read_changes`` for files of one table whose headers differ in order or extent.

    A first scan keeps one line per file: its path and header. Only the distinct headers reach the
    driver, which turns each into the places of the schema's columns. Then all files are read as
    records of cells, a join by path gives each record the places that hold for its file, and the
    columns are taken from there. However many files share a header, no list of them is made.

    Columns a file lacks are NULL, columns the schema does not know are left out. Where the schema has
    ``CORRUPT``, it gets the text of a record with more or fewer fields than its own file's header.
    """
    kind = schema_of(schema)
    listed = [paths] if isinstance(paths, str) else list(paths)
    heads = settled(_heads(spark, listed), "heads") if listed else None
    found = [r["header"] for r in heads.select("header").distinct().collect()] if listed else []
    if not found:
        empty = empty_frame(spark, kind)
        return empty.withColumn(ARRIVAL, F.lit(None).cast("string")) if with_arrival else empty
    names = [next(csv.reader([h], skipinitialspace=True)) for h in found]
    wanted = [f for f in kind.fields if f.name != CORRUPT]
    places = [(h, len(n), [n.index(f.name) if f.name in n else None for f in wanted]) for h, n in zip(found, names)]
    known = spark.createDataFrame(places, "header string, width int, places array<int>")
    of = settled(heads.join(known, "header").select(F.col("path").alias("_path"), "width", "places"), "places")
    width = max(len(n) for n in names)

    # every first line is passed over as a header; what it says does not bind the cells
    cells = T.StructType([T.StructField(c, T.StringType()) for c in _cells(width)]).add(CORRUPT, T.StringType())
    records = _reader(spark).option("enforceSchema", "true").option("columnNameOfCorruptRecord", CORRUPT).schema(cells).csv(listed)
    records = records.select(
        F.array(*_cells(width)).alias("cells"), F.col(CORRUPT).alias("raw"), F.col("_metadata.file_path").alias("_of"),
        *([arrival()] if with_arrival else []))
    rows = records.join(of, F.col("_of") == F.col("_path"))
    values = [_cast(F.get("cells", F.get("places", k)), f.dataType).alias(f.name) for k, f in enumerate(wanted)]
    by_name = dict(zip((f.name for f in wanted), values))
    if CORRUPT in kind.names:
        by_name[CORRUPT] = _unfit(F.col("raw"), F.col("cells"), F.col("width"), sorted({len(n) for n in names}), width).alias(CORRUPT)
    return rows.select(*[by_name[n] for n in kind.names], *([ARRIVAL] if with_arrival else []))


def _cast(text: Column, kind: T.DataType) -> Column:
    name = kind.simpleString()
    if name == "string":
        return text
    return parse_whole(text, name) if name in ("int", "bigint") else text.try_cast(name)


def _unfit(raw: Column, cells: Column, width: Column, widths: Sequence[int], most: int) -> Column:
    """The text of a record that has not as many fields as its file's header, else NULL.

    The reader marks the records that are not as wide as the widest header. Those of narrower files
    are held against their own width by parsing their text once more; one that is not marked fits
    the widest header and so has too many fields, and its text is put together from them.
    """
    unfit = F.when(width == most, raw)
    whole = F.to_csv(F.struct(*[F.get(cells, i).alias(c) for i, c in enumerate(_cells(most))]), {"escape": '"'})
    for w in widths:
        if w == most:
            continue
        schema = ", ".join(f"{c} string" for c in _cells(w)) + f", {CORRUPT} string"
        again = F.from_csv(raw, F.lit(schema), {**CSV_OPTIONS, "header": "false", "columnNameOfCorruptRecord": CORRUPT})
        unfit = F.when(width == w, F.when(raw.isNull(), whole).when(again[CORRUPT].isNotNull(), raw)).otherwise(unfit)
    return unfit


def write_changes(df: DataFrame, path: str) -> None:
    """Rows as gzip CSV change files."""
    df.write.option("header", True).option("compression", "gzip").option("escape", '"').option(
        "quoteAll", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)


def read_columns(spark: SparkSession, path: str, schema: str | T.StructType, columns: Sequence[str]) -> DataFrame:
    """Some columns of a flat CSV; the scan parses only those."""
    return read_changes(spark, path, schema).select(*[quoted(c) for c in columns])
