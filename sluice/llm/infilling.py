"""Fill-in-middle transformation by displacement scatter, and its inverse by gather."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready_for_python

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of each of them
#: Bytes moved at once, and bytes of texts that are worked on together (a longer text stands alone).
BLOCK, SLICE = 1 << 18, 1 << 22

ADDED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])


def draws(id: Column, seed: int, count: int = 4) -> list[Column]:
    """The first 8-digit groups of the hex SHA-256 of ``seed:id``, as numbers; a null id is empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(count)]


def leads(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 begin a code point."""
    return (data & 0xC0) != 0x80


def unit_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Which bytes begin a unit: a run of ASCII letters, or any other code point. Texts begin at ``begins``."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    starts = leads(data) & ~letter
    starts[1:] |= letter[1:] & ~letter[:-1]
    starts[begins[begins < len(data)]] = True
    return starts


def nth(flags: np.ndarray, j: int) -> int:
    """Place of the ``j``-th set flag from 0; the length if there are only ``j``."""
    for start in range(0, len(flags), BLOCK):
        found = np.flatnonzero(flags[start : start + BLOCK])
        if j < len(found):
            return start + int(found[j])
        j -= len(found)
    return len(flags)


def displaced(edges: np.ndarray, shifts: np.ndarray, total: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Where each of ``total`` bytes lies on the other side, block by block.

    From ``edges[k]`` on bytes are shifted by ``shifts[k]``; edges rise, and of equal ones the last counts.
    The steps between shifts fill a difference array, whose cumulative sum is every byte's own shift.
    """
    steps = np.diff(shifts, prepend=0)
    carry = 0
    for start in range(0, total, BLOCK):
        stop = min(start + BLOCK, total)
        low, high = np.searchsorted(edges, [start, stop])
        shift = np.zeros(stop - start, np.int64)
        np.add.at(shift, edges[low:high] - start, steps[low:high])
        shift[0] += carry
        np.cumsum(shift, out=shift)
        carry = int(shift[-1])
        shift += np.arange(start, stop)
        yield slice(start, stop), shift


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, null as empty, and where its texts begin and end."""
    whole = pc.fill_null(column, "").cast(pa.large_string())
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    body = whole.buffers()[2]
    data = np.frombuffer(body, np.uint8)[ends[0] : ends[-1]] if body is not None and ends[-1] > ends[0] else np.empty(0, np.uint8)
    return data, ends - ends[0]


def texts(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have ``SLICE`` bytes at most, or that are one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for k, size in enumerate(sizes):
        if k > start and held + size > SLICE:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += int(size)
    if start < len(sizes):
        yield batch.slice(start)


def scatter(data: np.ndarray, ends: np.ndarray, drawn: np.ndarray, plain_percent: int, spm_percent: int) -> list[pa.Array]:
    """Columns of ``ADDED`` for the texts in ``data``; ``drawn`` has four numbers for each."""
    count = len(ends) - 1
    lead, starts = leads(data), unit_starts(data, ends[:-1])
    units, forms, heads, middles = np.zeros(count, np.int64), [], [], []
    first, second = ends[:-1].copy(), ends[:-1].copy()  # the cuts, as places in the batch
    for k in range(count):
        a, b = int(ends[k]), int(ends[k + 1])
        own = starts[a:b]
        units[k] = np.count_nonzero(own)
        body = data[a:b].tobytes()
        if not body or any(m in body for m in (PREFIX, SUFFIX, MIDDLE)) or drawn[2, k] % 100 >= 100 - plain_percent:
            forms.append("plain")
            heads.append(None)
            middles.append(None)
            continue
        forms.append("spm" if drawn[3, k] % 100 < spm_percent else "psm")
        cuts = sorted(int(drawn[j, k]) % (int(units[k]) + 1) for j in (0, 1))
        first[k], second[k] = (a + nth(own, j) for j in cuts)
        heads.append(int(np.count_nonzero(lead[a : first[k]])))
        middles.append(int(np.count_nonzero(lead[first[k] : second[k]])))
    form = np.array(forms, dtype=object)
    cut, spm = form != "plain", form == "spm"
    head, tail = first - ends[:-1], ends[1:] - second
    out_ends = np.concatenate([[0], np.cumsum(np.diff(ends) + 3 * MARK * cut)])
    base = out_ends[:-1] - ends[:-1]
    # shifts of prefix, middle and suffix; a plain text is all suffix
    to_prefix = np.where(spm, 2 * MARK + tail, MARK)
    to_middle = 3 * MARK + tail
    to_suffix = np.where(spm, MARK - (second - ends[:-1]), 2 * MARK - (second - first))
    shifts = np.stack([base + cut * to_prefix, base + cut * to_middle, base + cut * to_suffix], axis=1).ravel()
    edges = np.stack([ends[:-1], first, second], axis=1).ravel()
    out = np.empty(int(out_ends[-1]), np.uint8)
    for part, to in displaced(edges, shifts, len(data)):
        out[to] = data[part]
    at = out_ends[:-1]
    for mark, where in (
            (PREFIX, np.where(spm, at + MARK + tail, at)), (SUFFIX, np.where(spm, at, at + MARK + head)),
            (MIDDLE, at + 2 * MARK + head + tail)):
        out[where[cut][:, None] + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    return [pa.array(units), pa.array(forms, pa.string()), pa.array(heads, pa.int64()), pa.array(middles, pa.int64()),
            texts(out, out_ends)]


def gather(data: np.ndarray, ends: np.ndarray, forms: Sequence[str]) -> pa.Array:
    """The plain texts behind outputs, from the outputs and their forms alone."""
    edges, origins, lengths = [], [], []
    for k, form in enumerate(forms):
        a, b = int(ends[k]), int(ends[k + 1])
        pieces = [(a, b)]
        if form != "plain":
            body = data[a:b].tobytes()
            one, two = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
            i, j = body.find(two), body.find(MIDDLE)
            if form not in ("psm", "spm") or not body.startswith(one) or not MARK <= i <= j - MARK:
                raise ValueError(f"not an output of form {form!r}")
            front, back, middle = (a + MARK, a + i), (a + i + MARK, a + j), (a + j + MARK, b)
            pieces = [back, middle, front] if form == "spm" else [front, middle, back]
        for low, high in pieces:
            edges.append(high - low)
            origins.append(low)
        lengths.append(sum(high - low for low, high in pieces))
    begins = np.cumsum([0, *edges])[:-1] if edges else np.empty(0, np.int64)
    out_ends = np.cumsum([0, *lengths])
    out = np.empty(int(out_ends[-1]), np.uint8)
    for part, origin in displaced(begins, np.array(origins, np.int64) - begins, len(out)):
        out[part] = data[origin]
    return texts(out, out_ends)


def _kept(df: DataFrame, keep: Sequence[str], added: T.StructType) -> list[str]:
    new = {f.name.lower() for f in added.fields}
    return [c for c in keep if c.lower() not in new]


def fill_in_middle(df: DataFrame, id: str = "doc_id", text: str = "text", keep: Sequence[str] = ("doc_id",), seed: int = 1,
                   plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """The ``keep`` columns, then ``ADDED``: each text cut in three and put together for infilling.

    Units are runs of ASCII letters and single other code points, ``n`` their number. Two cuts, drawn
    from a digest of the id, part prefix, middle and suffix. ``output`` is ``<P>prefix<S>suffix<M>middle``
    (form ``psm``), ``<S>suffix<P>prefix<M>middle`` (``spm``, ``spm_percent`` of a hundred) or the text as it is
    (``plain``: ``plain_percent`` of a hundred, empty texts, and texts that hold one of the marks).

    A batch of texts is one array of bytes. The cuts give a difference array of shifts, whose cumulative
    sum says for each byte how far it moves; one scatter writes all outputs. Nothing is shuffled; texts
    of any length are whole, and beside a text and its output only a block of shifts is held.

    Null texts are empty. A null id draws from the digest of an empty one. Rows that repeat id and text
    get equal outputs. A kept column named like an added one is dropped. An empty table gives an empty one.
    """
    ready_for_python(df.sparkSession)
    kept = _kept(df, keep, ADDED)
    source = df.select(
        *(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("__text"),
        *(d.alias(f"__h{k}") for k, d in enumerate(draws(F.col(f"`{id}`"), seed))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, len(kept)):
                data, ends = packed(part.column(len(kept)))
                drawn = np.stack([part.column(len(kept) + 1 + k).to_numpy(zero_copy_only=False) for k in range(4)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(kept))] + scatter(data, ends, drawn, plain_percent, spm_percent),
                    names=[*kept, *ADDED.names])

    return source.mapInArrow(run, T.StructType([*(source.schema[c] for c in kept), *ADDED.fields]))


def restore(df: DataFrame, output: str = "output", form: str = "form", keep: Sequence[str] = ("doc_id",),
            name: str = "restored") -> DataFrame:
    """The ``keep`` columns and the text that each output was made of, found from output and form alone.

    The marks in an output say where its three parts lie; difference arrays of the parts' distances give
    every byte of the text its place in the output, and one gather fetches them. A null output gives
    null; a null form counts as ``plain``; an output that its form cannot have made is an error.
    """
    ready_for_python(df.sparkSession)
    added = T.StructType([T.StructField(name, T.StringType())])
    kept = _kept(df, keep, added)
    source = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{output}`").alias("__output"),
                       F.when(F.col(f"`{output}`").isNull(), "plain").otherwise(F.coalesce(F.col(f"`{form}`"), F.lit("plain"))).alias("__form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, len(kept)):
                column = part.column(len(kept))
                data, ends = packed(column)
                back = gather(data, ends, part.column(len(kept) + 1).to_pylist())
                back = pc.if_else(column.is_valid(), back, pa.scalar(None, pa.string())) if column.null_count else back
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))] + [back], names=[*kept, name])

    return source.mapInArrow(run, T.StructType([*(source.schema[c] for c in kept), *added.fields]))
