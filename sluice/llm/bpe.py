"""Byte-level BPE: encoding by a priority queue over a linked symbol list, and decoding."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, ready_for_python

#: Fixed value: how byte-level vocabularies of this kind cut a text before merging.
CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Entries of each of a task's caches of encoded pieces, and the longest piece that goes into one.
CACHE_PIECES, CACHE_CHARS = 400_000, 48
#: Ids have at most so many bits; a symbol that was merged into its left neighbour is out.
ID_BITS = 20
LAST_ID, OUT = (1 << ID_BITS) - 1, -1


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Ids, byte strings and merge ranks of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("only byte-level BPE without a normalizer or added first space")
        letters = byte_letters()
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if max(len(ids), *self.special.values()) > LAST_ID:
            raise ValueError("too many ids")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.strings = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.strings[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = ids[letter]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(ids[left] << ID_BITS | ids[right], rank << ID_BITS | ids[left + right])

    def merge(self, data: bytes) -> list[int]:
        """Ids of one cut piece.

        The queue holds the merges that can be made, as rank, merged id and place in one number, so
        that the least rank comes first and of equal ones the leftmost. Symbols form a doubly linked
        list; merging puts the new id at the left one's place and takes the right one out. An entry
        is stale, and skipped, if the symbols at its place no longer give its merge.
        """
        ids = [self.first[b] for b in data]
        n = len(ids)
        bits = n.bit_length()
        places = (1 << bits) - 1
        find = self.merges.get
        queue = [m << bits | i for i in range(n - 1) if (m := find(ids[i] << ID_BITS | ids[i + 1])) is not None]
        heapify(queue)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i = entry & places
            j = after[i]
            if j == n or find(ids[i] << ID_BITS | ids[j]) != entry >> bits:
                continue
            ids[i] = new = entry >> bits & LAST_ID
            ids[j] = OUT
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := find(new << ID_BITS | ids[k])) is not None:
                    heappush(queue, m << bits | i)
            h = before[i]
            if h >= 0 and (m := find(ids[h] << ID_BITS | new)) is not None:
                heappush(queue, m << bits | h)
        return [x for x in ids if x != OUT]

    def decode(self, ids: list[int]) -> str:
        """The text: vocabulary strings one after the other; bytes that are no UTF-8 become U+FFFD."""
        return b"".join([self.strings[i] for i in ids]).decode("utf-8", "replace")


class _Cache(dict):
    """What ``find`` gives for a short text, kept; emptied when full, so it stays bounded."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, text: str) -> bytes:
        found = self.find(text)
        if len(text) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[text] = found
        return found


class Encoder:
    """Whole texts to ids, as int32. Made once per Python worker, so that tasks share its caches."""

    def __init__(self, vocabulary: Vocabulary):
        cut = regex.compile(CUT)
        words = _Cache(lambda w: array("i", vocabulary.merge(w.encode())).tobytes())
        self.plain = lambda piece: b"".join([words[w] for w in cut.findall(piece)])
        self.spaced = _Cache(lambda piece: self.plain(" " + piece))
        tokens = sorted(vocabulary.special, key=len, reverse=True)
        self.special = vocabulary.special
        self.split = regex.compile("(" + "|".join(map(regex.escape, tokens)) + ")") if tokens else None
        self.gap = re.compile(r" (?:\s|\Z)")

    def part(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A cut always falls before a single space that no white space follows, so the text is taken
        apart there; runs of white space stay whole for the pattern.
        """
        pieces = text.split(" ")
        if self.gap.search(text):
            joined = [pieces[0]]
            for piece in pieces[1:]:
                if not piece or piece[0].isspace():
                    joined[-1] += " " + piece
                else:
                    joined.append(piece)
            pieces = joined
        spaced = self.spaced
        return self.plain(pieces[0]) + b"".join([spaced[p] for p in pieces[1:]])

    def __call__(self, text: str) -> np.ndarray:
        if self.split is None or not any(t in text for t in self.special):
            return np.frombuffer(self.part(text), np.int32)
        found = [array("i", [self.special[p]]).tobytes() if p in self.special else self.part(p)
                 for p in self.split.split(text) if p]
        return np.frombuffer(b"".join(found), np.int32)


@cache
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


@cache
def encoder_of(path: str) -> Encoder:
    return Encoder(vocabulary_of(path))


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    values = np.concatenate(found) if found else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """The ``keep`` columns (all others by default) and the text's token ids as ``array<int>``.

    The vocabulary is read from ``path``, which every machine must have, once in each Python worker. Special tokens
    written out in a text become their id. Row by row, no shuffle; a worker keeps a bounded cache.

    Null and empty texts give an empty array. Texts of any length are encoded whole. Repeated rows
    give repeated rows, an empty table an empty one. A kept column named ``ids`` is replaced.
    """

    def start():
        encoder = encoder_of(path)

        return lambda texts: [_lists([encoder(t or "") for t in texts])]

    keep = [c for c in df.columns if c != text] if keep is None else keep
    return map_texts(df, text, keep, T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType()))]), start)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` and the text its ids stand for. Null ids give null, an empty array the empty text."""
    ready_for_python(df.sparkSession)
    source = df.drop(text) if text.lower() in {c.lower() for c in df.columns} else df
    at = source.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for batch in batches:
            column = batch.column(at)
            values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
            texts = [vocabulary.decode(values[a:b].tolist()) if known else None
                     for a, b, known in zip(ends, ends[1:], column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(text, T.StringType())]))


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """The ``keep`` columns, the ids of ``encode`` and the text that ``decode`` makes of them, in one pass.

    For where both are asked for: the ids do not go back to Spark and to Python again in between. Nulls,
    long texts, repeated rows and clashing names are as for ``encode``; a null text decodes to an empty one.
    """

    def start():
        encoder, vocabulary = encoder_of(path), vocabulary_of(path)

        def work(texts: list[str | None]) -> list[pa.Array]:
            found = [encoder(t or "") for t in texts]
            return [_lists(found), pa.array([vocabulary.decode(x.tolist()) for x in found], pa.string())]

        return work

    keep = [c for c in df.columns if c != text] if keep is None else keep
    added = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])
    return map_texts(df, text, keep, added, start)


def digests(ids: str = "ids", text: str = "decoded") -> list:
    """Count of ids, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text."""
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(text).cast("binary"), 256).alias("decoded_sha256"),
    ]
