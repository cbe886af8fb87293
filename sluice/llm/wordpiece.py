"""Token counts by a linear longest-match automaton over a word-piece vocabulary."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import Vocabulary
from .common import map_texts

CACHE_WORDS, CACHE_BYTES = 200_000, 48


class Automaton:
    """Trie of the pieces with failure links and the number of tokens each link pops.

    Pieces are byte strings: ``starts`` begin a word, ``parts`` continue one. Node 0 is the root of
    the starts, node 1 that of the parts. At a node with no edge for the next byte, the longest
    pieces that the path so far decides are popped (only their number is kept) and matching goes on
    at the failure link, which spells what is left. Each byte is passed once, each pop shortens the
    path, so a word takes time in proportion to its length whatever the vocabulary.
    """

    def __init__(self, starts: Iterable[bytes], parts: Iterable[bytes]):
        self.edges: dict[int, int] = {}
        self.ends = [False, False]
        order: list[tuple[int, int, int]] = []
        for root, pieces in ((0, starts), (1, parts)):
            for piece in pieces:
                node = root
                for byte in piece:
                    step = node << 8 | byte
                    if step not in self.edges:
                        self.edges[step] = len(self.ends)
                        order.append((node, byte, len(self.ends)))
                        self.ends.append(False)
                    node = self.edges[step]
                if piece:
                    self.ends[node] = True
        depth = [0] * len(self.ends)
        for parent, _, node in order:
            depth[node] = depth[parent] + 1
        self.link: list[int] = [-1] * len(self.ends)
        self.popped = [0] * len(self.ends)
        for parent, byte, node in sorted(order, key=lambda x: depth[x[2]]):
            if self.ends[node]:
                self.link[node], self.popped[node] = 1, 1
                continue
            at, popped = self.link[parent], self.popped[parent]
            while at >= 0 and at << 8 | byte not in self.edges:
                popped += self.popped[at]
                at = self.link[at]
            if at >= 0:
                self.link[node], self.popped[node] = self.edges[at << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """Number of greedy longest pieces; 0 if the vocabulary cannot spell the word."""
        edges, link, popped = self.edges, self.link, self.popped
        node = tokens = 0
        for byte in word:
            while (after := edges.get(node << 8 | byte, -1)) < 0:
                if link[node] < 0:
                    return 0
                tokens += popped[node]
                node = link[node]
            node = after
        while node != 1:
            if link[node] < 0:
                return 0
            tokens += popped[node]
            node = link[node]
        return tokens


def pieces_of(path: str) -> tuple[list[bytes], list[bytes]]:
    """Word pieces of a byte-level vocabulary file: its strings that begin with a space start a word
    (without the space), the others continue one. Strings with white space inside cannot occur."""
    strings = Vocabulary(path).strings
    starts = [s[1:] for s in strings if s[:1] == b" " and s[1:].split() == [s[1:]]]
    return starts, [s for s in strings if s.split() == [s]]


class _Counts(dict):
    """Tokens by word, bounded: emptied when full, long words are not kept."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        tokens = self.automaton.count(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = tokens
        return tokens


ADDED = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_unknown", "n_tokens")])


@cache
def counts_of(path: str) -> _Counts:
    """Made once per Python worker, so that tasks share automaton and cache."""
    return _Counts(Automaton(*pieces_of(path)))


def token_counts(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all but the text by default), words, unknown words and tokens of each text.

    A word that the vocabulary cannot spell counts as one unknown token. Row by row, no shuffle.
    Null and empty texts have 0 of each; texts of any length count whole; repeated rows count each.
    A kept column named like an added one is dropped; an empty table gives an empty one.
    """

    def start():
        counts = counts_of(path)

        def work(texts: list[str | None]) -> list[pa.Array]:
            rows = []
            for t in texts:
                found = [counts[w] for w in (t or "").encode().split()]
                unknown = found.count(0)
                rows.append((len(found), unknown, sum(found) + unknown))
            return [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]

        return work

    return map_texts(df, text, [c for c in df.columns if c != text] if keep is None else keep, ADDED, start)
