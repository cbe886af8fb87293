"""Substring and line dedup against plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import lines, substrings


def plain_substrings(rows, window):
    """(id, words, removed, kept digest) of each row, by the definition."""
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in cut:
        for k in range(len(words) - window + 1):
            if i is not None:
                w = tuple(words[k : k + window])
                least[w] = min(i, least.get(w, i))
    out = []
    for i, words in cut:
        gone = set()
        for k in range(len(words) - window + 1):
            first = least.get(tuple(words[k : k + window]))
            if first is not None and (i is None or first < i):
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def corpus(seed, window):
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    passages = [text(window), text(window + 1), text(3 * window)]
    rows = []
    for i in range(150):
        body = text(rng.randrange(4 * window))
        if rng.random() < 0.5:
            at = rng.randrange(len(body) + 1)
            body[at:at] = rng.choice(passages)
        rows.append((i, " ".join(body) if rng.random() < 0.9 else "\n".join(body)))
    rows += [(200 + i, rows[i % 7][1].replace("\n", " ")) for i in range(60)]
    near = rows[11][1].split() + text(2 * window)
    for i in range(30):
        words = list(near)
        words[rng.randrange(len(words))] = "new"
        rows.append((300 + i, " ".join(words)))
    rows += [(400, None), (401, ""), (402, "a " * (5 * window)), (403, "a " * (5 * window + 3)), (None, rows[1][1]),
             (None, " ".join(text(2 * window))), (5, " ".join(passages[2])), (5, " ".join(passages[2])), (404, "x\x1cy é " * window)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [50, 8])
def test_substrings_equal_definition(spark, window):
    rows = corpus(window, window)
    df = spark.createDataFrame([(*r, "clash", "x") for r in rows], "doc_id long, text string, n_words string, whole string").repartition(4)
    got = substrings.deduplicated(df, window=window)
    assert Counter(tuple(r)[:4] for r in got.collect()) == plain_substrings(rows, window)
    for r in got.where("kept_text is not null").collect():
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
    assert substrings.deduplicated(df.limit(0)).count() == 0


def test_substrings_of_very_long_texts(spark):
    """Passages within texts longer than a block of windows, across its border too."""
    rng = random.Random(2)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    one, two = text(70_000), text(66_000)
    two[65_500:65_500] = one[65_520:65_600]
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(text(30) + one[:51] + text(5))), (4, " ".join(one[-49:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert Counter(tuple(r)[:4] for r in substrings.deduplicated(df).collect()) == plain_substrings(rows, 50)


def test_saturated_sketch_loses_nothing(spark, monkeypatch):
    """With far too few cells everything is estimated repeated; exact grouping still decides."""
    monkeypatch.setattr(substrings, "CELLS_PER_GRAM", 0)
    rows = corpus(3, 20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r)[:4] for r in substrings.deduplicated(df, window=20).collect()) == plain_substrings(rows, 20)


def gram_docs(spark, n):
    """n single grams, and a tenth as many that occur in two or more rows."""
    rng = np.random.default_rng(n)
    single = rng.integers(-(1 << 63), 1 << 63, n)
    twice = rng.integers(-(1 << 63), 1 << 63, n // 10)
    rows = [(k, [int(g) for g in part], list(range(len(part)))) for k, part in enumerate(np.array_split(single, 40))]
    rows += [(100 + k, [int(g) for g in twice], list(range(len(twice)))) for k in range(3)]
    return spark.createDataFrame(rows, "doc long, grams array<long>, spots array<int>").repartition(5), set(twice.tolist())


def test_the_sketch_grows_with_the_grams(spark, monkeypatch):
    """The share of single grams that pass stays the same at five times the size, at any cells a gram, in any shards."""
    shares = {}
    for per_gram in (8, 1):
        for n in (4000, 20000):
            docs, twice = gram_docs(spark, n)
            width = 1 << (per_gram * 13 * n // 10).bit_length()
            per = width / n
            for shard in (1 << 22, 1 << 10):
                monkeypatch.setattr(substrings, "SHARD_CELLS", shard)
                monkeypatch.setattr(substrings, "FLUSH", 1000)
                found = {r.gram for r in substrings.estimated_repeats(docs, width).collect()}
                assert twice <= found  # nothing that repeats is lost
                share = len(found - twice) / n
                assert shares.setdefault((per_gram, n), share) == share
            # both cells of a single gram are shared with probability (1 - exp(-load))^2
            load = 1.1 * n / width
            assert share < 1.6 * (1 - np.exp(-load)) ** 2 + 0.002, (per, share)


def test_cells_are_the_same_in_numpy_and_in_spark(spark):
    x = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 500)
    df = spark.createDataFrame([(int(v),) for v in x], "g long")
    for width in (1 << 12, 1 << 40):
        for row, cells in enumerate(substrings.cells_of(x.view(np.uint64), width)):
            got = [r.c for r in df.select(substrings.cell_of(F.col("g"), row, width).alias("c")).collect()]
            assert got == cells.tolist()


def test_rolling_hash_is_of_the_words_alone(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    y = np.concatenate([x[100:], x])
    a, b = substrings.rolling(x, 50, 0), substrings.rolling(y, 50, 0)
    assert (a[100:] == b[: len(a) - 100]).all() and len(np.unique(a)) == len(a)
    monkeypatch.setattr(substrings, "BLOCK", 64)
    assert (substrings.rolling(x, 50, 0) == a).all()


def plain_lines(rows, m, least_words=50):
    """Every run of any length, from every line on, looked up among those that start earlier."""
    keyed = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    bodies, wholes, out = {}, set(), {}
    seen = set()
    for i, t in keyed:
        body = t.split("\n")
        worded = [k for k, x in enumerate(body) if x.encode().split()]
        bodies[i, t] = body, worded
        texts = [body[k] for k in worded]
        sizes = [len(x.encode().split()) for x in texts]
        gone = set()
        for k in range(len(texts)):
            words = 0
            for length in range(1, len(texts) - k + 1):
                words += sizes[k + length - 1]
                if length < m and words < least_words:
                    continue
                run = tuple(texts[k : k + length])
                if run in seen:
                    gone.update(worded[k : k + length])
                else:
                    break  # a longer run is not there either
            for length in range(1, min(len(texts) - k, m + 60) + 1):
                seen.add(tuple(texts[k : k + length]))
        if texts and tuple(texts) in wholes:
            gone.update(worded)
        wholes.add(tuple(texts))
        out[i, t] = ("\n".join(x for k, x in enumerate(body) if k not in gone), len(worded), len(gone))
    return out


@pytest.mark.parametrize("m", [3, 1, 2, 5])
def test_lines_equal_definition(spark, m):
    rng = random.Random(m)
    line = lambda: " ".join(rng.choices("abcdefgh", k=rng.randrange(1, 4)))
    block = [line() for _ in range(9)]
    rows = []
    for i in range(120):
        body = [rng.choice(["the very common line", line(), line(), " "]) for _ in range(rng.randrange(12))]
        if rng.random() < 0.4:
            at, k = rng.randrange(len(body) + 1), rng.randrange(5)
            body[at:at] = block[k : k + 5]
        rows.append((i, "\n".join(body)))
    rows += [(200 + i, rows[i % 5][1]) for i in range(25)]
    rows += [(300, None), (301, ""), (302, "\n\n\n\n"), (303, "same\n" * 30), (7, rows[7][1]), (304, "no end"), (305, "cr\r\ncr\r\nx\r\n")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, gone string, n_lines int").repartition(3)
    expected = plain_lines(rows, m)
    got = lines.deduplicated(df, min_lines=m)
    assert got.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((i, None if t is None else expected[i, t][0]) for i, t in rows)
    counted = lines.deduplicated(df, min_lines=m, counts=("n_lines", "n_removed"))
    assert Counter((r.doc_id, r.n_lines, r.n_removed) for r in counted.collect()) == Counter(
        (i, *((0, 0) if t is None else expected[i, t][1:])) for i, t in rows)
    assert lines.deduplicated(df.limit(0), min_lines=m).count() == 0


def test_runs_of_many_words_and_whole_texts(spark):
    """One and two long lines go, short common ones stay, short texts go as a whole; long texts too."""
    rng = random.Random(8)
    words = lambda n: " ".join(rng.choices("abcdefgh", k=n))
    long, pair, short = words(50), [words(30), words(20)], words(49)
    rows = [(i, "\n".join([words(9), rng.choice([long, short, "\n".join(pair), pair[0]]), words(8)])) for i in range(60)]
    rows += [(100, "two words"), (101, "two words\n"), (102, "two words\nmore"), (103, "\ntwo words"), (104, short), (105, short), (106, pair[1])]
    rows += [(200, "\n".join(words(4) for _ in range(3000))), (201, "same old\n" * 2500)]
    rows += [(202, rows[-2][1] + "\n" + words(3)), (203, rows[-1][1].strip())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = plain_lines(rows, 3)
    got = {r.doc_id: r.text for r in lines.deduplicated(df).collect()}
    assert got == {i: expected[i, t][0] for i, t in rows}
    assert got[101] == "" and got[103] == "" and got[102] == rows[62][1] and got[105] == "" and got[106] == pair[1]
    assert sum(long in t for t in got.values()) == 1 and sum(short in t for t in got.values()) > 5


@pytest.mark.parametrize("m, least", [(3, 8), (5, 10), (4, 6)])
def test_word_sums_run_along_the_run(spark, m, least):
    """Heavy and light lines in any order: what goes is every maximal copied run with enough lines or words."""
    rng = random.Random(m)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.choice([1, 1, 2, 3, 5, 9]))) for _ in range(25)]
    block = [rng.choice(pool) for _ in range(14)]
    rows = []
    for i in range(150):
        body = [rng.choice(pool) for _ in range(rng.randrange(9))]
        at, k = rng.randrange(len(body) + 1), rng.randrange(10)
        body[at:at] = block[k : k + rng.randrange(1, 5)]
        rows.append((i, "\n".join(body)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = plain_lines(rows, m, least)
    assert {r.doc_id: r.text for r in lines.deduplicated(df, min_lines=m, min_words=least).collect()} == {i: expected[i, t][0] for i, t in rows}


def test_null_ids_come_first(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (None, "a\nb\nc\nd")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.deduplicated(df).collect()} == {1: "", None: "a\nb\nc\nd"}
