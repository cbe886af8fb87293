"""Reversed search against scores of all documents for all items."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from sluice.llm import lexical

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k):
    held = [(i, Counter(c), len(c)) for i, t in docs if (c := cut(t))]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, counts, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = 0
            for t in cut(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i))
        for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, i, -s))
    return Counter(out)


def tables():
    rng = random.Random(4)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 300}"
    text = lambda n: " ".join(word().title() if rng.random() < 0.2 else word() for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(250)]
    docs += [(300 + i, docs[i % 3][1]) for i in range(30)] + [docs[5], docs[5]]
    docs += [(400, None), (401, ""), (402, "-- \n"), (None, docs[7][1]), (403, "w1 " * 20_000), (404, "ÀB-ÀB_é àb w1"), (405, "x\x1cy")]
    items = [(i, text(rng.randrange(1, 15))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "..."), (53, "ÀB é W1 w1"), (54, "none of these"), (None, "w2 w3"), items[0], (1, "w4 w5"), (55, "y")]
    return docs, items


@pytest.mark.parametrize("k, bound", [(10, lexical.MAX_POSTINGS), (3, 200)])
def test_equals_scores_of_all_pairs(spark, k, bound):
    """Also with items in several blocks, so that documents stream through several indexes."""
    docs, items = tables()
    df = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, score string").repartition(4)
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int").repartition(2)
    found = lexical.search(df, asked, k=k, max_postings=bound)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, found.collect())) == plain(docs, items, k)


def test_empty_tables(spark):
    docs, items = tables()
    df, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert lexical.search(df.limit(0), asked).count() == 0
    none = lexical.search(df, asked.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_texts_as_ids_and_one_name(spark):
    df = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "two")], "id string, text string")
    asked = spark.createDataFrame([("q", "One")], "id string, body string")
    found = lexical.search(df, asked, id="id", item_id="id", item_text="body")
    assert [(r.id, r.rank, r.id_found) for r in found.orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x250))) + " It's A_b 漢字 x\u0085y İı"
    assert [t.decode() for t in lexical.terms(text.encode())] == cut(text)
