"""Row-by-row operators against plain versions: quality rules, BPE, word pieces."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import bpe, quality, wordpiece

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n", "a", "  two  spaces ", "end.\n \nnext \tx y z", "it's we'LL I'd x'y", "<|endoftext|>",
    "a<|endoftext|> b <|endoftext|><|endoftext|>\n", "1234 5 67,8", "naïve Ünïcödé 漢字かな 😀👍🏽 ‍", "\x1c\x1d a\x85b \x1f c",
    "word " * 3000, "x" * 20000, "é́ ﬃ Ⅷ ²³", " 　 a \r\n\r\n b", "a b\x00c", " q   r",
]
DOCS = "doc_id long, text string, `N_Words` string, ids string, keep_me int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", i) for i, t in enumerate(texts)], DOCS).coalesce(2)


def plain_quality(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    found = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_quality_equals_plain_rules(spark):
    texts = [*ODD, "a b c d e f a b c d e g h", "x " * 30, "one\ntwo\none\n \n \none", "#*$%&|<> a|b"]
    rows = quality.measure(frame(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r[1:7]) for r in rows] == [plain_quality(t) for t in texts]
    assert not any(r.kept and r.base_failed for r in rows)


@settings(max_examples=150, deadline=None)
@given(st.text("ab \n\t#", max_size=60))
def test_repeats_of_any_text(text):
    words = text.encode().split()
    assert quality.repeat_words(words, 5) == plain_quality(text)[4]


def test_bands_reject_repeats_and_noise_only(spark):
    import base64
    import random

    rng = random.Random(7)
    prose = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) between 1500 and 3000").limit(20)
    noise = "\n".join(" ".join(base64.b85encode(rng.randbytes(8)).decode() for _ in range(12)) for _ in range(20))
    middling = " ".join(f"w{i % 7} v{i % 11} u{i % 13}" for i in range(400))
    rows = {r.doc_id: r for r in quality.measure(frame(spark, [noise, middling])).collect()}
    assert not rows[0].base_failed and not rows[0].kept and not rows[1].kept
    judged = quality.measure(prose).where("not base_failed").collect()
    assert judged and all(r.kept for r in judged)


def test_accepted_keeps_all_columns(spark):
    df = frame(spark, [None, "Some quite ordinary words that stand here make up a sentence without any repeat at all.", ""])
    kept = quality.accepted(df)
    assert kept.columns == df.columns
    assert [r.doc_id for r in kept.collect()] == [1]
    assert quality.accepted(df.limit(0)).count() == 0 and quality.measure(df.limit(0)).count() == 0


def test_bpe_equals_library(spark):
    library = tokenizers.Tokenizer.from_file(PATH)
    rows = bpe.decode(bpe.encode(frame(spark, ODD), PATH, keep=["doc_id", "ids", "keep_me"]), PATH)
    assert rows.columns == ["doc_id", "keep_me", "ids", "decoded"]
    for row in rows.collect():
        ids = library.encode(ODD[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids, repr(ODD[row.doc_id])[:80]
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_round_trip_equals_encode_and_decode(spark):
    df = frame(spark, ODD)
    apart = bpe.decode(bpe.encode(df, PATH, keep=["doc_id", "keep_me"]), PATH)
    both = bpe.round_trip(df, PATH, keep=["doc_id", "ids", "keep_me"])
    assert both.columns == ["doc_id", "keep_me", "ids", "decoded"] == apart.columns
    assert sorted(map(repr, both.collect())) == sorted(map(repr, apart.collect()))
    assert bpe.round_trip(df.limit(0), PATH).count() == 0


@pytest.fixture(scope="module")
def both():
    return tokenizers.Tokenizer.from_file(PATH), bpe.Encoder(bpe.Vocabulary(PATH))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'sS<|>aé1  \x1c漢"), st.characters(codec="utf-8", max_codepoint=0x24F)), max_size=30))
def test_bpe_of_any_text(both, text):
    library, own = both
    assert own(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_digests_and_bytes(spark):
    df = spark.createDataFrame([(1, "it is"), (2, None)], "doc_id int, text string")
    ids = bpe.encode(df, PATH, keep=["doc_id"])
    rows = bpe.decode(ids, PATH).select("doc_id", "ids", *bpe.digests()).orderBy("doc_id").collect()
    assert rows[0].ids_sha256 == hashlib.sha256(",".join(map(str, rows[0].ids)).encode()).hexdigest()
    assert rows[0].decoded_sha256 == hashlib.sha256(b"it is").hexdigest()
    assert rows[1].n_tokens == 0 and rows[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    cut = spark.createDataFrame([([bpe.Vocabulary(PATH).first[0xE2]],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(cut, PATH).collect()] == ["�", None]


def greedy(word, starts, parts):
    count, at = 0, 0
    while at < len(word):
        known = parts if at else starts
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 0
        count, at = count + 1, end
    return count


PIECES = st.lists(st.text("abc", min_size=1, max_size=4).map(str.encode), max_size=12)


@settings(max_examples=400, deadline=None)
@given(PIECES, PIECES, st.lists(st.text("abcd", min_size=1, max_size=12).map(str.encode), min_size=1, max_size=8))
def test_automaton_is_greedy_longest_match(starts, parts, words):
    automaton = wordpiece.Automaton(starts, parts)
    assert [automaton.count(w) for w in words] == [greedy(w, set(starts), set(parts)) for w in words]


def test_token_counts_equal_library(spark):
    starts, parts = wordpiece.pieces_of(PATH)
    letter = {b: chr(0x4E00 + b) for b in range(256)}
    spell = lambda data: "".join(letter[b] for b in data)
    vocab = {p: i for i, p in enumerate(dict.fromkeys(["[UNK]", *map(spell, starts), *("##" + spell(p) for p in parts)]))}
    library = tokenizers.models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10**9)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(30).collect()
    texts = [*ODD, *(r.text for r in docs)]
    for row in wordpiece.token_counts(frame(spark, texts), PATH, keep=["doc_id", "N_Words"]).collect():
        words = (texts[row.doc_id] or "").encode().split()
        found = [[t.value for t in library.tokenize(spell(w))] for w in words]
        unknown = sum(f == ["[UNK]"] for f in found)
        assert tuple(row) == (row.doc_id, len(words), unknown, sum(map(len, found)))
    assert wordpiece.token_counts(frame(spark, ODD).limit(0), PATH).count() == 0


def test_bands_leave_ordinary_texts_alone(spark):
    """Of labelled texts that the base rules pass, none of good quality is rejected; noise of each length is."""
    import base64
    import random

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1").select("doc_id"), "doc_id")
    judged = quality.measure(docs.select("doc_id", "text"))
    assert judged.where("not base_failed").count() > 1000 and judged.where("not base_failed and not kept").count() == 0
    rng = random.Random(5)
    noise = ["\n".join(base64.b64encode(rng.randbytes(45)).decode() + " x" for _ in range(n)) for n in (40, 90, 400)]
    assert [r.kept for r in quality.measure(frame(spark, noise)).collect()] == [False] * 3


def labelled(spark, quality):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where(f"quality = {quality}").select("doc_id")
    return docs.join(labels, "doc_id").select("doc_id", "text")


def test_fitted_bands_reject_held_out_junk(spark):
    """The bands come from good texts of even id; those of odd id stay, and most junk of odd id goes."""
    rules = quality.fitted(labelled(spark, 1).where("doc_id % 2 = 0"))
    for found, given in ((rules.whole_bands, quality.WHOLE_BANDS), (rules.chunk_bands, quality.CHUNK_BANDS)):
        assert [b[0] for b in found] == [b[0] for b in given]
        assert all(b[1:] == pytest.approx(g[1:], abs=0.0021) for b, g in zip(found, given))
    shares = []
    for good in (1, 0):
        judged = quality.measure(labelled(spark, good).where("doc_id % 2 = 1"), rules=quality.Rules()).where("not base_failed")
        shares.append(judged.agg(F.avg(F.col("kept").cast("int"))).first()[0])
    assert shares[0] > 0.995 and shares[1] < 0.4


def test_query_and_stage_use_the_fitted_bands(spark):
    import corpus_pipeline
    from sluice.llm import queries

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wide = {r.doc_id for r in quality.accepted(docs).collect()}
    kept = {r.doc_id for r in queries.QUERIES["op1_compression_bands"](spark, sf).where("kept").collect()}
    assert kept < wide and {32, 40, 44} <= wide - kept  # '$$$', '|' and '&&&' among the words
    assert {r.doc_id for r in corpus_pipeline.keep_quality(spark, docs, sf).collect()} == kept
